"""The label build: settle, close, upsert, gate, record."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.config import LABEL_KEY, LabelRules
from stopline.functions import timecols as tc
from stopline.operators import gates, ledger, status
from stopline.operators import labels as lab
from stopline.sources import tables as tb


def closed_labels(
    stop_events: DataFrame, runs: DataFrame, rules: LabelRules, since=None, until=None, as_of=None, ledger_until=None
) -> DataFrame:
    """Label rows of every settled group touched in [since, until), as one lazy plan.

    ``as_of`` defaults to the latest ledger row. ``ledger_until`` pins the ledger for reruns."""
    cycles = runs if ledger_until is None else runs.filter(F.col("polled_at") <= ledger_until)
    groups = lab.touched_groups(stop_events, since, until)
    return _close(groups, cycles, rules, as_of)


def _close(groups: DataFrame, cycles: DataFrame, rules: LabelRules, as_of) -> DataFrame:
    moment = ledger.latest_cycle(cycles).scalar() if as_of is None else as_of
    gaps = ledger.gap_intervals(cycles, rules.gap_threshold_seconds)
    return lab.close_labels(groups, gaps, moment, rules)


def build_labels(
    stop_events: DataFrame,
    runs: DataFrame,
    labels_path: str,
    records_path: str,
    rules: LabelRules = LabelRules(),
    since: datetime | None = None,
    until: datetime | None = None,
    as_of: datetime | None = None,
    git_sha: str | None = None,
) -> DataFrame:
    """Run one build and record it, gates failed or not; returns the one-row record.

    Groups are staged once, so counting them, closing them and the gates read small tables."""
    started = datetime.now(timezone.utc)
    spark = stop_events.sparkSession
    since, until, as_of = (tc.as_utc(v) for v in (since, until, as_of))
    low, high = (None if v is None else F.lit(v).cast("timestamp") for v in (since, until))
    # One value closes the groups and goes into the record; an empty ledger ends at the build's start.
    latest = as_of or ledger.latest_cycle(runs).select(F.unix_micros("as_of")).first()[0]
    latest = started if latest is None else latest
    moment = F.timestamp_micros(F.lit(latest)) if isinstance(latest, int) else F.lit(latest).cast("timestamp")
    with tb.scratch(spark):
        groups = tb.stage(lab.touched_groups(stop_events, low, high), "groups")
        rows = _close(groups, runs, rules, moment).withColumn("built_at", F.lit(started).cast("timestamp"))
        written = tb.upsert(rows, labels_path, LABEL_KEY, "service_date_norm")
        summary = gates.side_by_side(
            groups.agg(F.count(F.lit(1)).alias("groups_considered")),
            gates.label_gates(written),
            spark.range(1).select(moment.alias("as_of")),
        )
        record = tb.stage(
            status.transform_record("build_labels", summary, started, since, until or started, F.col("as_of"), git_sha), "record"
        )
        tb.append(record, records_path)
    return tb.read(spark, records_path).filter(F.col("started_at") == F.lit(started).cast("timestamp"))
