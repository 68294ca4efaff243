"""Public status row, data regime row and transform records, all from one-row aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.functions import numeric as num
from stopline.functions import timecols as tc
from stopline.operators import gates, ledger
from stopline.operators import labels as lab
from stopline.sources import tables as tb


IDS = ["route_id", "trip_id", "stop_id"]


def _by_ids(stop_events: DataFrame, sums: dict[str, Column], firsts: dict[str, Column], lasts: dict[str, Column]) -> DataFrame:
    """One row: the sums, minima and maxima, and the exact number of distinct values of each id.

    Rows are reduced to one per (route, trip, stop) first, combined before the shuffle. Only those
    are laid out once per id and reduced again, so no row of the table is ever multiplied."""
    carry = {F.sum: sums, F.min: firsts, F.max: lasts}
    reduced = stop_events.groupBy(*IDS).agg(*[c.alias(k) for part in carry.values() for k, c in part.items()])
    laid = F.explode(F.array(*[F.struct(F.lit(k).alias("id"), F.col(k).cast("string").alias("value")) for k in IDS])).alias("_i")
    named = reduced.select(laid, *[k for part in carry.values() for k in part]).select("_i.*", *[k for part in carry.values() for k in part])
    each = named.groupBy("id", "value").agg(*[f(k).alias(k) for f, part in carry.items() for k in part])
    once = lambda k: F.when(F.col("id") == IDS[0], F.col(k))
    return each.agg(
        *[F.coalesce(F.sum(once(k)), F.lit(0)).alias(k) for k in sums],
        *[f(once(k)).alias(k) for f in (F.min, F.max) for k in carry[f]],
        *[F.count_if((F.col("id") == k) & F.col("value").isNotNull()).alias(f"distinct_{k[:-3]}s") for k in IDS],
    )


def distinct_counts(stop_events: DataFrame) -> DataFrame:
    found = _by_ids(stop_events, {"rows_total": F.count(F.lit(1))}, {}, {})
    return found.select("rows_total", "distinct_routes", "distinct_trips", "distinct_stops")


def ingest_summary(stop_events: DataFrame, as_of: Column) -> DataFrame:
    """Totals, last hour, distinct ids, time range and null counts with their share."""
    recent = F.col("polled_at") >= tc.plus_seconds(F.col("now"), -3600)
    nulls = lambda c: F.count_if(F.col(c).isNull())
    found = _by_ids(
        stop_events.withColumn("now", as_of),
        {
            "total_rows": F.count(F.lit(1)),
            "last_hour_rows": F.count_if(recent),
            "scheduled_arrival_null": nulls("scheduled_arrival"),
            "predicted_arrival_null": nulls("predicted_arrival"),
        },
        {"min_polled_at": F.min("polled_at")},
        {"max_polled_at": F.max("polled_at")},
    )
    share = lambda c: num.pct_text(F.col(c), F.col("total_rows")).alias(f"{c}_pct")
    return found.select(
        "total_rows", "last_hour_rows", "distinct_trips", "distinct_routes", "distinct_stops", "min_polled_at", "max_polled_at",
        "scheduled_arrival_null", share("scheduled_arrival_null"), "predicted_arrival_null", share("predicted_arrival_null"),
    )


def regime_report(labels: DataFrame, stop_events: DataFrame, runs: DataFrame, gap_threshold_seconds: float) -> DataFrame:
    """Ingestion window, snapshots and uptime up to its end, and label counts, in one row.

    The window comes from the labels' own spans, so later polling does not move the report."""
    span = [F.min("observed_span_start").alias("ingest_start"), F.max("observed_span_end").alias("ingest_end")]
    counted = tb.stage(labels.agg(*span, *lab.label_count_columns()), "regime")  # one row, from one pass
    end = counted.select("ingest_end").scalar()
    seen = stop_events.filter(F.col("polled_at") <= end).agg(F.count(F.lit(1)).alias("stop_events_rows"))
    row = gates.side_by_side(counted, seen, ledger.uptime(runs, gap_threshold_seconds, until=end))
    return row.withColumn("ingest_days", tc.epoch_seconds(F.col("ingest_start"), F.col("ingest_end")) / 86400.0)


def status_snapshot(stop_events: DataFrame, runs: DataFrame, labels: DataFrame, as_of: Column) -> DataFrame:
    """The public status row; ``as_of`` stands for the clock. Disk space is not measured here."""
    row = gates.side_by_side(
        ledger.ledger_span(runs, as_of),
        ledger.inserted_last_hour(runs, as_of),
        ledger.median_cadence(runs),
        distinct_counts(stop_events),
        lab.label_counts(labels),
        gates.ingest_gates(stop_events, runs, as_of),
    )
    passed = F.size(F.filter(F.map_values("gate_results"), lambda g: g["passed"]))
    return row.select(
        tc.iso_utc(tc.truncate_minute(as_of)).alias("published_at"),
        tc.iso_utc(F.col("first_cycle_at")).alias("first_cycle_at"),
        "days_running",
        "cycles",
        "rows_total",
        "rows_last_hour",
        "cadence_seconds",
        "distinct_routes",
        "distinct_trips",
        "distinct_stops",
        "labels_total",
        "labels_gap_abutted",
        "labels_no_arrival",
        F.lit(None).cast("double").alias("disk_free_gib"),
        passed.alias("gates_pass"),
        F.size("gate_results").alias("gates_total"),
        F.to_json("gate_results").alias("gate_detail"),
    )


def transform_record(
    name: str, summary: DataFrame, started_at, window_since, window_until, as_of, git_sha: str | None
) -> DataFrame:
    """One run record from a one-row frame with groups_considered, rows_written and gate_results.

    It is written whether the gates passed or not."""
    stamp = lambda v: F.lit(v).cast("timestamp") if not isinstance(v, Column) else v
    return summary.select(
        F.lit(name).alias("transform_name"),
        stamp(started_at).alias("started_at"),
        F.greatest(F.current_timestamp(), stamp(started_at)).alias("finished_at"),
        stamp(window_since).alias("window_since"),
        stamp(window_until).alias("window_until"),
        stamp(as_of).alias("as_of"),
        F.col("groups_considered").cast("int").alias("groups_considered"),
        F.col("rows_written").cast("int").alias("rows_written"),
        "gate_results",
        gates.all_passed().alias("passed"),
        F.lit(git_sha).cast("string").alias("git_sha"),
    )
