"""Polling gaps, uptime and cadence from the ledger of ingestion cycles (one row per cycle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.config import DETAIL_MAX_CHARS, PUBLIC_GAP_MULTIPLIER, REASON_MAX_CHARS
from stopline.functions import numeric as num
from stopline.functions import text
from stopline.functions import timecols as tc
from stopline.operators import prefix


def consecutive(runs: DataFrame) -> DataFrame:
    """Each cycle with ``prev_polled_at``, the cycle before it (null for the first).

    Cycles are walked per day and stitched across days, so no task orders the whole ledger."""
    cycles = runs.withColumn("at", F.col("polled_at"))
    return prefix.previous_point(cycles, [], "polled_at", ["at"], tc.time_bucket(F.col("polled_at"), prefix.DAY)).select(
        *runs.columns, F.col("prev_at").alias("prev_polled_at")
    )


def missing_cycle_spans(runs: DataFrame, gap_threshold_seconds: float) -> DataFrame:
    """Spans between neighbouring cycles that lie further apart than the threshold."""
    elapsed = tc.epoch_seconds(F.col("prev_polled_at"), F.col("polled_at"))
    return (
        consecutive(runs.select("polled_at"))
        .filter(elapsed > gap_threshold_seconds)
        .select(F.col("prev_polled_at").alias("gap_start"), F.col("polled_at").alias("gap_end"))
    )


def errored_cycle_points(runs: DataFrame) -> DataFrame:
    """A point interval for every cycle that recorded an error; an empty text counts."""
    return runs.filter(F.col("error").isNotNull()).select(
        F.col("polled_at").alias("gap_start"), F.col("polled_at").alias("gap_end")
    )


def gap_intervals(runs: DataFrame, gap_threshold_seconds: float) -> DataFrame:
    """All intervals in which the feed's state is unknown; duplicates are kept."""
    return errored_cycle_points(runs).unionByName(missing_cycle_spans(runs, gap_threshold_seconds))


def cadence_counts(runs: DataFrame) -> DataFrame:
    """Counts per distinct distance between neighbouring cycles, in microseconds."""
    gaps = consecutive(runs.select("polled_at")).filter(F.col("prev_polled_at").isNotNull())
    distance = gaps.select(tc.micros_between(F.col("prev_polled_at"), F.col("polled_at")).alias("micros"))
    # Distances add up to the ledger's span, so the number of distinct seconds among them is at
    # most about the square root of twice the span in seconds.
    return prefix.cumulative_counts(distance, "micros", [F.floor(F.col("micros") / tc.MICROS).cast("long")])


def median_cadence(runs: DataFrame) -> DataFrame:
    """Exact median distance between neighbouring cycles, in seconds; null below two cycles."""
    return prefix.median_of(cadence_counts(runs), "micros").select(
        (F.col("median") / tc.MICROS).alias("cadence_seconds")
    )


def public_gaps(runs: DataFrame, multiplier: float = PUBLIC_GAP_MULTIPLIER) -> DataFrame:
    """The public gap ledger: long silences, and errored cycles that came on time."""
    return public_gap_walk(runs, multiplier).drop("closed_by")


def latest_public_gaps(runs: DataFrame, multiplier: float = PUBLIC_GAP_MULTIPLIER) -> DataFrame:
    """The public ledger keyed by start time: of gaps sharing one, the later in the walk stays."""
    gaps = public_gap_walk(runs, multiplier)
    values = [c for c in gaps.columns if c not in ("started_at", "closed_by")]
    kept = gaps.groupBy("started_at").agg(F.max_by(F.struct(*values), "closed_by").alias("g"))
    return kept.select("started_at", "g.*")


def public_gap_walk(runs: DataFrame, multiplier: float = PUBLIC_GAP_MULTIPLIER) -> DataFrame:
    """Public gaps with ``closed_by``, the cycle that ended them.

    An empty error text means no error here, unlike in :func:`gap_intervals`."""
    cadence = median_cadence(runs).scalar()
    walked = consecutive(
        runs.select("polled_at", "started_at", "finished_at", "error", "batches_ok", "batches_total")
    ).withColumn("cadence", cadence)
    walked = walked.filter(F.col("cadence") > 0)
    gap_seconds = tc.epoch_seconds(F.col("prev_polled_at"), F.col("polled_at"))
    silent = F.coalesce(gap_seconds > F.col("cadence") * multiplier, F.lit(False))
    has_error = F.coalesce(F.col("error") != "", F.lit(False))
    error = F.when(has_error, F.col("error"))
    reason = F.coalesce(
        text.classify_reason(error, F.col("batches_ok"), F.col("batches_total")), F.lit("no poll recorded")
    )
    reason = F.when(has_error, reason).otherwise(F.lit("no poll recorded"))
    start = F.when(silent, F.col("prev_polled_at")).otherwise(F.col("started_at"))
    end = F.when(silent, F.col("polled_at")).otherwise(F.col("finished_at"))
    return walked.filter(silent | has_error).select(
        tc.iso_utc(start).alias("started_at"),
        tc.iso_utc(end).alias("ended_at"),
        num.round_half_even(tc.epoch_seconds(start, end)).alias("duration_seconds"),
        text.truncate_text(reason, REASON_MAX_CHARS).alias("reason"),
        F.when(silent, num.cycles_missed(gap_seconds, F.col("cadence")))
        .otherwise(F.lit(0).cast("long"))
        .alias("cycles_missed"),
        text.truncate_text(error, DETAIL_MAX_CHARS).alias("detail"),
        F.col("polled_at").alias("closed_by"),
    )


def uptime(runs: DataFrame, gap_threshold_seconds: float, until=None) -> DataFrame:
    """Cycles, ledger span, gaps over the threshold and the share of the span outside them."""
    bounded = runs.select("polled_at")
    if until is not None:
        bounded = bounded.filter(F.col("polled_at") <= until)
    micros = tc.micros_between(F.col("prev_polled_at"), F.col("polled_at"))
    gap = F.when(micros > int(gap_threshold_seconds * tc.MICROS), micros)
    return (
        consecutive(bounded)
        .agg(
            F.count(F.lit(1)).alias("poll_cycles"),
            F.coalesce(tc.micros_between(F.min("polled_at"), F.max("polled_at")), F.lit(0)).alias("span"),
            F.count(gap).alias("gap_count"),
            F.coalesce(F.sum(gap), F.lit(0)).alias("gap"),
            F.coalesce(F.max(gap), F.lit(0)).alias("longest"),
        )
        .select(
            "poll_cycles",
            (F.col("span") / (3600.0 * tc.MICROS)).alias("ledger_span_hours"),
            "gap_count",
            (F.col("gap") / (3600.0 * tc.MICROS)).alias("gap_hours"),
            (F.col("longest") / (3600.0 * tc.MICROS)).alias("longest_gap_hours"),
            F.coalesce(100.0 * (1.0 - num.ratio(F.col("gap"), F.col("span"))), F.lit(0.0)).alias("uptime_pct"),
        )
    )


def ledger_span(runs: DataFrame, as_of) -> DataFrame:
    first = F.min("polled_at")
    return runs.agg(
        first.alias("first_cycle_at"),
        F.count(F.lit(1)).alias("cycles"),
        F.max("polled_at").alias("last_cycle_at"),
        (tc.epoch_seconds(first, F.first(as_of)) / 86400.0).alias("days_running"),
    )


def inserted_last_hour(runs: DataFrame, as_of) -> DataFrame:
    return last_hour(runs, as_of).agg(
        F.coalesce(F.sum("inserted"), F.lit(0)).cast("long").alias("rows_last_hour")
    )


def last_hour(df: DataFrame, as_of) -> DataFrame:
    """Rows polled in the hour up to ``as_of`` or later; the clock is a parameter."""
    return df.filter(F.col("polled_at") >= tc.plus_seconds(as_of, -3600))


def latest_cycle(runs: DataFrame) -> DataFrame:
    """``as_of`` when none is given: the latest recorded cycle."""
    return runs.agg(F.max("polled_at").alias("as_of"))
