"""Lateness labels per trip, stop and service day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopline.config import LABEL_KEY, NO_LOWER_BOUND, LabelRules
from stopline.functions import timecols as tc

LABEL_COLUMNS = LABEL_KEY + [
    "scheduled_arrival",
    "final_predicted_arrival",
    "delay_seconds",
    "late",
    "observed_span_start",
    "observed_span_end",
    "n_snapshots",
    "closed_reason",
]


def in_window(column: Column, since=None, until=None) -> Column:
    """Half-open [since, until); no ``since`` means all history, no ``until`` no upper bound."""
    low = F.lit(NO_LOWER_BOUND).cast("timestamp") if since is None else since
    inside = column >= low
    return inside if until is None else inside & (column < until)


def trip_stop_groups(stop_events: DataFrame, since=None, until=None) -> DataFrame:
    """One row per (trip, stop, service day) over the full snapshot history.

    A trip id returns on later service days, so the day is part of the key. ``touched`` says
    whether any snapshot lies in the window; the aggregates never depend on the window. Every
    aggregate is combined before the shuffle, so a hot group costs one row per input partition.
    """
    polled = F.col("polled_at")
    latest = lambda c: F.max_by(c, "polled_at")
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), polled))
    return (
        stop_events.withColumn(
            "service_date_norm", tc.service_date_norm(F.coalesce("scheduled_arrival", "polled_at"))
        )
        .groupBy("trip_id", "stop_id", "service_date_norm")
        .agg(
            latest("route_id").alias("route_id"),
            latest("direction_id").alias("direction_id"),
            known("scheduled_arrival").alias("scheduled_arrival"),
            known("predicted_arrival").alias("final_predicted_arrival"),
            F.min("polled_at").alias("observed_span_start"),
            F.max("polled_at").alias("observed_span_end"),
            F.count(F.lit(1)).cast("int").alias("n_snapshots"),
            F.bool_or(in_window(polled, since, until)).alias("touched"),
        )
    )


def touched_groups(stop_events: DataFrame, since=None, until=None) -> DataFrame:
    return trip_stop_groups(stop_events, since, until).filter("touched").drop("touched")


def is_settled(span_end: Column, as_of: Column, rules: LabelRules) -> Column:
    """Quiet for at least the settle margin, boundary included."""
    return tc.micros_between(span_end, as_of) >= int(rules.settle_margin_seconds * tc.MICROS)


def late_flag(delay_seconds: Column, rules: LabelRules) -> Column:
    return delay_seconds > rules.late_threshold_seconds


def gap_reaches(gaps: DataFrame, rules: LabelRules) -> DataFrame:
    """(bucket, low, high): the moments t whose window [t, t + margin] meets some gap.

    Reaches are laid out over margin-wide time buckets and merged inside each, so a moment lies in at
    most one of its bucket's reaches. Their number is bounded by the ledger's span."""
    width = max(1, int(rules.settle_margin_seconds))
    reach = gaps.select(
        tc.plus_seconds(F.col("gap_start"), -rules.settle_margin_seconds).alias("low"), F.col("gap_end").alias("high")
    ).distinct()
    buckets = F.sequence(tc.time_bucket(F.col("low"), width), tc.time_bucket(F.col("high"), width))
    spread = reach.withColumn("bucket", F.explode(buckets))
    walk = Window.partitionBy("bucket").orderBy("low", "high")
    earlier = F.max("high").over(walk.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("low") > earlier, F.lit(True)).cast("int")
    islands = spread.withColumn("starts", starts).withColumn("island", F.sum("starts").over(walk))
    return islands.groupBy("bucket", "island").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("island")


def mark_gap_abutted(groups: DataFrame, gaps: DataFrame, rules: LabelRules) -> DataFrame:
    """Add ``gap_abutted``: a gap overlaps [span end, span end + margin].

    Span ends meet the merged reaches by an equality join on the time bucket; no nested loop, and no
    second pass over the snapshots."""
    width = max(1, int(rules.settle_margin_seconds))
    end = F.col("observed_span_end")
    g = groups.withColumn("_bucket", tc.time_bucket(end, width))
    met = g.join(
        gap_reaches(gaps, rules), (F.col("_bucket") == F.col("bucket")) & end.between(F.col("low"), F.col("high")), "left"
    )
    return met.withColumn("gap_abutted", F.col("low").isNotNull()).drop("_bucket", "bucket", "low", "high")


def close_labels(groups: DataFrame, gaps: DataFrame, as_of: Column, rules: LabelRules) -> DataFrame:
    """Settled groups as label rows: delay, late flag and the closing reason.

    A missing arrival wins over a gap; a gap row keeps its delay but is not training-usable."""
    settled = groups.filter(is_settled(F.col("observed_span_end"), as_of, rules))
    delay = tc.whole_seconds(tc.micros_between(F.col("scheduled_arrival"), F.col("final_predicted_arrival")))
    return (
        mark_gap_abutted(settled, gaps, rules)
        .withColumn("delay_seconds", delay)
        .withColumn("late", late_flag(F.col("delay_seconds"), rules))
        .withColumn(
            "closed_reason",
            F.when(F.col("delay_seconds").isNull(), "no_arrival_signal").when(F.col("gap_abutted"), "gap_abutted"),
        )
        .select(*LABEL_COLUMNS)
    )


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that closed normally."""
    return labels.filter(F.col("closed_reason").isNull())


def label_count_columns() -> list[Column]:
    reason = F.col("closed_reason")
    return [
        F.count(F.lit(1)).alias("labels_total"),
        F.count_if(reason.isNull()).alias("labels_usable"),
        F.count_if(reason == "gap_abutted").alias("labels_gap_abutted"),
        F.count_if(reason == "no_arrival_signal").alias("labels_no_arrival"),
    ]


def label_counts(labels: DataFrame) -> DataFrame:
    return labels.agg(*label_count_columns())
