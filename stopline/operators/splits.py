"""Time split and per-split summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.config import MIN_DAYS_FOR_REPORT, TRAIN_FRACTION
from stopline.functions import numeric as num
from stopline.functions import timecols as tc
from stopline.operators import prefix
from stopline.sources import tables as tb

AT = "scheduled_arrival"


def split_cut(rows: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """One row with ``cut_at``: the time of row number floor(n * fraction) in time order.

    Rows up to and including that time train, so no time is ever on both sides. With no such row
    the cut is null and everything is test. Counts per distinct time are staged, so ``rows`` is read
    once, and summed in nested time buckets; no row is numbered and nothing is sorted in one task."""
    points = tb.stage(rows.groupBy(AT).agg(F.count(F.lit(1)).alias("n")), "times")
    counts = prefix.prefix_sums(points, [], AT, ["n"], prefix.time_buckets(AT, prefix.DAY))
    total = points.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
    wanted = F.floor(total.cast("double") * F.lit(fraction))
    return counts.filter(F.col("n_before") < wanted).agg(F.max(AT).alias("cut_at"))


def with_split(rows: DataFrame, cut_at: Column) -> DataFrame:
    return rows.withColumn("split", F.when(F.col(AT) <= cut_at, "train").otherwise("test"))


def temporal_split(rows: DataFrame, fraction: float = TRAIN_FRACTION, keep=tb.staged) -> DataFrame:
    """Rows with their ``split``. The cut is stored by ``keep``, so rows read often are cut once."""
    return with_split(rows, keep(lambda: split_cut(rows, fraction), "cut").scalar())


def split_summary(split_rows: DataFrame, *by: str) -> DataFrame:
    """Rows, time range and class balance per split (and per further grouping columns)."""
    late = F.sum(F.col("late").cast("int"))
    return split_rows.groupBy("split", *by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(AT).alias("first_scheduled_arrival"),
        F.max(AT).alias("last_scheduled_arrival"),
        late.alias("late_rows"),
        num.ratio(late, F.count(F.lit(1))).alias("late_rate"),
    )


def on_time_reference(split_rows: DataFrame) -> DataFrame:
    """Accuracy and PR-AUC of never predicting late, on the test split."""
    test = split_rows.filter(F.col("split") == "test")
    late = num.ratio(F.sum(F.col("late").cast("int")), F.count(F.lit(1)))
    return test.agg((1.0 - late).alias("accuracy"), late.alias("pr_auc"))


def preliminary_flag(rows: DataFrame, min_days: float = MIN_DAYS_FOR_REPORT) -> DataFrame:
    days = tc.epoch_seconds(F.min(AT), F.max(AT)) / 86400.0
    return rows.agg(days.alias("window_days"), (days < min_days).alias("preliminary"))


def route_hour_rate(split_rows: DataFrame) -> DataFrame:
    """Late rate per (route, hour) over the train split only."""
    train = split_rows.filter(F.col("split") == "train")
    return train.groupBy("route_id", "hour_of_day").agg(
        num.ratio(F.sum(F.col("late").cast("int")), F.count(F.lit(1))).alias("frozen_rate")
    )


def with_frozen_rate(split_rows: DataFrame) -> DataFrame:
    """Replace the as-of rate by the train-only rate; unseen (route, hour) pairs stay null."""
    rates = tb.stage(route_hour_rate(split_rows), "frozen-rates")  # its size is known, so a small one is broadcast
    return (
        split_rows.join(rates, ["route_id", "hour_of_day"], "left")
        .withColumn("route_hour_historical_late_rate", F.col("frozen_rate"))
        .drop("frozen_rate")
        .select(*split_rows.columns)
    )
