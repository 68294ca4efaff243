"""Data-quality questions asked of the snapshots, labels and training set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.functions import timecols as tc
from stopline.operators import features as feat
from stopline.operators import prefix, splits

HORIZON_SECONDS = 600


def horizon_availability(training: DataFrame, horizon_seconds: int = HORIZON_SECONDS) -> DataFrame:
    """Per feature: rows whose input exists, and of those, rows whose newest input had settled
    at least the horizon before the scheduled time."""
    rows = feat.with_local_time(training)
    out = []
    for name, keys, bucket in (
        ("current_delay_persistence_seconds", feat.TRIP_KEY, None),
        ("route_hour_historical_late_rate", feat.RATE_KEY, prefix.time_buckets(feat.AT, prefix.HOUR)[0]),
    ):
        points = rows.groupBy(*keys, feat.AT).agg(
            F.count(F.lit(1)).alias("n"), F.max("observed_span_end").alias("settled_at")
        )
        before = prefix.previous_point(points, keys, feat.AT, ["settled_at"], bucket)
        ready = F.col("prev_settled_at") <= tc.plus_seconds(F.col(feat.AT), -horizon_seconds)
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
        out.append(
            before.agg(
                F.lit(name).alias("feature"),
                total(F.col("prev_settled_at").isNotNull()).alias("available"),
                total(ready).alias("settled_in_time"),
            )
        )
    return out[0].unionByName(out[1])


def key_reuse(stop_events: DataFrame, span_hours: int = 6) -> DataFrame:
    """(trip, stop) pairs seen over a long span or under more than one schedule."""
    pairs = stop_events.groupBy("trip_id", "stop_id").agg(
        tc.micros_between(F.min("polled_at"), F.max("polled_at")).alias("span"),
        (F.min("scheduled_arrival") < F.max("scheduled_arrival")).alias("several"),
    )
    long_span = F.col("span") > span_hours * 3600 * tc.MICROS
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(long_span).alias("long_span_pairs"),
        F.count_if("several").alias("several_schedule_pairs"),
    )


def mixed_null(stop_events: DataFrame) -> DataFrame:
    """(trip, stop) pairs that carry a schedule in some snapshots and none in others."""
    unknown = F.col("scheduled_arrival").isNull()
    pairs = stop_events.groupBy("trip_id", "stop_id").agg(
        (F.bool_or(unknown) & F.bool_or(~unknown)).alias("mixed")
    )
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.count_if("mixed").alias("mixed_pairs"))


def proxy_gap(training: DataFrame, early_minutes: int = 30) -> DataFrame:
    """How far the last prediction lies from the last sighting, and how many vanished early."""
    micros = tc.micros_between(F.col("observed_span_end"), F.col("final_predicted_arrival"))
    gaps = training.select(micros.alias("micros")).filter(F.col("micros").isNotNull())
    buckets = [F.floor(F.col("micros") / w).cast("long") for w in (3600 * tc.MICROS, tc.MICROS)]
    median = prefix.median_of(prefix.cumulative_counts(gaps, "micros", buckets), "micros").scalar()
    early = tc.micros_between(F.col("observed_span_end"), F.col(feat.AT)) > early_minutes * 60 * tc.MICROS
    return training.agg(
        F.count(F.lit(1)).alias("labels"),
        (F.sum(micros) / F.count(micros) / tc.MICROS).alias("mean_seconds"),
        F.count_if(early).alias("vanished_early"),
    ).withColumn("median_seconds", median / tc.MICROS)


def day_coverage(split_rows: DataFrame) -> DataFrame:
    """Rows and late rate per split, service date and local weekday."""
    rows = split_rows.withColumn("weekday", tc.local_dow(F.col(feat.AT)))
    return splits.split_summary(rows, "service_date_norm", "weekday").select(
        "split", "service_date_norm", "weekday", "rows", "late_rate"
    )


def empty_cells(training: DataFrame) -> DataFrame:
    """(service date, hour) cells without a label, among the dates that have any."""
    seen = training.select("service_date_norm", tc.local_hour(F.col(feat.AT)).alias("hour_of_day")).distinct()
    grid = seen.select("service_date_norm").distinct().select(
        "service_date_norm", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day")
    )
    return grid.join(seen, ["service_date_norm", "hour_of_day"], "left_anti")
