"""Point-in-time features: each row sees only labels scheduled strictly earlier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopline.config import LABEL_KEY
from stopline.functions import numeric as num
from stopline.functions import timecols as tc
from stopline.operators import labels as lab
from stopline.operators import prefix
from stopline.sources import tables as tb

RATE_KEY = ["route_id", "hour_of_day"]
HEADWAY_KEY = ["route_id", "direction_id", "stop_id"]
TRIP_KEY = ["trip_id", "service_date_norm"]
AT = "scheduled_arrival"


def with_local_time(training: DataFrame) -> DataFrame:
    return training.withColumns(
        {"hour_of_day": tc.local_hour(F.col(AT)), "day_of_week": tc.local_dow(F.col(AT))}
    )


def route_hour_history(training: DataFrame) -> DataFrame:
    """Per (route, local hour, time): rows and late rows strictly earlier in the same bucket.

    Rows are reduced to one per distinct time before anything is ordered. A (route, hour) then
    has one hour-wide bucket per day, each with at most an hour's distinct times."""
    points = (
        with_local_time(training)
        .groupBy(*RATE_KEY, AT)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("late").cast("int")).alias("n_late"))
    )
    return prefix.prefix_sums(points, RATE_KEY, AT, ["n", "n_late"], prefix.time_buckets(AT, prefix.HOUR))


def earlier_rate(history: DataFrame) -> DataFrame:
    return history.select(
        *RATE_KEY,
        AT,
        num.ratio(F.col("n_late_before"), F.col("n_before")).alias("route_hour_historical_late_rate"),
    )


def previous_arrivals(training: DataFrame) -> DataFrame:
    """Per (route, direction, stop, time): the latest strictly earlier time there."""
    points = training.select(*HEADWAY_KEY, AT).distinct().withColumn("at", F.col(AT))
    return prefix.previous_point(points, HEADWAY_KEY, AT, ["at"], tc.time_bucket(F.col(AT), prefix.DAY)).select(
        *HEADWAY_KEY, AT, tc.int_seconds(tc.micros_between(F.col("prev_at"), F.col(AT))).alias("headway_seconds")
    )


def with_previous_delays(training: DataFrame) -> DataFrame:
    """Each row with the delay at its trip's latest strictly earlier stop.

    Several stops at one time are settled by the highest stop id. The key holds the service day, so a
    key's rows are one day's stops, and one exchange by that key serves every row; nothing is joined."""
    earlier = Window.partitionBy(*TRIP_KEY).orderBy(F.unix_micros(AT)).rangeBetween(Window.unboundedPreceding, -1)
    latest = F.max(F.struct(AT, "stop_id", "delay_seconds")).over(earlier)["delay_seconds"]
    return training.withColumn("current_delay_persistence_seconds", F.when(F.col(AT).isNotNull(), latest))


def previous_delays(training: DataFrame) -> DataFrame:
    """Per (trip, service day, time): the delay at the trip's latest strictly earlier stop."""
    rows = training.select(*TRIP_KEY, AT, "stop_id", "delay_seconds")
    return with_previous_delays(rows).select(*TRIP_KEY, AT, "current_delay_persistence_seconds").distinct()


def build(training: DataFrame, since=None, until=None) -> DataFrame:
    """Feature rows for training labels scheduled in [since, until).

    The window selects which rows get features; their history reaches back without bound. Only
    labels before ``until`` can be history, so that bound does reach the history scans.

    The two histories per time are staged: Spark then knows their size and broadcasts them while they
    are small, so that rows are exchanged once, by trip, and not for each history."""
    history = training if until is None else training.filter(F.col(AT) < until)
    rates = tb.stage(earlier_rate(route_hour_history(history)), "rates")
    headways = tb.stage(previous_arrivals(history), "headways")
    narrow = history.select(*LABEL_KEY, AT, "delay_seconds")
    wanted = with_local_time(with_previous_delays(narrow)).filter(lab.in_window(F.col(AT), since, until))
    known = F.col("trip_id").isNotNull() & F.col("service_date_norm").isNotNull()  # a null key has no history
    return (
        wanted.withColumn("current_delay_persistence_seconds", F.when(known, F.col("current_delay_persistence_seconds")))
        .join(rates, [*RATE_KEY, AT], "left")
        .join(headways, [*HEADWAY_KEY, AT], "left")
        .select(
            *LABEL_KEY,
            "route_hour_historical_late_rate",
            "headway_seconds",
            "hour_of_day",
            "day_of_week",
            "current_delay_persistence_seconds",
        )
    )


def training_set(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features joined to usable labels; a label excluded later drops out here."""
    usable = lab.training_labels(labels).select(*LABEL_KEY, AT, "delay_seconds", "late")
    return usable.join(features, LABEL_KEY)


def training_order(rows: DataFrame) -> DataFrame:
    """The total order of the training set: time first, then the whole key."""
    return rows.orderBy(AT, *LABEL_KEY)


def candidates(training: DataFrame, since=None, until=None) -> DataFrame:
    return training.filter(lab.in_window(F.col(AT), since, until)).agg(F.count(F.lit(1)).alias("candidate_rows"))


def written_in_window(features: DataFrame, training: DataFrame, since=None, until=None) -> DataFrame:
    """Feature rows whose key belongs to a usable label of the window."""
    keys = training.filter(lab.in_window(F.col(AT), since, until)).select(*LABEL_KEY)
    return features.join(keys, LABEL_KEY, "left_semi")


def horizon_delay(stop_events: DataFrame, horizon_seconds: float = 600.0) -> DataFrame:
    """Delay as predicted by the last snapshot at least ``horizon_seconds`` before schedule."""
    known = F.col("polled_at") <= tc.plus_seconds(F.col(AT), -horizon_seconds)
    rows = stop_events.withColumn("service_date_norm", tc.service_date_norm(F.col(AT))).filter(known)
    return rows.groupBy("trip_id", "stop_id", "service_date_norm").agg(
        F.max("polled_at").alias("horizon_polled_at"),
        F.max_by(
            tc.whole_seconds(tc.micros_between(F.col(AT), F.col("predicted_arrival"))), "polled_at"
        ).alias("horizon_delay_seconds"),
    )


def late_as_int(column: str = "late") -> Column:
    return F.col(column).cast("int")
