"""Whole-table checks that the stored features never saw their own time or later.

They recompute by another route than the build: plain windows over per-time totals, ranked
minima and newest contributors, all on rows already reduced to one per distinct time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopline.operators import features as feat
from stopline.sources import tables as tb

TOLERANCE = 1e-9
RATE = "route_hour_historical_late_rate"


def _featured(features: DataFrame, labels: DataFrame) -> DataFrame:
    return feat.training_set(features, labels).select(*feat.RATE_KEY, feat.AT, "late", RATE)


def running_before(points: DataFrame, segments: int) -> DataFrame:
    """Add ``n_before``, ``k_before`` and ``newest``: sums over strictly earlier times of the same key, and the
    latest of those times.

    Times are cut into ranges of like size, by quantiles of all times. A plain window runs inside
    each (key, range); what lies in a key's earlier ranges is carried in, from one total per range. So
    a key with a third of all rows is ``segments`` windows instead of one. ``points`` is read several
    times, so it should be stored."""
    at = F.unix_micros(feat.AT)
    cuts = points.agg(F.percentile_approx(at, [k / segments for k in range(1, segments)], 10 * segments).alias("cuts"))
    cuts = F.coalesce(cuts.scalar(), F.array().cast("array<long>"))
    placed = points.withColumn("cuts", cuts).withColumn("part", F.size(F.filter("cuts", lambda c: c < at))).drop("cuts")
    key = [*feat.RATE_KEY, "part"]
    inside = Window.partitionBy(*key).orderBy(feat.AT).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*feat.RATE_KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max(feat.AT).alias("last"))
    carried = totals.select(
        *key, F.sum("n").over(across).alias("_n"), F.sum("k").over(across).alias("_k"), F.max("last").over(across).alias("_last")
    )
    local = placed.withColumns(
        {"n_in": F.sum("n").over(inside), "k_in": F.sum("k").over(inside), "last_in": F.max(feat.AT).over(inside)}
    )
    both = lambda c: F.coalesce(f"{c}_in", F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))
    return local.join(carried, key).select(
        *points.columns, both("n").alias("n_before"), both("k").alias("k_before"), F.greatest("last_in", "_last").alias("newest")
    )


def point_totals(features: DataFrame, labels: DataFrame, segments: int = 32) -> DataFrame:
    """One row: rows compared, rows whose stored rate differs from one recomputed over the featured rows,
    and rows with a contributor at or after their own time.

    Featured rows are reduced to one per (bucket, time) with the least and largest stored rate there;
    every step from there on is the checks' own and shares nothing with the build. Where those two
    differ, the rows of that time are looked at one by one."""
    rate, known = F.col(RATE), F.count(RATE)
    featured = _featured(features, labels)
    points = featured.groupBy(*feat.RATE_KEY, feat.AT).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("late").cast("int")).alias("k"),
        known.alias("known"), F.min(rate).alias("low"), F.max(rate).alias("high"),
    )
    points = tb.stage(points, "check-points")
    again = F.try_divide(F.col("k_before"), F.col("n_before"))
    run = running_before(points, segments).withColumn("again", again)
    off = lambda c: F.coalesce(F.abs(c - F.col("again")) > TOLERANCE, F.lit(True))
    lost = F.when(F.col("again").isNotNull(), F.col("n") - F.col("known")).otherwise(0)
    alike = F.col("low").eqNullSafe(F.col("high"))
    wrong = lost + F.when(alike & off(F.col("low")), F.col("known")).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    future = F.when(F.col("newest") >= F.col(feat.AT), F.col("n"))
    summed = run.agg(total("n").alias("compared"), total(wrong).alias("mismatches"), total(future).alias("from_the_future"))
    mixed = points.filter(~alike)
    if mixed.isEmpty():
        return summed
    key = [*feat.RATE_KEY, feat.AT]
    rows = featured.filter(rate.isNotNull()).join(run.filter(~alike).select(*key, "again"), key)
    more = rows.agg(F.count_if(off(rate)).alias("more")).scalar()
    return summed.withColumn("mismatches", F.col("mismatches") + more)


def recompute_check(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows compared, and those whose stored rate differs from one recomputed by another route."""
    return point_totals(features, labels).select("compared", "mismatches")


def null_arithmetic(features: DataFrame, training: DataFrame) -> DataFrame:
    """Null rates against the rows tied for earliest in their (route, hour) bucket."""
    per_time = feat.with_local_time(training).groupBy(*feat.RATE_KEY, feat.AT).agg(F.count(F.lit(1)).alias("n"))
    firsts = per_time.groupBy(*feat.RATE_KEY).agg(F.min_by("n", feat.AT).alias("n"))
    nulls = features.filter(F.col(RATE).isNull()).agg(F.count(F.lit(1)).alias("null_rates"))
    first_rows = firsts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("first_in_bucket"))
    return nulls.withColumn("first_in_bucket", first_rows.scalar())


def newest_contributor(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with a contributing label scheduled at or after the row itself (must be none)."""
    return point_totals(features, labels).select(F.col("compared").alias("checked"), "from_the_future")


def point_in_time_checks(features: DataFrame, labels: DataFrame, training: DataFrame) -> DataFrame:
    """The three checks as (check_name, passed, compared, violations) rows."""
    totals = tb.stage(point_totals(features, labels), "check-totals")  # one row
    a = totals.select(
        F.lit("independent_recomputation").alias("check_name"),
        (F.col("mismatches") == 0).alias("passed"),
        F.col("compared"),
        F.col("mismatches").alias("violations"),
    )
    b = null_arithmetic(features, training).select(
        F.lit("null_arithmetic").alias("check_name"),
        (F.col("null_rates") == F.col("first_in_bucket")).alias("passed"),
        F.col("null_rates").alias("compared"),
        F.abs(F.col("null_rates") - F.col("first_in_bucket")).alias("violations"),
    )
    c = totals.select(
        F.lit("no_future_in_the_past").alias("check_name"),
        (F.col("from_the_future") == 0).alias("passed"),
        F.col("compared"),
        F.col("from_the_future").alias("violations"),
    )
    return a.unionByName(b).unionByName(c)
