"""Running aggregates that no single task has to hold.

A plain ``Window.partitionBy(key).orderBy(t)`` puts a whole key into one task, so a key with a
third of all rows stalls the job, and an unpartitioned window puts everything into one. The
operators here first reduce rows to one per (key, order value) with a map-side combine, then
split each key into nested buckets of the order value. A window runs inside each bucket, another
over the much smaller bucket totals, and the results are joined. No window partition is larger
than the number of distinct order values in one bucket, or of buckets in one key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopline.functions.timecols import time_bucket

HOUR = 3600
DAY = 86400


def time_buckets(order: str, *seconds: int) -> list[Column]:
    """Nested time buckets, widest first; each width must divide the one before."""
    return [time_bucket(F.col(order), s) for s in seconds]


def score_buckets(order: str, bits: Sequence[int] = (10, 20)) -> list[Column]:
    """Nested buckets for doubles: about a thousand children per level for scores in [0, 1].

    Scaling by powers of two is exact on doubles, so the buckets nest and keep the order."""
    return [F.floor(F.col(order) * F.lit(2.0**b)).cast("long") for b in bits]


def _window(keys: Sequence[str], order: str) -> Window:
    spec = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return spec.orderBy(order)


def _bucketed(points: DataFrame, buckets: dict[str, Column]) -> DataFrame:
    """Points with their bucket columns. The null filter drops nothing (an order value is never
    null); stating it gives the row branch and the totals branch one plan, so the shuffle under
    both runs once."""
    known = reduce(lambda a, b: a & b, [F.col(b).isNotNull() for b in buckets])
    return points.withColumns(buckets).filter(known)


def prefix_sums(
    points: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str], buckets: Sequence[Column]
) -> DataFrame:
    """Add ``<c>_before``: the sum of ``c`` over strictly earlier order values of the same key.

    ``points`` holds one row per (keys, order); ``buckets`` are nested, order-preserving functions
    of the order column, widest first.
    """
    keys = list(keys)
    names = [f"_bucket{i}" for i in range(len(buckets))]
    base = _bucketed(points, dict(zip(names, buckets)))
    earlier = _window(keys + names, order).rowsBetween(Window.unboundedPreceding, -1)
    out = base.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in sums})
    totals = base
    carried = []
    for depth in reversed(range(len(names))):
        group = keys + names[: depth + 1]
        totals = totals.groupBy(*group).agg(*[F.sum(c).alias(c) for c in sums])
        before = _window(keys + names[:depth], names[depth]).rowsBetween(Window.unboundedPreceding, -1)
        carry = {c: f"_carry{depth}_{c}" for c in sums}
        out = out.join(
            totals.select(*group, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(carry[c]) for c in sums]),
            group,
        )
        carried.append(carry)
    for c in sums:
        total = F.col(f"_in_{c}")
        for carry in carried:
            total = total + F.col(carry[c])
        out = out.withColumn(f"{c}_before", total)
    return out.select(*points.columns, *[f"{c}_before" for c in sums])


def previous_point(
    points: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], bucket: Column | None
) -> DataFrame:
    """Add ``prev_<v>`` for each value: its value at the latest strictly earlier order value.

    ``points`` holds one row per (keys, order). Within a bucket this is a lag; the first point of
    a bucket takes the last point of the bucket before it. Without a bucket a plain lag runs per
    key, which is for keys that already bound their distinct order values.
    """
    keys = list(keys)
    if bucket is None:
        spec = _window(keys, order)
        return points.withColumns({f"prev_{v}": F.lag(v).over(spec) for v in values})
    base = _bucketed(points, {"_bucket": bucket})
    inside = _window(keys + ["_bucket"], order)
    rows = base.withColumns(
        {f"_lag_{v}": F.lag(v).over(inside) for v in values} | {"_rank": F.row_number().over(inside)}
    )
    last = base.groupBy(*keys, "_bucket").agg(*[F.max_by(v, order).alias(f"_last_{v}") for v in values])
    across = _window(keys, "_bucket")
    carried = last.select(
        *keys, "_bucket", *[F.lag(f"_last_{v}").over(across).alias(f"_carry_{v}") for v in values]
    )
    joined = rows.join(carried, keys + ["_bucket"])
    return joined.select(
        *points.columns,
        *[
            F.when(F.col("_rank") == 1, F.col(f"_carry_{v}")).otherwise(F.col(f"_lag_{v}")).alias(f"prev_{v}")
            for v in values
        ],
    )


def cumulative_counts(df: DataFrame, order: str, buckets: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, order value): ``n`` rows there and ``n_before`` rows at smaller values."""
    points = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("n"))
    return prefix_sums(points, list(keys), order, ["n"], buckets)


def median_of(counts: DataFrame, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact interpolating median from ``cumulative_counts``; no value list is ever collected.

    ``keys`` name a handful of series (features, candidates), so their totals are broadcast."""
    keys = list(keys)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    ranked = counts.join(F.broadcast(totals), keys) if keys else counts.withColumn("_total", totals.scalar())
    low = F.floor((F.col("_total") - 1) / 2)
    high = F.floor(F.col("_total") / 2)
    holds = lambda rank: (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
    value = F.col(order).cast("double")
    return ranked.groupBy(*keys).agg(
        ((F.max(F.when(holds(low), value)) + F.max(F.when(holds(high), value))) / 2).alias("median")
    )
