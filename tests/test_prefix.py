import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopline.operators import prefix


def brute_force(rows, width):
    """(key, order) -> (sum, previous order) over strictly smaller orders of the key."""
    out = {}
    for key, order, _ in rows:
        smaller = [(o, v) for k, o, v in rows if k == key and o < order]
        out[key, order] = (sum(v for _, v in smaller), max((o for o, _ in smaller), default=None))
    return out


def run(spark, rows, width):
    points = spark.createDataFrame(rows, "key string, at long, v long").groupBy("key", "at").agg(F.sum("v").alias("v"))
    bucket = F.floor(F.col("at") / width).cast("long")
    coarse = F.floor(F.col("at") / (width * 10)).cast("long")
    sums = prefix.prefix_sums(points, ["key"], "at", ["v"], [coarse, bucket])
    last = prefix.previous_point(points.withColumn("o", F.col("at")), ["key"], "at", ["o"], bucket)
    both = sums.join(last.select("key", "at", "prev_o"), ["key", "at"])
    return {(r["key"], r["at"]): (r["v_before"], r["prev_o"]) for r in both.collect()}


def test_hot_key_matches_brute_force(spark):
    rng = random.Random(7)
    # A third of all rows share one key, and a third of those share one order value.
    rows = [("hot" if i % 3 == 0 else f"k{i % 17}", 50 if i % 9 == 0 else rng.randrange(400), i % 5) for i in range(900)]
    assert run(spark, rows, 7) == brute_force(rows, 7)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-60, 60), st.integers(0, 3)), min_size=1, max_size=40))
def test_any_points_match_brute_force(spark, rows):
    assert run(spark, rows, 5) == brute_force(rows, 5)


def test_exact_median_with_and_without_keys(spark):
    for values, wanted in (([3.0], 3.0), ([1.0, 9.0], 5.0), ([5.0, 1.0, 5.0, 7.0, 900.0], 5.0), ([-2.5, 0.1, 0.3, 8.0], 0.2)):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        counts = prefix.cumulative_counts(df, "v", prefix.score_buckets("v", bits=(-4, 0, 10)))
        assert abs(prefix.median_of(counts, "v").first()[0] - wanted) < 1e-12
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 7.0)], "k string, v double")
    counts = prefix.cumulative_counts(df, "v", prefix.score_buckets("v"), ["k"])
    assert {r["k"]: r["median"] for r in prefix.median_of(counts, "v", ["k"]).collect()} == {"a": 1.5, "b": 7.0}


def test_median_of_nothing_is_null(spark):
    counts = prefix.cumulative_counts(spark.createDataFrame([], "v double"), "v", prefix.score_buckets("v"))
    assert prefix.median_of(counts, "v").first()[0] is None
