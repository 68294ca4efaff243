import random

from pyspark.sql import functions as F

from stopline.operators import contract as ct
from stopline.operators import predictions as pr
from stopline.operators import status
from tests import feed
from tests.conftest import at, plus

T = at("2026-08-12 16:00:00")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_ids_are_exact_without_multiplying_rows(spark, events):
    rng = random.Random(1)
    rows = [
        dict(route_id=rng.choice(["1", "2", None]), trip_id=f"t{rng.randrange(40)}", stop_id=rng.choice(["a", "b", "c", None]), polled_at=plus(T, k), scheduled_arrival=rng.choice([T, None]))
        for k in range(400)
    ]
    df = events(*rows)
    names = lambda c: len({r[c] for r in rows} - {None})
    got = status.distinct_counts(df).first()
    assert tuple(got) == (400, names("route_id"), names("trip_id"), names("stop_id"))
    assert "Expand" not in plan(status.distinct_counts(df))
    full = status.ingest_summary(df, F.lit(plus(T, 3700)).cast("timestamp"))
    assert "Expand" not in plan(full)
    r = full.first()
    nulls = sum(x["scheduled_arrival"] is None for x in rows)
    assert (r["total_rows"], r["last_hour_rows"], r["scheduled_arrival_null"], r["predicted_arrival_null"]) == (400, 300, nulls, 400)
    assert r["scheduled_arrival_null_pct"] == f"{nulls / 4:.2f}%" and r["min_polled_at"].minute == T.minute


def test_an_empty_table_counts_nothing(events):
    none = events(dict(polled_at=T)).filter("false")
    assert tuple(status.distinct_counts(none).first()) == (0, 0, 0, 0)
    r = status.ingest_summary(none, F.lit(T).cast("timestamp")).first()
    assert (r["total_rows"], r["min_polled_at"], r["scheduled_arrival_null_pct"]) == (0, None, "n/a")


def test_a_cycle_of_100000_violations_is_one_ordered_text(spark):
    n = 100_000
    found = spark.range(n, numPartitions=8).select(
        F.lit(T).cast("timestamp").alias("polled_at"), (F.col("id") % 2).cast("int").alias("batch"), (F.col("id") % 5 + 1).cast("int").alias("page_no"),
        F.lit("data").alias("section"), F.col("id").cast("int").alias("idx"), F.lit(0).alias("seq"), F.lit("id").alias("path"),
        F.lit("top_level").alias("clause"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("expected"),
        F.lit("prediction").alias("kind"),
    )
    pages = spark.createDataFrame([(T, b, p, True, False) for b in (0, 1) for p in range(1, 6)], "polled_at timestamp, batch int, page_no int, readable boolean, more boolean")
    failed = spark.createDataFrame([], "polled_at timestamp, batch int, why string")
    (row,) = pr.cycle_errors(pages, found, failed).collect()
    lines = row["error"].split("; ")
    want = sorted((k % 2, k % 5 + 1, k) for k in range(n))
    assert len(lines) == n and all(f"data[{k}]" in line for line, (_, _, k) in zip(lines, want))
