"""Inputs derived from the given tables."""

from pyspark.sql import functions as F

from stopline.session import work_path
from stopline.sources import derived as d

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


def test_order_lines_are_exchanged_once(spark):
    """The dedup and the join with orders share one exchange by order; the first line of a key is kept."""
    folder = work_path(spark, "given")
    line = lambda order, number, part, discount: (order, part, 1, number, 1.0, 1.0, discount, 0.0, "A", "O", None)
    lines = [line(1, 2, 9, 0.01), line(1, 2, 3, 0.05), line(2, 1, 1, 0.02), line(None, 1, 1, 0.02), line(3, None, 1, 0.02)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.range(1, 4).select(F.col("id").alias("o_orderkey"), F.lit("1995-01-05").cast("timestamp").alias("o_orderdate"))
    orders.write.parquet(f"{folder}/orders.parquet")
    found = d.labels(spark, folder)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_orderkey#" in plan
    assert "l_linenumber" not in "".join(p.split(")")[0] for p in plan.split("hashpartitioning(")[1:])
    assert sorted((r["trip_id"], r["stop_id"], r["delay_seconds"]) for r in found.collect()) == [("t1", "s2", 180), ("t2", "s1", 0)]
