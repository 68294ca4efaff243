from stopline.llm import common


def test_a_join_without_frequent_keys_broadcasts_nothing(spark):
    table = spark.range(400).selectExpr("id as k", "id * 7 as v")
    for hot in (0, 1000):
        rows = spark.createDataFrame([(k % 400, k) for k in range(800)] + [(None, 1)] + [(5, k) for k in range(hot)], "k long, x long")
        for how in ("inner", "left"):
            got = common.salted_join(rows, table, "k", how)
            assert got.columns == ["k", "x", "v"]
            assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(table, "k", how).collect()))
            assert ("strategy=broadcast" in got._jdf.queryExecution().analyzed().toString()) == (hot > 0)
