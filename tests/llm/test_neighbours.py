import numpy as np
from pyspark.sql import functions as F

from stopline.llm import neighbours as nn

KIND = "vec_id long, embedding array<double>, vector string, a string, score string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], KIND).repartition(3)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, k):
    rows = [(i, np.array(v, float)) for i, v in rows if usable(v)]
    out = []
    for q, x in rows:
        if q % 20 == 0:
            near = sorted((-float(x @ y), i) for i, y in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return sorted(out)


def vectors(n, seed=3, length=6):
    """Small whole numbers: scores are exact and often tie."""
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.integers(-3, 4, length)]) for i in range(n)]


def test_all_cells_visited_equals_brute_force_with_ties(spark):
    rows = vectors(300) + [(1000 + i, [2.0, 1.0, 0.0, 0.0, 0.0, 1.0]) for i in range(120)]
    got = nn.search(table(spark, rows), F.col("vec_id") % 20 == 0, visit=1.0, centroids=8, chunk_rows=37, block_queries=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_vectors_that_take_no_part(spark):
    bad = [None, [0.0] * 6, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0], []]
    rows = vectors(60) + [(20 * (50 + k), v) for k, v in enumerate(bad)]
    other_length = [(20 * 90, [9.0, 9.0])]
    got = nn.search(table(spark, rows + other_length), F.col("vec_id") % 20 == 0, visit=1.0, centroids=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_repeated_rows_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [0.0, 1.0])]
    got = nn.search(table(spark, rows), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 5.0), (0, 2, 2, 2.0)]
    assert nn.search(table(spark, rows).filter("false"), F.lit(True)).collect() == []


def test_more_than_k_repeats_of_near_ids_leave_room_for_the_next(spark):
    near = [(1, [9.0, 9.0, 0.0, 0.0])] * 9 + [(2, [8.0, 8.0, 0.0, float(j)]) for j in range(7)]
    rows = [(0, [1.0, 1.0, 0.0, 1.0]), *near, *[(10 + j, [7.0 - j, 1.0, 0.0, 0.0]) for j in range(6)]]
    best = {}
    for i, v in rows[1:]:
        best[i] = max(best.get(i, -99.0), v[0] + v[1] + v[3])
    want = sorted((-s, i) for i, s in best.items())[:4]
    got = nn.search(table(spark, rows), F.col("vec_id") == 0, k=4, visit=1.0, centroids=1)
    assert sorted(map(tuple, got.collect())) == [(0, n + 1, i, -s) for n, (s, i) in enumerate(want)]


def test_cells_come_in_order_of_their_summed_distance():
    rng = np.random.default_rng(5)
    first, second = rng.random(7), rng.random(5)
    cells = list(nn.traverse(first, second, np.ones((7, 5), int), 35))
    sums = [first[a] + second[b] for a, b in cells]
    assert len(set(cells)) == 35 and sums == sorted(sums)
    assert len(list(nn.traverse(first, second, np.ones((7, 5), int), 10))) == 10


def test_recall_on_given_vectors(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given.select("vec_id", "embedding").collect()]
    want = {(q, i) for q, _, i, _ in brute(rows, 20)}
    got = {(r.query_id, r.vec_id) for r in nn.search(given, F.col("vec_id") % 20 == 0).collect()}
    assert len(got & want) >= 0.9 * len(want)
