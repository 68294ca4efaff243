"""Approximate nearest neighbours by inner product with an inverted multi-index.

Each vector is split into halves, and each half is quantised on its own; a pair of centroids is a
cell. A query visits cells in order of their summed distance (here: the negative inner product with
the two centroids), taken from a heap over the two sorted distance lists, until the cells visited
hold ``visit`` of all entries, and enough for ``k`` neighbours. Every entry of a visited cell is scored exactly, in double precision.

Codebooks come from a bounded sample; every row is indexed. Cells with the same first centroid form
a group; groups are dealt out in chunks of bounded size and queries in blocks of bounded size, so
one task holds one chunk and one block however many rows share a cell. Only the codebooks and one
count per cell are broadcast: their size does not depend on the number of rows.

Defined results: a null or zero vector, one with a null or non-finite component, or one whose length
is not the index's takes no part. Rows with the query's own id are not its neighbours; of rows that
repeat an id the nearest counts. Ties go to the smaller id. Queries with repeated ids are answered
once. With no valid vector the result is empty.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import stage

CENTROIDS = 32
SAMPLE_ROWS = 20_000
ITERATIONS = 10
VISIT = 0.6
CHUNK_ROWS = 8192
BLOCK_QUERIES = 2048


def valid(column: str, length: int | None = None) -> Column:
    v = F.col(column)
    number = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    ok = v.isNotNull() & (F.size(v) > 0) & number & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok & (F.size(v) == length) if length else ok, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return np.ascontiguousarray(flat.reshape(n, -1) if n else flat.reshape(0, 1))


def k_means(points: np.ndarray, k: int, iterations: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(iterations):
        near = nearest(points, centres)
        for c in range(len(centres)):
            mine = points[near == c]
            if len(mine):
                centres[c] = mine.mean(axis=0)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def codebooks(vectors: DataFrame, centroids: int, sample_rows: int, iterations: int) -> list[np.ndarray]:
    """One codebook per half, from the ``sample_rows`` rows with the smallest hash of their id."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").toArrow()
    points = matrix(sample.column("vector"))
    half = max(1, points.shape[1] // 2)
    return [k_means(part, centroids, iterations, seed) for seed, part in enumerate((points[:, :half], points[:, half:]))]


def _celled(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = books.value
        for batch in batches:
            points = matrix(batch.column("vector"))
            half = first.shape[1]
            a, b = (nearest(points[:, :half], first), nearest(points[:, half:], second)) if len(points) else ([], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(a, pa.int32()), pa.array(b, pa.int32())],
                names=["vec_id", "vector", "a", "b"],
            )

    return run


def traverse(first: np.ndarray, second: np.ndarray, held: np.ndarray, enough: int) -> Iterator[tuple[int, int]]:
    """Cells by summed distance, until those given hold ``enough`` entries.

    A heap over the two sorted lists: a cell is pushed when its neighbours before it are out."""
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    d1, d2 = first[one].tolist(), second[two].tolist()
    one, two = one.tolist(), two.tolist()
    heap, reach, seen = [(d1[0] + d2[0], 0, 0)], [-1] * len(d1), 0
    while heap and seen < enough:
        _, i, j = heapq.heappop(heap)
        reach[i] = j  # row i has given its cells up to j
        yield one[i], two[j]
        seen += held[one[i], two[j]]
        if j + 1 < len(d2) and (i == 0 or reach[i - 1] > j):
            heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))
        if i + 1 < len(d1) and reach[i + 1] == j - 1:
            heapq.heappush(heap, (d1[i + 1] + d2[j], i + 1, j))


def _visits(shared, enough: int):
    """Per query and group: which second centroids it visits there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, held = shared.value
        half = first.shape[1]
        for batch in batches:
            points = matrix(batch.column("vector"))
            rows, groups, cells = [], [], []
            for k, q in enumerate(points):
                seen: dict[int, list[int]] = {}
                for a, b in traverse(-(first @ q[:half]), -(second @ q[half:]), held, enough):
                    if held[a, b]:
                        seen.setdefault(a, []).append(b)
                for a, bs in seen.items():
                    rows.append(k)
                    groups.append(a)
                    cells.append(bs)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(rows), batch.column("vector").take(rows), pa.array(groups, pa.int32()),
                 pa.array(cells, pa.list_(pa.int32()))],
                names=["query_id", "query", "a", "cells"],
            )

    return run


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, best first, ties to the smaller id; ``ids`` ascend."""
    if len(scores) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > limit)
        chosen = np.concatenate([above, np.flatnonzero(scores == limit)[: k - len(above)]])
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))]


def nearest_of_each(scores: np.ndarray, ids: np.ndarray, may: np.ndarray) -> np.ndarray:
    """Of the positions ``may`` the best one of each id, by id."""
    may = may[np.lexsort((-scores[may], ids[may]))]
    return may[np.flatnonzero(np.diff(ids[may], prepend=ids[may][:1] - 1))]


def _scored(k: int, centroids: int):
    """One chunk of entries against one block of queries: the k best of each query there."""

    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        ids = entries.column("vec_id").to_numpy() if len(entries) else np.zeros(0, np.int64)
        order = np.argsort(ids, kind="stable")
        points = matrix(entries.column("vector"))[order]
        ids, cell = ids[order], entries.column("b").to_numpy()[order]
        repeats = bool((ids[1:] == ids[:-1]).any())
        out_q, out_ids, out_scores = [], [], []
        asked = matrix(queries.column("query"))
        for start in range(0, len(queries), 256):
            # einsum adds each pair's products in one fixed order, so equal vectors score equally
            scores = np.einsum("qd,nd->qn", asked[start : start + 256], points)
            names = queries.column("query_id")[start : start + 256].to_pylist()
            for name, row, cells in zip(names, scores, queries.column("cells")[start : start + 256].to_pylist()):
                visited = np.zeros(centroids, bool)
                visited[cells] = True
                may = np.flatnonzero(visited[cell] & (ids != name))
                if repeats:
                    may = nearest_of_each(row, ids, may)
                top = may[best(row[may], ids[may], k)]
                out_q.append(name)
                out_ids.append(ids[top])
                out_scores.append(row[top])
        return pa.table(
            {"query_id": pa.array(out_q, pa.int64()), "ids": pa.array(out_ids, pa.list_(pa.int64())),
             "scores": pa.array(out_scores, pa.list_(pa.float64()))}
        )

    return run


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    sample_rows: int = SAMPLE_ROWS,
    iterations: int = ITERATIONS,
    visit: float = VISIT,
    chunk_rows: int = CHUNK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row that ``queries`` selects."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.filter(F.col(id_col).isNotNull() & valid(vector_col)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), queries.alias("asked")
    )
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return empty
    rows = rows.filter(F.size("vector") == common.n)
    books = codebooks(rows, centroids, sample_rows, iterations)
    kind = rows.schema["vector"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(books)
    celled = rows.select("vec_id", "vector").mapInArrow(_celled(shared), f"vec_id long, vector {kind}, a int, b int")
    celled = stage(celled, "ann-cells")
    held = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in celled.groupBy("a", "b").count().toLocalIterator():
        held[r.a, r.b] = r["count"]
    asked = rows.filter("asked").select("vec_id", "vector").dropDuplicates(["vec_id"])
    # the query's own row and repeats of ids among the entries seen must not leave fewer than k
    repeated = int(held.sum()) - celled.select("vec_id").distinct().count()
    enough = max(math.ceil(held.sum() * visit), k + 1 + repeated)
    visits = asked.mapInArrow(
        _visits(spark.sparkContext.broadcast((*books, held)), enough), f"query_id long, query {kind}, a int, cells array<int>"
    )
    blocks = max(1, math.ceil(asked.count() / block_queries))
    chunks = [max(1, math.ceil(int(n) / chunk_rows)) for n in held.sum(axis=1)]
    chunks_of = F.element_at(F.array(*[F.lit(n) for n in chunks]), F.col("a") + 1)
    salt = lambda column, n: F.pmod(F.xxhash64(column, F.lit(7)), n).cast("int")
    # each chunk of a group meets each block of the queries that visit the group
    entries = celled.withColumn("chunk", salt("vec_id", chunks_of)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    meets = visits.withColumn("block", salt("query_id", F.lit(blocks))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), chunks_of - 1))
    )
    keys = ["a", "chunk", "block"]
    parts = entries.groupBy(*keys).cogroup(meets.groupBy(*keys)).applyInArrow(
        _scored(k, len(books[1])), "query_id long, ids array<long>, scores array<double>"
    )
    flat = parts.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("e"))
    flat = flat.groupBy("query_id", F.col("e.ids").alias("vec_id")).agg(F.max("e.scores").alias("score"))
    nearest_first = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score")))
    top = flat.groupBy("query_id").agg(F.slice(nearest_first, 1, k).alias("top"))
    return top.select("query_id", F.posexplode("top").alias("pos", "e")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score")
    )
