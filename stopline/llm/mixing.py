"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source's documents are shuffled by a hash of their id. A document copy gets a virtual finish
time: the words of its source up to and including it, earlier epochs counted, divided by the
source's target. All copies are ordered by virtual finish time and taken while the total stays
within the budget, so every source advances towards its target at the same relative pace.

Both orders are range sorts over the cluster: rows by source and shuffled place, then all copies by
virtual finish time. Range partitions hold like numbers of rows however the sources are sized, so no
source is ever in one task. A window sums inside each partition, the totals of earlier partitions are
carried in, and the sorted copies are cut where the running total passes the budget.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; a
document of size 0 is never taken and changes nothing. Rows that repeat an id and its text share
their place in the order and are taken or left together. An empty table gives an empty result.
Columns of any name pass through ``take``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopline.llm.common import WORD, stage, text_of, tidy

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
PART_ROWS = 20_000
MOST_PARTS = 50_000
FEW_ROWS = 2_000_000


def words_in(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``place``: the 0-based rank of the source, by range partitions and their row counts."""
    dealt = stage(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("pid", F.spark_partition_id()),
        "mix-sources",
    )
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("pid").orderBy(F.col("source").asc_nulls_last())
    return dealt.join(offsets, "pid").select(
        "source", "source_size", (F.col("offset") + F.row_number().over(inside) - 1).alias("place")
    )


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The budget is dealt by weight; what a source gets above ``epochs`` times its size is dealt
    again among the others, until none is above. Only sums come to the driver."""
    weight = reduce(
        lambda other, k: F.when(F.col("place") % len(weights) == k, F.lit(float(weights[k]))).otherwise(other),
        range(len(weights)),
        F.lit(0.0),
    )
    cap = F.col("source_size") * float(epochs)
    ranked = stage(_ranked(sources).select("source", "source_size", weight.alias("weight")), "mix-weights")
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped_before = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > cap
        capped, fixed, free = ranked.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if capped == capped_before or not free:
            break
        level, capped_before = (budget - fixed) / free, capped
    fair = F.col("weight") * float(level or 0.0)
    return ranked.select("source", "source_size", F.least(fair, cap).alias("target"))


def _sorted(rows: DataFrame, key: list[str], n: int, part_rows: int, name: str) -> DataFrame:
    """The rows in range partitions by the key, with the partition's number ``pid``; stored, so that a
    lost executor cannot deal them out again."""
    parts = max(1, min(MOST_PARTS, -(-n // part_rows)))
    return stage(rows.repartitionByRange(parts, *key).withColumn("pid", F.spark_partition_id()), name)


def _carried(dealt: DataFrame, by: list[str]) -> DataFrame:
    """Per partition (and value of ``by`` in it) the words in all earlier partitions: one row per partition
    at most, and one more for each border between two values."""
    earlier = Window.partitionBy(*by).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*by, "pid").agg(F.sum("size").alias("words"))
    names = [F.col(c).alias(f"_{c}") for c in [*by, "pid"]]
    return totals.select(*names, F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("carry"))


def _placed(slim: DataFrame, goals: DataFrame, part_rows: int) -> DataFrame:
    """Add the source's numbers and ``upto``: words of the source up to this row in shuffled order."""
    place = ["order", "doc_id", "size"]
    dealt = _sorted(slim, ["source", *place], slim.count(), part_rows, "mix-shuffled")
    inside = Window.partitionBy("pid", "source").orderBy(*place).rangeBetween(Window.unboundedPreceding, 0)
    within = dealt.withColumn("within", F.sum("size").over(inside))
    carried = _carried(dealt, ["source"])
    goal = goals.withColumnRenamed("source", "_g")
    return (
        within.join(carried, F.col("source").eqNullSafe(F.col("_source")) & (F.col("pid") == F.col("_pid")))
        .join(goal, F.col("source").eqNullSafe(F.col("_g")))
        .withColumn("upto", F.col("within") + F.col("carry"))
        .drop("_source", "_pid", "_g", "within", "carry", "pid")
    )


COPY = ["finish", "order", "doc_id", "epoch"]


def _cut(copies: DataFrame, budget: float, part_rows: int) -> tuple | None:
    """The last copy taken as (finish, order, doc_id, epoch), or None if nothing fits: all copies sorted
    by virtual finish time, summed up and cut at the budget. One row comes to the driver."""
    dealt = _sorted(copies, COPY, copies.count(), part_rows, "mix-sorted")
    carried = _carried(dealt, [])
    inside = Window.partitionBy("pid").orderBy(*COPY).rangeBetween(Window.unboundedPreceding, 0)
    total = F.sum("size").over(inside) + F.col("carry")
    running = dealt.join(carried.filter(F.col("carry") <= budget), F.col("pid") == F.col("_pid")).withColumn("total", total)
    best = running.filter(F.col("total") <= budget).agg(F.max(F.struct(*COPY))).first()[0]
    return None if best is None else tuple(best)


@tidy
def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = MOST_EPOCHS,
    seed: int = 42,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, ``copies`` (times the mix
    takes it), ``taken`` (words it takes) and ``row_key``, a hash of the row's id, source and text.
    Runs agree: the order is a hash of id and seed."""
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        words_in(text_col).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("order"),
        row_key(id_col, text_col, source_col).alias("row_key"),
    )
    slim = stage(slim, "mix-sizes")
    goals = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs)
    placed = stage(_placed(slim, goals, part_rows), "mix-placed")
    finish = [((F.col("upto") + F.col("source_size") * e) / F.col("target")) for e in range(epochs)]
    able = (F.col("size") > 0) & (F.col("target") > 0)
    copy = F.array(*[F.struct(f.alias("finish"), F.lit(e).alias("epoch")) for e, f in enumerate(finish)])
    copies = placed.filter(able).select("doc_id", "order", "size", F.explode(copy).alias("c")).select(
        "doc_id", "order", "size", "c.finish", "c.epoch"
    )
    budget = goals.agg(F.sum("target")).first()[0] or 0.0
    cut = _cut(copies, budget, part_rows)
    count = F.lit(0)
    if cut is not None:
        limit = F.struct(
            F.lit(cut[0]).alias("finish"), F.lit(cut[1]).cast("long").alias("order"),
            F.lit(cut[2]).cast(docs.schema[id_col].dataType).alias("doc_id"), F.lit(cut[3]).alias("epoch"),
        )
        for e, f in enumerate(finish):
            mine = F.struct(f.alias("finish"), F.col("order"), F.col("doc_id"), F.lit(e).alias("epoch"))
            count = count + F.when(able & (mine <= limit), 1).otherwise(0)
    return placed.withColumn("copies", count).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), "row_key"
    )


def row_key(id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Column:
    """Rows with the same key are taken as often as each other."""
    return F.xxhash64(F.col(id_col), F.col(source_col), text_of(text_col))


def take(
    docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The input rows as often as the mix takes them. ``mixed`` comes from ``mix`` on the same rows.

    While the rows taken are at most ``FEW_ROWS`` their numbers are broadcast and texts stay where they are;
    beyond that both sides are shuffled by id."""
    times = stage(mixed.filter("copies > 0").select("doc_id", "row_key", "copies").distinct(), "mix-taken")
    times = F.broadcast(times) if times.count() <= FEW_ROWS else times
    key = row_key(id_col, text_col, source_col)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), key.alias("key"))
    joined = rows.join(times, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("row_key")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
