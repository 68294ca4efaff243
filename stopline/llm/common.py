"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
import stopline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.sources.tables import scratch, stage

WHITE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
LEAST_HOT = 256  # rows of one key that no join deals out


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's code to the executors, once per application, as any job would."""
    name = spark.sparkContext.applicationId
    if name not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(stopline.__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "stopline")
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", root, "stopline"))
        _SHIPPED.add(name)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that no model may learn from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def bit_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """A one-hash filter of 2**bits bits as (word, mask) rows: at most 2**(bits-6) rows of 16 bytes,
    whatever the number of keys, so it may be broadcast or collected. ``key`` is a long column."""
    slot = F.pmod(F.col(key), F.lit(1 << bits))
    one = F.expr("shiftleft(1L, cast(_slot & 63 as int))")
    return (
        keys.select(slot.alias("_slot"))
        .select(F.shiftright("_slot", 6).alias("word"), one.alias("_bit"))
        .groupBy("word")
        .agg(F.bit_or("_bit").alias("mask"))
    )


def filter_bits(keys: int, per_key: int = 16, most: int = 26) -> int:
    """Bits for that many keys, as a power of two; at most 2**most bits (16 MB of rows to broadcast)."""
    return min(most, max(10, (per_key * keys).bit_length()))


def with_candidate(rows: DataFrame, key: str, filter_rows: DataFrame, bits: int, name: str) -> DataFrame:
    """Add boolean ``name``: whether the key may be in the filter (never a false no)."""
    slot = F.pmod(F.col(key), F.lit(1 << bits))
    words = F.broadcast(filter_rows.withColumnRenamed("word", "_word").withColumnRenamed("mask", "_mask"))
    hit = F.expr("coalesce(shiftright(_mask, cast(_slot & 63 as int)) & 1L, 0L) = 1L")
    return (
        rows.withColumn("_slot", slot)
        .withColumn("_word", F.shiftright("_slot", 6))
        .join(words, "_word", "left")
        .withColumn(name, hit)
        .drop("_slot", "_word", "_mask")
    )


def salted_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", share: int = 200) -> DataFrame:
    """``rows`` joined with a table that has one row per key, however many rows share a key.

    A key with more than 1/``share`` of the rows, and more than ``LEAST_HOT``, is dealt out in slices of that
    size, and its one row of the table is repeated for each. Fewer than ``share`` keys can be that frequent, so
    the list of them is small whatever the data; without any it is a plain join, which costs the driver no
    broadcasts. ``rows`` is read twice, so it should be stored."""
    total = rows.count()
    limit = max(LEAST_HOT, total // share)
    if total <= limit:
        return rows.join(table, key, how)
    slices = F.ceil(F.col("n") / limit).cast("int").alias("_slices")
    hot = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("n"))
    found = hot.filter(F.col("n") > limit).select("_hot", slices)
    listed = found.collect()
    if not listed:
        return rows.join(table, key, how)
    few = rows.sparkSession.createDataFrame(listed, found.schema)
    n = F.coalesce("_slices", F.lit(1))
    spread = F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), n).cast("int")
    one = rows.join(F.broadcast(few), F.col(key) == F.col("_hot"), "left").withColumn("_salt", spread).drop("_hot", "_slices")
    two = table.join(F.broadcast(few), F.col(key) == F.col("_hot"), "left")
    two = two.withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_hot", "_slices")
    return one.join(two, [key, "_salt"], how).drop("_salt")


def lean(run):
    """A function of Arrow batches whose worker gives its memory back when the task ends.

    Workers are kept for later tasks, so what their allocators hold on to after one stage would stand
    beside the memory of all stages that follow."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
                trim(0)

    return task


def tidy(operator):
    """An operator that removes its staged tables when it returns, but for those its result reads."""

    @wraps(operator)
    def run(docs: DataFrame, *args, **named):
        with scratch(docs.sparkSession) as needed:
            out = operator(docs, *args, **named)
            needed += [d for d in (out, getattr(out, "table", None)) if isinstance(d, DataFrame)]
        return out

    return run


__all__ = [
    "WHITE", "WORD", "bit_filter", "filter_bits", "held_out", "lean", "salted_join", "ship", "stage", "table", "text_of", "tidy", "with_candidate",
]
