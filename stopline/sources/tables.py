"""Idempotent writes to stored tables: insert-if-absent, upsert, append, verified rewrite.

Single writer per table. Stored tables are versioned (:mod:`stopline.sources.versioned`): a write adds
files and then moves one pointer, so a crash at any step leaves the old or the new version, whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.functions import timecols as tc
from stopline.session import work_path
from stopline.sources.versioned import Files, Table, Version

MONTH = "polled_month"
STAGED_BLOCK = 32 << 20  # row groups of staged tables, whose columns may be whole texts


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None while nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of the table at ``path``, or the plain Parquet files there; None while empty."""
    found = Table(spark, path).read()
    return read_or_none(spark, path) if found is None else found


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Remove the tables staged inside the block when it ends, but for those that a DataFrame put into the
    block's list still reads."""
    needed: list[DataFrame] = []
    _SCRATCH.append([])
    done = False
    try:
        yield needed
        done = True
    finally:
        staged = _SCRATCH.pop()
        read = {f for df in needed for f in df.inputFiles()} if done else set()
        for path in staged:
            name = path.rsplit("/", 1)[1]
            if not any(f"/{name}/" in f for f in read):
                Files(spark, path).remove(path)
            elif _SCRATCH:
                _SCRATCH[-1].append(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.option("parquet.block.size", STAGED_BLOCK).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """:func:`stage` of what ``build`` returns; callers that keep tables by name pass another function."""
    return stage(build(), name)


def with_month(df: DataFrame, column: str = "polled_at") -> DataFrame:
    """Monthly layout column; a month's folder appears on first write, so no row lacks a home."""
    return df.withColumn(MONTH, tc.month_of(F.col(column)))


def first_per_key(rows: DataFrame, key: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (by the whole row where none is given)."""
    others = [c for c in rows.columns if c not in key]
    rank = order if order else [F.col(c) for c in others]
    picked = rows.groupBy(*key).agg(F.min_by(F.struct(*others), F.struct(*rank)).alias("_row"))
    return picked.select(*key, "_row.*").select(*rows.columns)


def absent_rows(rows: DataFrame, existing: DataFrame | None, key: list[str]) -> DataFrame:
    return rows if existing is None else rows.join(existing.select(*key), key, "left_anti")


def insert_absent(
    rows: DataFrame,
    path: str,
    key: list[str],
    partition: str | None = None,
    order: list[Column] | None = None,
    clock: str | None = None,
) -> int:
    """Append rows whose key is not in the table yet; returns how many were appended.

    Within the batch the first row of a key wins, against the table the stored row wins. Stored keys are
    looked for in the partitions the batch touches. Where a key may lie in another partition,
    ``clock`` names a timestamp of the key: then every partition counts whose time range and bit filter
    of keys do not rule it out."""
    names = [c for c in rows.columns if c != "_order"]
    batch = first_per_key(rows, key, order).select(*names)
    return Table(rows.sparkSession, path, partition, clock).insert_absent(batch, key, anywhere=clock is not None)


def upsert(rows: DataFrame, path: str, key: list[str], partition: str | None = None) -> DataFrame:
    """Insert rows, replacing stored rows of the same key; returns the new rows as stored."""
    return Table(rows.sparkSession, path, partition).upsert(rows, key)


def append(rows: DataFrame, path: str) -> None:
    Table(rows.sparkSession, path).append(rows)


def log_rows(rows: DataFrame, path: str, key: list[str], clock: str, replace: bool) -> None:
    """Append to a log of rows merged on reading, by month of ``clock``; nothing stored is read."""
    monthly = with_month(rows, clock)
    Table(rows.sparkSession, path, MONTH).put(monthly, key, replace)


def keep_newest(table: DataFrame, order: str, keep: int) -> DataFrame:
    """The ``keep`` newest rows: a distributed top-k, each task hands on at most ``keep`` rows."""
    return table.orderBy(F.col(order).desc()).limit(keep)


def fingerprint(table: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and an order-free checksum that also notices repeated rows."""
    row_hash = F.xxhash64(*[F.col(c) for c in sorted(columns)]).cast("decimal(20,0)")
    return table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_hash), F.lit(0)).alias("checksum"))


def verified_rewrite(spark: SparkSession, path: str, watermark: Column) -> DataFrame:
    """Rewrite a snapshot table into the monthly layout and publish it only if it is complete.

    Rows up to the watermark are copied first, rows after it (arrived meanwhile) are caught up,
    then count and checksum must agree with the source. On a mismatch nothing is published. Every
    row is written once, in files sized by measured bytes; the pointer turns readers over, and the
    old files stay where they are. Returns the published fingerprint."""
    source = read(spark, path)
    columns = [c for c in source.columns if c != MONTH]
    table = Table(spark, path, MONTH, "polled_at")
    before, parts = table.current(), []
    early = F.coalesce(F.col("polled_at") <= watermark, F.lit(False))
    schema = with_month(source.select(*columns)).schema
    for part in (source.filter(early), source.filter(~early)):
        parts += table.write(with_month(part.select(*columns)))
    wanted = fingerprint(source, columns).first()
    copy = table.of_parts(Version(0, schema.json(), MONTH), parts)
    got = fingerprint(copy, columns).first()
    if wanted != got:
        raise RuntimeError(f"rewrite of {path} not published: source {wanted}, copy {got}")
    table.publish(before, parts, schema)
    return fingerprint(read(spark, path), columns)
