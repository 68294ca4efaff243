"""Versioned Parquet tables: immutable folders of files, and one small pointer that readers resolve.

A write puts its rows under a folder of its own, ``data/batch=<id>``, once and for good. It then
publishes the next version: a small file ``versions/<number>.json`` that lists, for each partition
directory, its rows, bytes and time range. Creating that file is the only step that changes what
readers see; it fails if the number exists, so a second writer notices. A crash before it leaves the
old version in place and an unlisted folder, which :meth:`Table.vacuum` removes. Nothing is ever
overwritten or renamed, so a reader keeps the files of the version it has resolved.

A table with a ``merge`` key is a log: writers only append their own rows, and readers take one row per
key, the newest that replaces or else the first that was inserted. Months with many small parts are
merged into one now and then.

Everything lies under ``<path>/_table``, which plain Parquet readers of ``<path>`` skip, so a plain table
can be rewritten in place and turned over by its first version.

Files are laid out by measured bytes: rows of a partition are counted, bytes per row are taken from
what is stored already or from a small trial write, and each file gets its share. However small rows are
written, a file has a bounded number of them, since its task holds them unpacked.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.session import work_path

TARGET_BYTES = 128 << 20
MOST_ROWS = 2_000_000  # to a file: its task sorts its rows by partition, and rows in memory compress by nothing
TRIAL_ROWS = 20_000
KEPT_VERSIONS = 2
MOST_PARTS = 64
SEQUENCE, REPLACES = "_seq", "_replaces"
BATCH = "batch"
KEY_BITS = 32
WORD_BITS = 5


class Files:
    """The few file system calls a table needs, on whatever store the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop, self.conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)
        self.jvm = spark._jvm

    def path(self, path: str):
        return self.hadoop.Path(path)

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(path))] if self.fs.exists(self.path(path)) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a new file; fails if it exists."""
        stream = self.fs.create(self.path(path), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def size(self, path: str) -> int:
        return self.fs.getContentSummary(self.path(path)).getLength()

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


@dataclass
class Part:
    """One partition directory of one batch; ``directory`` is '' in a table without partitions."""

    batch: str
    directory: str
    rows: int
    bytes: int
    low: str | None = None
    high: str | None = None


@dataclass
class Version:
    number: int
    schema: str
    partition: str | None
    parts: list[Part] = field(default_factory=list)
    merge: list[str] | None = None

    def rows(self) -> int:
        return sum(p.rows for p in self.parts)


class Table:
    """A table at ``path``. ``clock`` names a timestamp column whose range is kept for each part."""

    def __init__(self, spark: SparkSession, path: str, partition: str | None = None, clock: str | None = None):
        self.spark, self.path, self.partition, self.clock = spark, f"{path.rstrip('/')}/_table", partition, clock
        self.files = Files(spark, path)

    # --- reading

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/versions") if n.endswith(".json") and n[:-5].isdigit())

    def current(self) -> Version | None:
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else None

    def version(self, number: int) -> Version:
        stored = json.loads(self.files.read(f"{self.path}/versions/{number}.json"))
        return Version(stored["number"], stored["schema"], stored["partition"], [Part(**p) for p in stored["parts"]], stored["merge"])

    def _folder(self, part: Part) -> str:
        return f"{self.path}/data/{BATCH}={part.batch}" + (f"/{part.directory}" if part.directory else "")

    def of_parts(self, version: Version, parts: list[Part]) -> DataFrame:
        """The rows of some parts, in the columns of the table."""
        schema = T.StructType.fromJson(json.loads(version.schema))
        if not parts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*[self._folder(p) for p in parts]).select(*schema.names)

    def read(self, number: int | None = None) -> DataFrame | None:
        """All rows of the current (or a given) version; None before the first one."""
        version = self.current() if number is None else self.version(number)
        if version is None:
            return None
        rows = self.of_parts(version, version.parts)
        return merged(rows, version.merge).drop(SEQUENCE, REPLACES) if version.merge else rows

    # --- writing

    def write(self, rows: DataFrame, key: list[str] | None = None, bytes_per_row: float | None = None, target: int = TARGET_BYTES) -> list[Part]:
        """Put rows under a folder of their own and describe its parts; nothing is published yet.

        With ``key`` a bit filter of the keys is stored beside each part."""
        batch = uuid.uuid4().hex
        folder = f"{self.path}/data/{BATCH}={batch}"
        held = rows.persist(StorageLevel.MEMORY_AND_DISK)  # counted, then written
        try:
            sized(held, self.partition, self._measured() if bytes_per_row is None else bytes_per_row, target, folder)
        finally:
            held.unpersist()
        parts = self._described(batch, rows.schema)
        if key and parts:
            written = self.of_parts(Version(0, rows.schema.json(), self.partition), parts)
            self._store_keys(batch, written, key, parts)
        return parts

    def _measured(self) -> float | None:
        version = self.current()
        rows = version.rows() if version else 0
        return sum(p.bytes for p in version.parts) / rows if rows else None

    def _described(self, batch: str, schema: T.StructType) -> list[Part]:
        """One row of figures per partition, never per file or row."""
        folder = f"{self.path}/data/{BATCH}={batch}"
        directories = [""] if not self.partition else [n for n in self.files.names(folder) if "=" in n]
        written = self.spark.read.schema(schema).parquet(folder)
        low, high = (F.min(self.clock), F.max(self.clock)) if self.clock else (F.lit(None), F.lit(None))
        by = [F.col(self.partition).cast("string").alias("value")] if self.partition else []
        figures = written.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), low.cast("string").alias("low"), high.cast("string").alias("high"))
        found = {r["value"] if self.partition else None: r for r in figures.collect()}
        parts = []
        for d in sorted(directories):
            r = found.get(value_of(d)) if self.partition else found.get(None)
            if r is not None and r["rows"]:
                parts.append(Part(batch, d, r["rows"], self.files.size(f"{folder}/{d}" if d else folder), r["low"], r["high"]))
        return parts

    def publish(self, based_on: Version | None, parts: list[Part], schema: T.StructType, merge: list[str] | None = None) -> Version:
        """Make the parts the next version. Fails, changing nothing, if another writer was faster."""
        number = based_on.number + 1 if based_on else 1
        version = Version(number, schema.json(), self.partition, parts, merge)
        self.files.create(f"{self.path}/versions/{number}.json", json.dumps(asdict(version)))
        return version

    def append(self, rows: DataFrame) -> Version:
        before = self.current()
        return self._compacted(self.publish(before, (before.parts if before else []) + self.write(rows), rows.schema))

    def put(self, rows: DataFrame, key: list[str], replace: bool) -> Version:
        """Append rows to a log; with ``replace`` they win over stored rows of their key, else those stay."""
        before = self.current()
        number = before.number + 1 if before else 1
        marked = rows.withColumns({SEQUENCE: F.lit(number).cast("long"), REPLACES: F.lit(replace)})
        return self._compacted(self.publish(before, (before.parts if before else []) + self.write(marked), marked.schema, key))

    def _compacted(self, version: Version, key: list[str] | None = None) -> Version:
        """Partitions of many small parts, as micro-batches leave them, become one part each; versions
        older than the last ten go with them."""
        sizes: dict[str, int] = {}
        for p in version.parts:
            sizes[p.directory] = sizes.get(p.directory, 0) + 1
        full = [d for d, n in sizes.items() if n > MOST_PARTS]
        if not full:
            return version
        version = self.compact(full, key)
        self.vacuum(keep=10)
        return version

    def compact(self, directories: list[str], key: list[str] | None = None) -> Version:
        """Merge the parts of some partitions into one each; what readers see stays the same. ``key`` stores
        bit filters of the merged parts' keys anew."""
        version = self.current()
        old = [p for p in version.parts if p.directory in directories]
        one = self.of_parts(version, old)
        new = self.write(merged(one, version.merge) if version.merge else one, key)
        return self.publish(version, [p for p in version.parts if p not in old] + new, T.StructType.fromJson(json.loads(version.schema)), version.merge)

    def replace_all(self, rows: DataFrame) -> Version:
        return self.publish(self.current(), self.write(rows), rows.schema)

    def upsert(self, rows: DataFrame, key: list[str]) -> DataFrame:
        """Insert rows, replacing stored rows of the same key in the same partition; returns the new rows.

        The rows are written once. Of the partitions they touch, only those that hold one of their
        keys are written again, without the replaced rows; all other files stay as they are."""
        before = self.current()
        new = self.write(rows)
        schema = rows.schema
        batch = self.of_parts(Version(0, schema.json(), self.partition), new)
        stay, kept = list(before.parts) if before else [], []
        touched = {p.directory for p in new}
        met = [p for p in stay if p.directory in touched]
        if met:
            stored = self.of_parts(before, met)
            keys = batch.select(*key)
            hit = {""} if not self.partition else self._directories(stored.join(keys, key, "left_semi"))
            old = [p for p in met if p.directory in hit]
            if old:
                rest = self.of_parts(before, old).join(keys, key, "left_anti").select(*schema.names)
                kept = self.write(rest)
            stay = [p for p in stay if p not in old]
        self.publish(before, stay + kept + new, schema)
        return batch

    def _directories(self, rows: DataFrame) -> set[str]:
        """The partition directories some rows lie in: one value per month or day."""
        values = {r[0] for r in rows.select(F.col(self.partition).cast("string")).distinct().collect()}
        return {p.directory for p in self.current().parts if value_of(p.directory) in values}

    def insert_absent(self, rows: DataFrame, key: list[str], anywhere: bool = False) -> int:
        """Append rows whose key is not stored yet, one row per key in ``rows``; returns how many.

        Looked for are stored keys in the touched partitions, or with ``anywhere`` in all partitions
        whose time range and bit filter do not rule them out. Rows are written once, and a second
        time only if some of them turn out to be stored already."""
        before = self.current()
        kept_key = key if anywhere else None
        new = self.write(rows, kept_key)
        schema = rows.schema
        if before is not None and new:
            batch = self.of_parts(Version(0, schema.json(), self.partition), new)
            seen = self._may_hold(before, new, batch, key, anywhere)
            stored = self.of_parts(before, seen).select(*key)
            if seen and not batch.select(*key).join(stored, key, "left_semi").isEmpty():
                fresh = batch.join(stored, key, "left_anti").select(*schema.names)
                new = self.write(fresh, kept_key)
        if new or before is None:
            self._compacted(self.publish(before, (before.parts if before else []) + new, schema), kept_key)
        return sum(p.rows for p in new)

    # --- keys in other partitions

    def _store_keys(self, batch: str, rows: DataFrame, key: list[str], parts: list[Part]) -> None:
        """Per part a bit filter of its keys: rows (directory, word, mask), some four bytes a key."""
        sizes = {value_of(p.directory): words_for(p.rows) for p in parts}
        named = {value_of(p.directory): p.directory for p in parts}
        value = F.col(self.partition).cast("string") if self.partition else F.lit(None).cast("string")
        facts = [(k, named[k], n) for k, n in sizes.items()]
        table = F.broadcast(self.spark.createDataFrame(facts, "_known string, directory string, _words long"))  # one row per part
        joined = rows.select(*key, value.alias("_value")).join(table, F.col("_value").eqNullSafe(F.col("_known")))
        bits = joined.select("directory", F.inline(key_bits(key, F.col("_words"))))
        masks = bits.groupBy("directory", "word").agg(F.bit_or("mask").alias("mask"))
        masks.write.parquet(f"{self.path}/keys/{BATCH}={batch}")

    def _may_hold(self, version: Version, new: list[Part], batch: DataFrame, key: list[str], anywhere: bool) -> list[Part]:
        touched = {p.directory for p in new}
        near = [p for p in version.parts if p.directory in touched]
        if not anywhere:
            return near
        far = [p for p in version.parts if p.directory not in touched and overlap(p, new)]
        if not far:
            return near
        facts = [(p.batch, p.directory, words_for(p.rows)) for p in far]
        table = F.broadcast(self.spark.createDataFrame(facts, "batch string, directory string, words long"))  # one row per part
        sizes = F.explode(F.array(*[F.lit(n).cast("long") for n in sorted({f[2] for f in facts})]))
        wanted = batch.select(*key).withColumn("_words", sizes)
        bits = F.inline(key_bits(key, F.col("_words")))
        wanted = wanted.select(F.xxhash64(*key).alias("k1"), F.xxhash64(F.lit(1), *key).alias("k2"), F.col("_words").alias("words"), bits)
        schema = "directory string, word long, mask long, batch string"
        stored = self.spark.read.schema(schema).option("basePath", f"{self.path}/keys")
        stored = stored.parquet(*sorted({f"{self.path}/keys/{BATCH}={p.batch}" for p in far})).join(table, ["batch", "directory"])
        met = wanted.join(stored.withColumnRenamed("mask", "has"), ["words", "word"])
        met = met.filter(F.col("has").bitwiseAND(F.col("mask")) == F.col("mask"))
        both = met.groupBy("k1", "k2", "batch", "directory").agg(F.count(F.lit(1)).alias("n")).filter("n = 2")
        hit = {(r[0], r[1]) for r in both.select("batch", "directory").distinct().collect()}
        return near + [p for p in far if (p.batch, p.directory) in hit]

    # --- cleaning

    def vacuum(self, keep: int = KEPT_VERSIONS) -> int:
        """Remove all but the newest versions and every folder they do not list; returns the folders removed."""
        numbers = self.numbers()
        listed = {p.batch for n in numbers[-keep:] for p in self.version(n).parts}
        for n in numbers[:-keep]:
            self.files.remove(f"{self.path}/versions/{n}.json")
        gone = 0
        for kind in ("data", "keys"):
            for name in self.files.names(f"{self.path}/{kind}"):
                if name.startswith(f"{BATCH}=") and name.split("=", 1)[1] not in listed:
                    self.files.remove(f"{self.path}/{kind}/{name}")
                    gone += 1
        return gone


def merged(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row per key: the newest that replaces, or else the first inserted."""
    others = [c for c in rows.columns if c not in key]
    turn = F.when(F.col(REPLACES), F.col(SEQUENCE)).otherwise(-F.col(SEQUENCE))
    rank = F.struct(F.col(REPLACES), turn, *[F.col(c) for c in others if c not in (SEQUENCE, REPLACES)])
    picked = rows.groupBy(*key).agg(F.max_by(F.struct(*others), rank).alias("_row"))
    return picked.select(*key, "_row.*").select(*rows.columns)


def value_of(directory: str) -> str | None:
    """The partition value a directory name stands for, as text."""
    value = unquote(directory.split("=", 1)[1]) if "=" in directory else ""
    return None if value in ("", "__HIVE_DEFAULT_PARTITION__") else value


def overlap(part: Part, new: list[Part]) -> bool:
    """Whether the part's time range meets that of some new part; without a clock it may."""
    times = [(datetime.fromisoformat(p.low), datetime.fromisoformat(p.high)) for p in [part, *new] if p.low and p.high]
    if len(times) < 1 + len(new):
        return True
    (low, high), *others = times
    return any(a <= high and low <= b for a, b in others)


def words_for(rows: int) -> int:
    """64-bit words of a filter for that many keys: a power of two, so that few sizes exist."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows * KEY_BITS / 64))))


def key_bits(key: list[str], words: Column) -> Column:
    """Two (word, mask) pairs of a key: in each of two words of the filter a few bits are set."""

    def one(seed: int) -> Column:
        h = F.xxhash64(F.lit(seed), *key)
        bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 34 + 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        mask = bit(0)
        for k in range(1, WORD_BITS):
            mask = mask.bitwiseOR(bit(k))
        return F.struct(F.pmod(h, words).alias("word"), mask.alias("mask"))

    return F.array(one(11), one(12))


def trial_bytes(rows: DataFrame, partition: str | None) -> float:
    """Bytes per row of a small Parquet file of these rows; the rows only serve to size files."""
    path = work_path(rows.sparkSession, "trial")
    few = rows.limit(TRIAL_ROWS)
    (few.drop(partition) if partition else few).coalesce(1).write.parquet(path)
    files = Files(rows.sparkSession, path)
    n = rows.sparkSession.read.parquet(path).count()
    size = files.size(path)
    files.remove(path)
    return max(1.0, size / n) if n else 1.0


def sized(rows: DataFrame, partition: str | None, bytes_per_row: float | None, target: int, folder: str) -> None:
    """Write rows in files of about ``target`` bytes and at most some ``MOST_ROWS`` rows, as many to a
    partition as its rows need.

    Rows are dealt to tasks by number, one file each: no two slices meet in a task by chance."""
    by = [F.col(partition)] if partition else []
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    total = sum(r["n"] for r in counts)
    if bytes_per_row is None:
        bytes_per_row = trial_bytes(rows, partition) if total > TRIAL_ROWS else 1.0
    first, slots = 0, []
    for r in counts:
        slices = max(1, round(r["n"] * bytes_per_row / target), -(-r["n"] // MOST_ROWS))
        slots.append((r[partition] if partition else None, first, slices))
        first += slices
    writer = lambda df: (df.write.partitionBy(partition) if partition else df.write).mode("append").parquet(folder)
    if not slots:
        writer(rows.limit(0))
        return
    kind = rows.schema[partition].dataType if partition else T.StringType()
    schema = T.StructType([T.StructField("_value", kind), T.StructField("_first", T.IntegerType()), T.StructField("_slices", T.IntegerType())])
    table = F.broadcast(rows.sparkSession.createDataFrame(slots, schema))  # one row per partition
    if partition:
        named = rows.join(table, F.col(partition).eqNullSafe(F.col("_value")))
    else:
        named = rows.withColumns({"_first": F.lit(0), "_slices": F.lit(slots[0][2])})
    spread = F.col("_first") + F.pmod(F.xxhash64(*[c for c in rows.columns if not isinstance(rows.schema[c].dataType, T.MapType)]), F.col("_slices")).cast("int")
    dealt = named.withColumn("_slot", spread).repartitionById(first, F.col("_slot"))
    writer(dealt.select(*rows.columns))
