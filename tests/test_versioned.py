"""Versioned tables: crashes between all steps, logs, keys across partitions, file sizes."""

import os

import pytest
from pyspark.sql import functions as F

from stopline.session import work_path
from stopline.sources import tables as tb
from stopline.sources import versioned
from stopline.sources.versioned import Table

FRAME = "day int, key string, v int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, FRAME)


def content(spark, path):
    found = tb.read(spark, path)
    return None if found is None else sorted(map(tuple, found.collect()))


class Broken(Exception):
    pass


class Crash:
    """Fails at the n-th step of a job; steps are folders written, keys stored and pointers moved."""

    def __init__(self, monkeypatch, after: int):
        self.left = after
        for owner, name in ((versioned, "sized"), (Table, "_store_keys"), (Table, "_described"), (versioned.Files, "create")):
            monkeypatch.setattr(owner, name, self.counted(getattr(owner, name)))

    def counted(self, step):
        def run(*args, **named):
            if self.left == 0:
                raise Broken
            self.left -= 1
            return step(*args, **named)

        return run


JOBS = {
    "upsert": lambda spark, path: tb.upsert(frame(spark, (1, "a", 9), (3, "c", 9)), path, ["day", "key"], "day"),
    "insert": lambda spark, path: tb.insert_absent(frame(spark, (1, "a", 9), (3, "c", 9)), path, ["day", "key"], "day"),
    "append": lambda spark, path: Table(spark, path, "day").append(frame(spark, (3, "c", 9))),
    "all": lambda spark, path: Table(spark, path, "day").replace_all(frame(spark, (3, "c", 9))),
}
OLD = [(1, "a", 1), (1, "b", 1), (2, "a", 1)]
NEW = {
    "upsert": [(1, "a", 9), (1, "b", 1), (2, "a", 1), (3, "c", 9)],
    "insert": [*OLD, (3, "c", 9)],
    "append": [*OLD, (3, "c", 9)],
    "all": [(3, "c", 9)],
}


@pytest.mark.parametrize("job", JOBS)
def test_a_crash_at_any_step_leaves_the_old_version_and_a_repeat_ends_right(spark, monkeypatch, job):
    path, steps = work_path(spark, "crash"), 0
    tb.upsert(frame(spark, *OLD), path, ["day", "key"], "day")
    while True:
        with monkeypatch.context() as patch:
            Crash(patch, steps)
            try:
                JOBS[job](spark, path)
                break
            except Broken:
                assert content(spark, path) == OLD
        steps += 1
    assert steps >= 3 and content(spark, path) == NEW[job]
    assert Table(spark, path).vacuum(keep=1) >= 1 and content(spark, path) == NEW[job]


def test_readers_keep_the_version_they_resolved(spark):
    path = work_path(spark, "versions")
    tb.upsert(frame(spark, *OLD), path, ["day", "key"], "day")
    before = tb.read(spark, path)
    tb.upsert(frame(spark, (1, "a", 9)), path, ["day", "key"], "day")
    assert sorted(map(tuple, before.collect())) == OLD and content(spark, path) != OLD
    assert sorted(map(tuple, Table(spark, path).read(1).collect())) == OLD


def test_an_upsert_leaves_partitions_without_its_keys_alone(spark):
    path = work_path(spark, "parts")
    tb.upsert(frame(spark, *OLD), path, ["day", "key"], "day")
    first = {p.directory: p.batch for p in Table(spark, path).current().parts}
    tb.upsert(frame(spark, (1, "a", 9), (2, "z", 9)), path, ["day", "key"], "day")
    parts = Table(spark, path).current().parts
    assert {p.batch for p in parts if p.directory == "day=2"} >= {first["day=2"]}  # no key of it was replaced
    assert first["day=1"] not in {p.batch for p in parts if p.directory == "day=1"}
    assert sum(p.rows for p in parts) == 4


def test_a_second_writer_is_refused(spark):
    path = work_path(spark, "two")
    table = Table(spark, path)
    table.append(frame(spark, (1, "a", 1)))
    stale, parts = table.current(), table.write(frame(spark, (1, "b", 1)))
    table.append(frame(spark, (1, "c", 1)))
    with pytest.raises(Exception, match="[Ee]xist"):
        table.publish(stale, stale.parts + parts, frame(spark).schema)
    assert content(spark, path) == [(1, "a", 1), (1, "c", 1)]


def test_empty_tables_null_and_odd_partitions(spark):
    path = work_path(spark, "odd")
    tb.insert_absent(frame(spark), path, ["key"])
    assert content(spark, path) == [] and tb.insert_absent(frame(spark, (1, "a", 1)), path, ["key"]) == 1
    rows = spark.createDataFrame([("a/b=c", 1), (None, 2), ("ä %", 3)], "part string, v int")
    named = work_path(spark, "named")
    tb.upsert(rows, named, ["v"], "part")
    tb.upsert(rows.withColumn("v", F.col("v") + 10), named, ["v"], "part")
    tb.upsert(rows, named, ["v"], "part")
    got = tb.read(spark, named).collect()
    assert sorted((r["v"], r["part"]) for r in got) == [(1, "a/b=c"), (2, None), (3, "ä %"), (11, "a/b=c"), (12, None), (13, "ä %")]


# --- logs


def test_a_log_merges_on_reading_and_when_compacted(spark):
    path = work_path(spark, "log")
    row = lambda at, v: spark.createDataFrame([(at, v)], "at string, v int").withColumn("at", F.col("at").cast("timestamp"))
    put = lambda at, v, replace: tb.log_rows(row(at, v), path, ["at"], "at", replace)
    a, b = "2026-01-31 10:00:00", "2026-02-01 10:00:00"
    put(a, 1, False)
    put(a, 2, False)
    put(b, 1, False)
    state = lambda: sorted(r["v"] for r in tb.read(spark, path).collect())
    assert state() == [1, 1] and tb.read(spark, path).columns[:2] == ["at", "v"]
    put(a, 3, True)
    put(b, 4, True)
    put(b, 5, False)
    assert state() == [3, 4]
    table = Table(spark, path, tb.MONTH)
    parts = len(table.current().parts)
    table.compact(["polled_month=2026-02-01"])
    assert parts == 6 and len(table.current().parts) == 4 and state() == [3, 4]
    put(b, 6, False)
    put(a, 7, True)
    assert state() == [4, 7]


def test_a_long_log_compacts_itself(spark, monkeypatch):
    monkeypatch.setattr(versioned, "MOST_PARTS", 3)
    path = work_path(spark, "log")
    for k in range(5):
        rows = spark.createDataFrame([(k, "2026-01-01 00:00:00")], "v int, at string").withColumn("at", F.col("at").cast("timestamp"))
        tb.log_rows(rows, path, ["at"], "at", replace=True)
    table = Table(spark, path, tb.MONTH)
    assert len(table.current().parts) <= 3 and [r["v"] for r in table.read().collect()] == [4]


# --- keys in other partitions


def sightings(spark, *rows):
    df = spark.createDataFrame(rows, "key string, at string, day int")
    return df.withColumn("at", F.col("at").cast("timestamp"))


def test_a_key_under_another_day_is_stored_once(spark):
    path, key = work_path(spark, "days"), ["key", "at"]
    put = lambda *rows: tb.insert_absent(sightings(spark, *rows), path, key, "day", clock="at")
    many = [(f"k{i}", f"2026-01-0{1 + i % 5} 00:00:00", i % 5) for i in range(200)]
    assert put(*many) == 200
    moved = [(k, at, day + 10) for k, at, day in many[::7]]
    assert put(*moved) == 0
    assert put(*moved, ("new", "2026-01-03 00:00:00", 12)) == 1
    assert tb.read(spark, path).count() == 201


def test_time_ranges_and_filters_spare_partitions(spark):
    path, key = work_path(spark, "spared"), ["key", "at"]
    table = Table(spark, path, "day", "at")
    table.insert_absent(sightings(spark, *[(f"k{i}", "2026-01-01 00:00:00", i % 4) for i in range(400)]), key, anywhere=True)
    version = table.current()

    def held(*rows):
        parts = table.write(sightings(spark, *rows), key)
        batch = table.of_parts(version, parts)
        return {p.directory for p in table._may_hold(version, parts, batch, key, True)}

    assert held(("k1", "2027-01-01 00:00:00", 9)) == set()  # outside all time ranges
    assert held(("k1", "2026-01-01 00:00:00", 9)) == {"day=1"}  # only the filter of day 1 has it
    assert held(*[(f"x{i}", "2026-01-01 00:00:00", 9) for i in range(50)]) == set()
    assert held(("x", "2027-01-01 00:00:00", 2)) == {"day=2"}  # its own day is always read


# --- layout


def test_files_come_near_their_target_on_a_skewed_month(spark):
    path = work_path(spark, "sized")
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 10 < 9, F.lit("2026-01-01")).otherwise(F.lit("2026-02-01")).cast("date").alias("month"), F.expr("uuid()").alias("text"), "id"
    )
    rows = tb.stage(rows, "sized-input")
    target = 1 << 20
    table = Table(spark, path, "month")
    parts = table.write(rows, target=target)
    table.publish(None, parts, rows.schema)
    for p in parts:
        folder = table._folder(p).removeprefix("file:")
        sizes = [os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet")]
        assert sum(sizes) == p.bytes and len(sizes) > 1 and all(target / 2 <= s <= 2 * target for s in sizes)
    assert table.read().count() == 400_000


def test_staged_tables_go_with_their_block(spark):
    with tb.scratch(spark):
        staged = tb.stage(spark.range(3), "gone")
        path = staged.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert staged.count() == 3 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_many_small_batches_become_one_part(spark, monkeypatch):
    monkeypatch.setattr(versioned, "MOST_PARTS", 2)
    path, key = work_path(spark, "small"), ["key", "at"]
    for k in range(6):
        rows = sightings(spark, (f"k{k}", f"2026-01-0{k + 1} 00:00:00", k % 2), ("again", "2026-01-01 00:00:00", 7))
        tb.insert_absent(rows, path, key, "day", clock="at")
    table = Table(spark, path, "day", "at")
    assert len(table.current().parts) <= 5 and table.read().count() == 7
    assert tb.insert_absent(sightings(spark, ("k0", "2026-01-01 00:00:00", 9)), path, key, "day", clock="at") == 0
    notes = work_path(spark, "notes")
    for k in range(9):
        tb.append(spark.range(k, k + 1), notes)
    assert len(Table(spark, notes).current().parts) <= 4 and sorted(r[0] for r in tb.read(spark, notes).collect()) == list(range(9))


def test_a_file_has_a_bounded_number_of_rows(spark, monkeypatch):
    """However small rows are written, the task that writes them holds them unpacked."""
    monkeypatch.setattr(versioned, "MOST_ROWS", 100)
    path = work_path(spark, "bounded")
    Table(spark, path, "day").append(spark.range(1000).selectExpr("1 AS day", "cast(id AS string) AS key", "0 AS v"))
    per_file = tb.read(spark, path).groupBy(F.input_file_name()).count().collect()
    assert len(per_file) == 10 and max(r["count"] for r in per_file) < 200
