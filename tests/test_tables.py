from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stopline.config import STOP_EVENT_KEY
from stopline.plans import publish
from stopline.session import shared_folder, work_path
from stopline.sources import tables as tb
from tests.conftest import at, plus

T = at("2026-08-31 23:59:00")


def snap(events, *pairs, **extra):
    return tb.with_month(events(*[dict(trip_id=t, polled_at=plus(T, s)) | extra for t, s in pairs]))


def test_insert_absent_keeps_the_stored_row_and_counts_new_ones(spark, events):
    path = work_path(spark, "t")
    put = lambda df: tb.insert_absent(df, path, STOP_EVENT_KEY, tb.MONTH)
    assert put(snap(events, ("a", 0), ("b", 0), ("a", 0))) == 2
    assert put(snap(events, ("a", 0), ("a", 120), status="new")) == 1
    assert put(snap(events, ("a", 0), status="new")) == 0
    rows = {(r["trip_id"], r["status"]) for r in tb.read(spark, path).collect()}
    assert rows == {("a", None), ("b", None), ("a", "new")}
    assert tb.read(spark, path).select(tb.MONTH).distinct().count() == 2


def test_first_row_of_a_batch_wins(spark):
    df = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early")], "key string, rank int, v string")
    assert tb.first_per_key(df, ["key"], [F.col("rank")]).first()["v"] == "early"


def test_upsert_replaces_touched_keys_and_leaves_other_partitions(spark):
    path = work_path(spark, "u")
    frame = lambda *rows: spark.createDataFrame(rows, "day int, key string, v int")
    tb.upsert(frame((1, "a", 1), (1, "b", 1), (2, "a", 1)), path, ["day", "key"], "day")
    tb.upsert(frame((1, "a", 2), (3, "c", 2)), path, ["day", "key"], "day")
    got = {(r["day"], r["key"]): r["v"] for r in tb.read(spark, path).collect()}
    assert got == {(1, "a"): 2, (1, "b"): 1, (2, "a"): 1, (3, "c"): 2}


def test_upsert_of_nothing_changes_nothing(spark):
    path = work_path(spark, "u")
    frame = lambda *rows: spark.createDataFrame(rows, "day int, key string, v int")
    tb.upsert(frame((1, "a", 1)), path, ["day", "key"], "day")
    tb.upsert(frame(), path, ["day", "key"], "day")
    assert tb.read(spark, path).count() == 1


def test_verified_rewrite_publishes_the_monthly_layout(spark, events):
    path = work_path(spark, "v")
    snap(events, ("a", 0), ("b", 30), ("a", 120)).drop(tb.MONTH).write.parquet(path)
    row = tb.verified_rewrite(spark, path, F.lit(plus(T, 10)).cast("timestamp")).first()
    assert row["rows"] == 3
    assert tb.read(spark, path).groupBy(tb.MONTH).count().count() == 2
    assert spark.read.parquet(path).count() == 3 and tb.MONTH not in spark.read.parquet(path).columns  # the old files stay


def test_verified_rewrite_publishes_nothing_on_a_mismatch(spark, events, monkeypatch):
    path = work_path(spark, "v")
    snap(events, ("a", 0), ("b", 30)).drop(tb.MONTH).write.parquet(path)
    true = tb.fingerprint
    monkeypatch.setattr(tb, "fingerprint", lambda df, c: true(df.limit(1) if tb.MONTH in df.columns else df, c))
    with pytest.raises(RuntimeError, match="not published"):
        tb.verified_rewrite(spark, path, F.lit(plus(T, 10)).cast("timestamp"))
    assert tb.MONTH not in tb.read(spark, path).columns and tb.Table(spark, path).current() is None


def test_fingerprint_notices_repeated_rows(spark):
    df = spark.range(3)
    assert tb.fingerprint(df, ["id"]).first() != tb.fingerprint(df.unionByName(df), ["id"]).first()
    assert tb.fingerprint(df, ["id"]).first() == tb.fingerprint(df.orderBy(F.desc("id")), ["id"]).first()


def test_publish_replaces_its_minute_and_keeps_the_newest(spark, runs, events, labels):
    cycles = runs([(T, None), (plus(T, 66), "timed out"), (plus(T, 132), None), (plus(T, 900), None)]).withColumn("inserted", F.lit(5))
    seen, closed = events(dict(polled_at=T, scheduled_arrival=T)), labels(dict(scheduled_arrival=T))
    snapshots, gaps = work_path(spark, "s"), work_path(spark, "g")
    for seconds in (1000, 1010, 1100, 1200):
        publish.publish(seen, cycles, closed, F.lit(plus(T, seconds)), snapshots, gaps, keep=2)
    rows = sorted(r["published_at"] for r in tb.read(spark, snapshots).collect())
    assert rows == ["2026-09-01T00:17:00.000000Z", "2026-09-01T00:19:00.000000Z"]
    row = tb.read(spark, snapshots).orderBy("published_at").collect()[-1]
    assert (row["cycles"], row["rows_last_hour"], row["gates_total"], row["disk_free_gib"]) == (4, 20, 3, None)
    assert tb.read(spark, gaps).count() == 2


def test_a_failed_publish_leaves_the_old_state(spark, runs, events, labels, monkeypatch):
    cycles = runs([(T, None), (plus(T, 66), None), (plus(T, 900), None)]).withColumn("inserted", F.lit(5))
    seen, closed = events(dict(polled_at=T)), labels(dict(scheduled_arrival=T))
    snapshots, gaps = work_path(spark, "s"), work_path(spark, "g")
    publish.publish(seen, cycles, closed, F.lit(plus(T, 1000)), snapshots, gaps)
    before = tb.read(spark, snapshots).collect()
    bad = cycles.withColumn("started_at", F.raise_error(F.lit("ledger unreadable")).cast("timestamp"))
    with pytest.raises(Exception, match="ledger unreadable"):
        publish.publish(seen, bad.withColumn("error", F.lit("HTTP 503 status")), closed, F.lit(plus(T, 5000)), snapshots, gaps)
    assert tb.read(spark, snapshots).collect() == before


def test_shared_folder_comes_from_the_session(spark):
    own = shared_folder(spark)
    assert shared_folder(spark) == own
    # spark.checkpoint.dir is fixed when a session starts, so a stand-in session names it here.
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other: {"spark.checkpoint.dir": "hdfs://named/"}.get(key, other)))
    assert shared_folder(named) == "hdfs://named"
