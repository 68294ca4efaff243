import os

from pyspark.sql import functions as F

from stopline.config import STOP_EVENT_KEY, LabelRules
from stopline.session import work_path
from stopline.sources import pages as pg
from stopline.sources import tables as tb
from stopline.streaming import jobs
from tests import feed
from tests.conftest import at, plus

T = at("2026-08-12 16:00:00")


def test_a_cycle_in_two_pieces_ends_as_one_ledger_row(spark):
    landing, events, runs, check = (work_path(spark, n) for n in ("landing", "e", "r", "c"))
    job = jobs.IngestJob(landing, events, runs, 3)
    row = lambda batch, n, trip: (T, batch, 1, feed.text(feed.page([feed.prediction(n, trip)])))
    for rows in ([row(0, 1, "a")], [row(1, 2, "b"), row(1, 2, "b")][:1]):
        schema = jobs.land_pages(spark.createDataFrame(rows, pg.PAGE_SCHEMA), landing)
        jobs.run_available(jobs.file_stream(spark, landing, schema, 10), job.handle, check)
    ledger = tb.read(spark, runs).collect()
    assert [(r["batches_ok"], r["rows"], r["inserted"]) for r in ledger] == [(2, 2, 2)]
    assert tb.read(spark, events).count() == 2


def test_a_replayed_batch_changes_nothing(spark, events):
    path = work_path(spark, "d")
    job, batch = jobs.DedupJob(path), events(dict(polled_at=T), dict(polled_at=T), dict(trip_id="t2", polled_at=T))
    job.handle(batch, 0)
    job.handle(batch, 0)
    assert tb.read(spark, path).count() == 2


def test_drop_repeats_within_the_watermark(spark, events):
    landing, out = work_path(spark, "l"), work_path(spark, "o")
    for offset in (0, 60):
        events(dict(polled_at=T), dict(polled_at=plus(T, offset))).coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    stream = jobs.drop_repeats(jobs.file_stream(spark, landing, schema, 1), "1 hour")
    query = stream.writeStream.format("parquet").option("checkpointLocation", work_path(spark, "c"))
    query.trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.parquet(out).select(*STOP_EVENT_KEY).count() == 2


def settle(spark):
    paths = [work_path(spark, n) for n in ("r", "e", "l", "s")]
    return jobs.SettleJob(*paths, LabelRules()), paths[2]


def sighting(offset, trip="t1", delay=60, scheduled=600):
    return dict(trip_id=trip, polled_at=plus(T, offset), scheduled_arrival=plus(T, scheduled), predicted_arrival=plus(T, scheduled + delay))


def stored(spark, path):
    table = tb.read(spark, path)  # nothing is stored before the first group closes
    return {} if table is None else {r["trip_id"]: r for r in table.collect()}


def test_open_groups_are_carried_until_they_settle_and_reopened_later(spark, runs, events):
    job, path = settle(spark)
    cycles = lambda *n: runs([(plus(T, 66 * i), None) for i in n])
    job.settle(events(sighting(0), sighting(66)), cycles(0, 1), 0)
    assert stored(spark, path) == {}
    # Another trip is seen; the first trip was not seen again and settles.
    job.settle(events(sighting(66 * 5, "t2")), cycles(2, 3, 4, 5), 1)
    rows = stored(spark, path)
    assert set(rows) == {"t1"} and rows["t1"]["n_snapshots"] == 2
    # The first trip reappears, and a late snapshot of it arrives out of order.
    job.settle(events(sighting(66 * 8, delay=400), sighting(33, delay=5)), cycles(6, 7, 8), 2)
    # It is open again, so its stored label waits; the other trip has been quiet for the margin.
    assert {k: r["n_snapshots"] for k, r in stored(spark, path).items()} == {"t1": 2, "t2": 1}
    job.settle(events(sighting(66 * 20, "t3")), cycles(*range(9, 21)), 3)
    got = stored(spark, path)
    assert got["t1"]["n_snapshots"] == 4 and got["t1"]["delay_seconds"] == 400 and set(got) == {"t1", "t2"}


def test_replaying_a_settle_batch_gives_the_same_labels(spark, runs, events):
    job, path = settle(spark)
    job.settle(events(sighting(0)), runs([(T, None)]), 0)
    for _ in range(2):
        job.settle(events(sighting(66 * 9, "t2")), runs([(plus(T, 66 * i), None) for i in range(1, 10)]), 1)
    assert set(stored(spark, path)) == {"t1"}


def test_cycles_that_store_nothing_move_the_clock(spark, runs, events):
    job, path = settle(spark)
    job.settle(events(sighting(0)), runs([(T, None)]), 0)
    nothing = events(sighting(0)).filter("false")
    job.settle(nothing, runs([(plus(T, 66), None), (plus(T, 132), None)]), 1)
    assert stored(spark, path) == {}
    job.settle(nothing, runs([(plus(T, 198), None)]), 2)
    assert stored(spark, path)["t1"]["closed_reason"] is None


def test_snapshots_alone_do_not_move_the_clock(spark, runs, events):
    job, path = settle(spark)
    job.settle(events(sighting(0)), runs([]), 0)
    job.settle(events(sighting(66 * 50, "t2")), runs([(T, None)]), 1)
    assert stored(spark, path) == {}
    job.settle(events(sighting(0)).filter("false"), runs([(plus(T, 66 * i), None) for i in range(1, 4)]), 2)
    assert set(stored(spark, path)) == {"t1"}


def test_late_ledger_rows_change_labels_that_are_stored(spark, runs, events):
    job, path = settle(spark)
    job.settle(events(sighting(0), sighting(3000, "t2")), runs([(T, None), (plus(T, 3300), None)]), 0)
    assert stored(spark, path)["t1"]["closed_reason"] == "gap_abutted"
    nothing = events(sighting(0)).filter("false")
    job.settle(nothing, runs([(plus(T, 66 * i), None) for i in range(1, 50)]), 1)
    assert stored(spark, path)["t1"]["closed_reason"] is None
    job.settle(nothing, runs([(plus(T, 30), "HTTP 503 status")]), 2)
    assert stored(spark, path)["t1"]["closed_reason"] == "gap_abutted"


def test_one_key_with_two_service_days_is_stored_once(spark, runs, events):
    job, path = settle(spark)
    cycles = runs([(plus(T, 66 * i), None) for i in range(10)])
    job.settle(events(sighting(0)), cycles, 0)
    job.settle(events(sighting(0, scheduled=600 + 86400), sighting(66)), cycles, 1)
    table = tb.read(spark, job.events_path)
    assert table.count() == table.select(*STOP_EVENT_KEY).distinct().count() == 2
    assert stored(spark, path)["t1"]["n_snapshots"] == 2


def test_two_sources_in_one_stream(spark, runs, events):
    job, path = settle(spark)
    cycles = runs([(plus(T, 66 * i), None) for i in range(12)])
    at = F.col("polled_at")
    parts = [at < F.lit(plus(T, 200)), at >= F.lit(plus(T, 200))]
    jobs.work_off_settling(events(sighting(0), sighting(66), sighting(400, "t2")), cycles, parts, job)
    assert {k: r["n_snapshots"] for k, r in stored(spark, path).items()} == {"t1": 2, "t2": 1}


def test_landed_days_hold_files_of_the_target_size(spark):
    landing = work_path(spark, "landing")
    rows = spark.range(60_000).select(
        F.expr("timestamp'2026-01-01' + make_interval(0,0,0,cast(id % 10 = 0 as int),0,0,id % 1000)").alias("polled_at"),
        F.lit(0).alias("batch"), F.lit(1).alias("page_no"), F.expr("uuid()").alias("text"),
    )
    target = 300_000
    jobs.land_pages(tb.stage(rows, "pages"), landing, target)
    files = [f.removeprefix("file://") for f in spark.read.parquet(landing).inputFiles()]
    assert len({os.path.dirname(f) for f in files}) == 2
    assert all(target / 2 <= os.path.getsize(f) <= 2 * target for f in files)
