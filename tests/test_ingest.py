import datetime as dt

from pyspark.sql import functions as F

from stopline.sources import tables as tb
from stopline.functions import timecols as tc
from stopline.operators import predictions as pr
from stopline.plans import ingest
from stopline.session import work_path
from stopline.sources import pages as pg
from tests import feed
from tests.conftest import at

POLLED = at("2026-08-13 02:30:00")
LATER = at("2026-08-13 02:31:06")


def pages_of(spark, *rows):
    """Pages from (batch, page_no, body) or (batch, page_no, body, polled_at)."""
    return spark.createDataFrame(
        [(r[3] if len(r) > 3 else POLLED, r[0], r[1], feed.text(r[2])) for r in rows], pg.PAGE_SCHEMA
    )


def reading(spark, *rows):
    return ingest.read(pr.read_resources(pages_of(spark, *rows)))


def by_trip(df):
    return {r["trip_id"]: r for r in df.collect()}



def test_eight_predictions_give_six_rows(spark):
    data, included = feed.eight()
    r = reading(spark, (0, 1, feed.page(data, included)))
    df = r.mapped.withColumns({"s": F.unix_seconds("scheduled_arrival"), "p": F.unix_seconds("predicted_arrival")})
    rows = by_trip(df)
    assert r.mapped.count() == 6 and "gone" not in rows
    a = rows["a"]
    assert (a["route_id"], a["stop_id"], a["direction_id"], a["vehicle_id"]) == ("23", "s1", 0, "v1")
    assert a["s"] == at("2026-08-13 01:19:30").timestamp() and a["p"] == at("2026-08-13 01:17:46").timestamp()
    assert rows["added"]["s"] is None and rows["added"]["p"] is not None and rows["added"]["direction_id"] == 1
    origin = rows["origin"]
    assert origin["s"] is None and origin["p"] is None and origin["vehicle_id"] is None
    assert {x["service_date"] for x in rows.values()} == {dt.date(2026, 8, 12)}


def test_a_schedules_own_date_wins(spark):
    body = feed.page(
        [feed.prediction(1, "a", schedule="x"), feed.prediction(2, "b", schedule="y")],
        [feed.schedule("x", service_date="2026-08-01"), feed.schedule("y", service_date=None)],
    )
    rows = by_trip(reading(spark, (0, 1, body)).mapped)
    assert rows["a"]["service_date"] == dt.date(2026, 8, 1) and rows["b"]["service_date"] == dt.date(2026, 8, 12)


def test_an_empty_time_breaks_the_contract_and_is_no_time_below_it(spark):
    body = feed.page([feed.prediction(1, "a", schedule="x")], [feed.schedule("x", arrival="")])
    r = reading(spark, (0, 1, body))
    assert r.mapped.count() == 0 and r.found.count() == 1
    assert spark.range(1).select(tc.parse_iso(F.lit("")).alias("t")).first()["t"] is None


def test_split_pages_equal_one_page(spark):
    data, included = feed.eight()
    cut = reading(
        spark, (0, 1, feed.page(data[:5], included[:5], more="x")), (0, 2, feed.page(data[5:], included[5:]))
    )
    whole = reading(spark, (0, 1, feed.page(data, included)))
    columns = pr.SNAPSHOT_COLUMNS
    assert sorted(map(str, cut.mapped.select(columns).collect())) == sorted(map(str, whole.mapped.select(columns).collect()))


def test_the_last_duplicate_schedule_wins_within_its_batch_only(spark):
    one = feed.page([feed.prediction(1, "a", schedule="x")], [feed.schedule("x", arrival="2026-08-12T21:00:00-04:00")])
    two = feed.page([], [feed.schedule("x", arrival="2026-08-12T22:00:00-04:00")])
    other = feed.page([feed.prediction(2, "b", schedule="x")], [])
    rows = by_trip(reading(spark, (0, 1, one), (0, 2, two), (1, 1, other)).mapped.withColumn("s", F.unix_seconds("scheduled_arrival")))
    assert rows["a"]["s"] == at("2026-08-13 02:00:00").timestamp() and rows["b"]["s"] is None


def test_quarantine_drops_the_page_and_keeps_the_others(spark):
    bad = feed.prediction(9, "bad", direction=7)
    r = reading(
        spark,
        (0, 1, feed.page([feed.prediction(1, "a")], more="x")),
        (0, 2, feed.page([bad, feed.prediction(2, "b")], more="x")),
        (0, 3, feed.page([feed.prediction(3, "c")])),
    )
    assert set(by_trip(r.mapped)) == {"a", "c"} and r.found.count() == 1


def test_rows_without_a_required_field_are_counted_not_stored(spark):
    r = reading(spark, (0, 1, feed.page([feed.prediction(1, "a"), feed.prediction(2, "b", route=None)])))
    assert r.mapped.count() == 2 and set(by_trip(r.snapshots)) == {"a"}


def summary(spark, *rows):
    events, runs = work_path(spark, "e"), work_path(spark, "r")
    ingest.ingest(pages_of(spark, *rows), events, runs, 3)
    return tb.read(spark, events), tb.read(spark, runs).collect()


def test_ledger_row_of_a_mixed_cycle(spark):
    ok = feed.page([feed.prediction(1, "a"), feed.prediction(2, "a"), feed.prediction(3, "n", route=None)])
    bad = feed.page([feed.prediction(4, "b", direction=7)])
    events, runs = summary(spark, (0, 1, ok), (1, 1, bad), (2, 1, '{"data": ['))
    row = runs[0]
    assert len(runs) == 1 and events.count() == 1
    assert [row[c] for c in ("batches_ok", "batches_total", "pages_fetched", "rows", "inserted", "skipped")] == [2, 3, 2, 2, 1, 1]
    assert row["error"] == (
        "batch 1 contract violation: page 1: data[0].attributes.direction_id: value 7 not in allowed values [0, 1]; "
        "batch 2 failed: page 1 is not JSON"
    )


def test_clean_cycle_has_no_error_and_an_empty_page_counts(spark):
    _, runs = summary(spark, (0, 1, feed.page([feed.prediction(1, "a")])), (1, 1, feed.page()))
    assert runs[0]["error"] is None and runs[0]["batches_ok"] == 2 and runs[0]["pages_fetched"] == 2


def test_an_unreadable_time_fails_its_batch_only(spark):
    odd = feed.page([feed.prediction(1, "a", arrival="2026-08-12T21:17:46 or so"), feed.prediction(2, "b")])
    events, runs = summary(spark, (0, 1, odd), (1, 1, feed.page([feed.prediction(3, "c")])))
    assert set(by_trip(events)) == {"c"}
    assert runs[0]["batches_ok"] == 1 and runs[0]["error"] == "batch 0 failed: page 1 holds an unreadable time"


def test_page_cap(spark):
    body = lambda n, more: feed.page([feed.prediction(n, f"t{n}")], more="x" if more else None)
    five = [(0, n, body(n, True)) for n in range(1, 6)]
    _, runs = summary(spark, *five)
    assert runs[0]["batches_ok"] == 1 and runs[0]["error"] == "batch 0 hit 5-page cap; data truncated"
    _, runs = summary(spark, *five[:4], (0, 5, body(5, False)))
    assert runs[0]["error"] is None and runs[0]["pages_fetched"] == 5


def test_ingest_twice_stores_nothing_twice(spark):
    data, included = feed.eight()
    events, runs = work_path(spark, "e"), work_path(spark, "r")
    body = feed.page(data, included)
    assert ingest.ingest(pages_of(spark, (0, 1, body)), events, runs, 3) == 6
    # The same cycle again, and a later one that repeats its trips.
    assert ingest.ingest(pages_of(spark, (0, 1, body), (0, 1, body, LATER)), events, runs, 3) == 6
    assert tb.read(spark, events).count() == 12
    assert sorted(r["inserted"] for r in tb.read(spark, runs).collect()) == [6, 6]


def test_page_files_and_lines(spark, tmp_path):
    body = feed.text(feed.page([feed.prediction(1, "a")]))
    folder = tmp_path / "landed" / f"polled={int(POLLED.timestamp())}" / "batch=2" / "page_no=3"
    folder.mkdir(parents=True)
    (folder / "page.json").write_text(body.replace(",", ",\n"))
    got = pg.read_page_files(spark, str(tmp_path / "landed")).withColumn("s", F.unix_seconds("polled_at")).collect()
    assert [(r["s"], r["batch"], r["page_no"]) for r in got] == [(POLLED.timestamp(), 2, 3)]
    assert pr.read_resources(pg.read_page_files(spark, str(tmp_path / "landed"))).first()["trip_id"] == "a"
    lines = work_path(spark, "lines")
    pg.land_page_lines(pages_of(spark, (2, 3, body)), lines)
    assert pg.read_page_lines(spark, lines).first()["body"] == body
