import datetime as dt
import random

from pyspark.sql import functions as F

from stopline.sources import tables as tb
from stopline.config import LabelRules
from stopline.operators import gates
from stopline.operators import labels as lab
from stopline.plans import build_labels as bl
from stopline.session import work_path
from tests.conftest import at, plus

T = at("2026-08-12 16:00:00")
RULES = LabelRules()
MARGIN = 198


def steady(runs, end=3600):
    return runs([(plus(T, 66 * i), None) for i in range(end // 66 + 1)])


def seen(*offsets, scheduled=600, delay=60, **extra):
    return [
        dict(polled_at=plus(T, o), scheduled_arrival=plus(T, scheduled), predicted_arrival=plus(T, scheduled + delay)) | extra
        for o in offsets
    ]


def close(events_df, runs_df, **kw):
    return bl.closed_labels(events_df, runs_df, RULES, **kw).collect()


def test_settled_label(events, runs):
    rows = close(events(*seen(0, 66, 132, delay=240)), steady(runs))
    assert len(rows) == 1
    r = rows[0]
    assert (r["delay_seconds"], r["late"], r["closed_reason"], r["n_snapshots"]) == (240, True, None, 3)


def test_exactly_the_late_threshold_is_on_time(events, runs):
    assert close(events(*seen(0, delay=180)), steady(runs))[0]["late"] is False
    assert close(events(*seen(0, delay=181)), steady(runs))[0]["late"] is True


def test_not_settled_gives_no_row_and_the_margin_counts(events, runs):
    cycles = steady(runs)
    assert close(events(*seen(0)), cycles, as_of=F.lit(plus(T, MARGIN - 1))) == []
    assert len(close(events(*seen(0)), cycles, as_of=F.lit(plus(T, MARGIN)))) == 1


def test_missing_arrival_wins_over_a_gap(events, runs):
    cycles = runs([(T, None), (plus(T, 3600), None)])
    row = close(events(*seen(0, predicted_arrival=None)), cycles)[0]
    assert (row["closed_reason"], row["delay_seconds"], row["late"]) == ("no_arrival_signal", None, None)
    row = close(events(*seen(0, scheduled_arrival=None)), cycles)[0]
    assert row["closed_reason"] == "no_arrival_signal"


def test_gap_rows_keep_their_delay(events, runs):
    row = close(events(*seen(0)), runs([(T, None), (plus(T, 3600), None)]))[0]
    assert (row["closed_reason"], row["delay_seconds"]) == ("gap_abutted", 60)


def test_gap_before_inside_and_after_the_window(spark, events):
    times = events(dict(polled_at=T)).selectExpr("polled_at as observed_span_end")
    schema = "gap_start timestamp, gap_end timestamp"
    cases = [(-300, -1, False), (-300, 0, True), (50, 50, True), (MARGIN, MARGIN + 500, True), (MARGIN + 1, MARGIN + 500, False), (-99999, 99999, True)]
    for start, end, wanted in cases:
        gaps = spark.createDataFrame([(plus(T, start), plus(T, end))], schema)
        assert lab.mark_gap_abutted(times, gaps, RULES).first()["gap_abutted"] is wanted, (start, end)


def test_one_trip_id_on_two_service_days_gives_two_labels(events, runs):
    day = 86400
    rows = close(
        events(*seen(0, 66, 132, 198), *seen(day, day + 66, day + 132, day + 198, scheduled=600 + day, delay=300)),
        runs([(plus(T, 66 * i), None) for i in range(1400)]),
    )
    assert sorted((r["service_date_norm"], r["n_snapshots"], r["delay_seconds"]) for r in rows) == [
        (dt.date(2026, 8, 12), 4, 60),
        (dt.date(2026, 8, 13), 4, 300),
    ]


def test_latest_known_values_win(events, runs):
    rows = seen(0, delay=60) + seen(66, delay=90) + seen(132, predicted_arrival=None, route_id="2")
    r = close(events(*rows), steady(runs))[0]
    assert (r["route_id"], r["delay_seconds"], r["n_snapshots"]) == ("2", 90, 3)


def test_window_selects_groups_but_never_cuts_their_history(events, runs):
    df = events(*seen(0, 66, 132), *seen(0, trip_id="t2"))
    rows = close(df, steady(runs), since=F.lit(plus(T, 100)), until=F.lit(plus(T, 200)))
    assert [(r["trip_id"], r["n_snapshots"]) for r in rows] == [("t1", 3)]


def test_build_is_idempotent_over_overlapping_windows_and_records_each_run(spark, events, runs):
    df, cycles = events(*seen(0, 66, 132), *seen(300, 366, trip_id="t2", delay=400)), steady(runs)
    path, log = work_path(spark, "labels"), work_path(spark, "log")
    naive = lambda s: plus(T, s)
    bl.build_labels(df, cycles, path, log, until=naive(150))
    first = {r["trip_id"]: r.asDict() for r in tb.read(spark, path).collect()}
    record = bl.build_labels(df, cycles, path, log, since=naive(100), until=naive(4000), git_sha="abc").first()
    second = {r["trip_id"]: r.asDict() for r in tb.read(spark, path).collect()}
    assert set(first) == {"t1"} and set(second) == {"t1", "t2"}
    assert {k: v for k, v in first["t1"].items() if k != "built_at"} == {k: v for k, v in second["t1"].items() if k != "built_at"}
    assert second["t1"]["built_at"] > first["t1"]["built_at"]
    assert (record["groups_considered"], record["rows_written"], record["passed"], record["git_sha"]) == (2, 2, True, "abc")
    assert tb.read(spark, log).count() == 2


def test_failed_gates_are_recorded(spark, events, runs):
    cycles = runs([(T, None), (plus(T, 3600), None)])
    record = bl.build_labels(events(*seen(0)), cycles, work_path(spark, "l"), work_path(spark, "r")).first()
    assert record["passed"] is False
    assert record["gate_results"]["label_rate"]["passed"] is False and record["gate_results"]["volume"]["passed"] is True


def test_gates_on_no_rows(labels):
    row = gates.label_gates(labels(dict(scheduled_arrival=T)).filter("false")).select("gate_results").first()[0]
    assert [row[g]["passed"] for g in ("volume", "null_rate", "label_rate")] == [False, True, False]


def test_merged_reaches_equal_every_gap_on_its_own(spark):
    rng = random.Random(9)
    ends = spark.createDataFrame([(plus(T, rng.randrange(40_000) / 2),) for _ in range(300)], "observed_span_end timestamp")
    for _ in range(3):
        gaps = [(a, a + rng.choice([0, 0, 30, 500, 4000])) for a in (rng.randrange(20_000) for _ in range(25))]
        frame = spark.createDataFrame([(plus(T, a), plus(T, b)) for a, b in gaps], "gap_start timestamp, gap_end timestamp")
        got = lab.mark_gap_abutted(ends, frame, RULES).collect()
        assert len(got) == 300
        for r in got:
            at = (r["observed_span_end"].replace(tzinfo=T.tzinfo) - T).total_seconds()
            assert r["gap_abutted"] is any(a <= at + MARGIN and b >= at for a, b in gaps)


def test_labels_are_closed_in_one_pass_over_the_snapshots(spark, events, runs):
    path, cycles = work_path(spark, "one"), runs([(plus(T, 66 * i), None) for i in range(20)])
    events(*seen(0)).write.parquet(path)
    plan = bl.closed_labels(spark.read.parquet(path), cycles, RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Expand" not in plan
