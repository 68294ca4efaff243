import random
from pyspark.sql import functions as F

from stopline.sources import tables as tb
from stopline.operators import features as feat
from stopline.operators import labels as lab
from stopline.operators import verify
from stopline.plans import build_features as bf
from stopline.session import work_path
from tests.conftest import at, plus

T = at("2026-08-12 16:05:00")  # 12:05 in New York
RATE = "route_hour_historical_late_rate"
DELAY = "current_delay_persistence_seconds"


def by_trip(df):
    return {r["trip_id"]: r for r in df.collect()}


def row(trip, seconds, delay=0, **extra):
    return dict(trip_id=trip, scheduled_arrival=plus(T, seconds), delay_seconds=delay) | extra


def test_rate_sees_only_strictly_earlier_rows_of_the_same_hour(labels):
    rows = by_trip(feat.build(labels(row("a", 0, 300), row("b", 60), row("c", 120, 300), row("d", 3600, 300))))
    assert rows["a"][RATE] is None and rows["b"][RATE] == 1.0 and rows["c"][RATE] == 0.5
    assert rows["d"][RATE] is None  # 13:05 local, another bucket


def test_yesterdays_same_hour_is_history(labels):
    rows = by_trip(feat.build(labels(row("a", -86400, 300), row("b", 0))))
    assert rows["b"][RATE] == 1.0


def test_tied_earliest_rows_all_have_no_history(labels):
    rows = by_trip(feat.build(labels(*[row(f"x{i}", 0, 300) for i in range(4)], row("z", 60))))
    assert all(rows[f"x{i}"][RATE] is None for i in range(4)) and rows["z"][RATE] == 1.0


def test_future_labels_never_move_an_earlier_row(labels):
    past = [row("a", 0, 300), row("b", 60), row("c", 120)]
    future = [row(f"f{i}", 180 + i, 900, stop_id="s1") for i in range(20)]
    keep = lambda df: {k: v for k, v in by_trip(df).items() if k in "abc"}
    assert keep(feat.build(labels(*past))) == keep(feat.build(labels(*past, *future)))


def test_headway_is_per_route_direction_and_stop(labels):
    rows = by_trip(
        feat.build(labels(row("a", 0), row("b", 600), row("c", 900, direction_id=1), row("d", 1200, stop_id="s2"), row("e", 90000)))
    )
    assert [rows[k]["headway_seconds"] for k in "abcde"] == [None, 600, None, None, 89400]


def test_persistence_is_the_previous_stop_of_the_same_trip_and_day(labels):
    df = labels(
        row("t", 0, 10, stop_id="s1"), row("t", 60, 20, stop_id="s2"), row("t", 120, 30, stop_id="s3"), row("t", 86400, 40, stop_id="s1")
    )
    rows = {(r["stop_id"], r["service_date_norm"].day): r[DELAY] for r in feat.build(df).collect()}
    assert rows == {("s1", 12): None, ("s2", 12): 10, ("s3", 12): 20, ("s1", 13): None}


def test_persistence_ties_go_to_the_highest_stop_id(labels):
    df = labels(row("t", 0, 10, stop_id="s1"), row("t", 0, 99, stop_id="s2"), row("t", 60, 0, stop_id="s3"))
    rows = {r["stop_id"]: r[DELAY] for r in feat.build(df).collect()}
    assert rows == {"s1": None, "s2": None, "s3": 99}


def test_excluded_labels_are_no_history(labels):
    df = lab.training_labels(labels(row("a", 0, 300, closed_reason="gap_abutted"), row("b", 60)))
    assert by_trip(feat.build(df))["b"][RATE] is None


def test_window_limits_rows_not_history(labels):
    df = labels(row("a", 0, 300), row("b", 60), row("c", 120))
    rows = by_trip(feat.build(df, F.lit(plus(T, 60)), F.lit(plus(T, 120))))
    assert set(rows) == {"b"} and rows["b"][RATE] == 1.0


def test_rebuild_over_an_overlapping_window_and_stale_rows(spark, labels):
    path, log = work_path(spark, "features"), work_path(spark, "log")
    every = [row("a", 0, 300), row("b", 60), row("c", 120)]
    bf.build_features(labels(*every), path, log, until=plus(T, 100))
    before = by_trip(tb.read(spark, path).drop("built_at"))
    record = bf.build_features(labels(*every), path, log, since=plus(T, 30), until=plus(T, 300)).first()
    after = by_trip(tb.read(spark, path).drop("built_at"))
    assert set(before) == {"a", "b"} and set(after) == {"a", "b", "c"}
    assert before["b"] == after["b"] and record["rows_written"] == 2 and record["groups_considered"] == 2
    # A label excluded later keeps its stored features and leaves only through the join.
    changed = labels(row("a", 0, 300, closed_reason="gap_abutted"), *every[1:])
    stored = tb.read(spark, path)
    assert stored.count() == 3 and {r["trip_id"] for r in feat.training_set(stored, changed).collect()} == {"b", "c"}


def test_checks_pass_on_a_true_build_and_notice_a_wrong_rate(labels):
    df = labels(*[row(f"t{i}", 60 * (i // 2), 300 if i % 3 else 0) for i in range(30)])
    good = feat.build(df)
    assert all(r["passed"] for r in verify.point_in_time_checks(good, df, df).collect())
    leaked = good.withColumn(RATE, F.coalesce(F.col(RATE) + 0.01, F.lit(0.5)))
    got = {r["check_name"]: r for r in verify.point_in_time_checks(leaked, df, df).collect()}
    assert got["independent_recomputation"]["violations"] == 30 and not got["null_arithmetic"]["passed"]


def test_horizon_delay_uses_the_last_snapshot_ten_minutes_ahead(events):
    at_ = lambda o, p: dict(polled_at=plus(T, o), scheduled_arrival=plus(T, 1200), predicted_arrival=plus(T, 1200 + p))
    got = feat.horizon_delay(events(at_(0, 10), at_(600, 20), at_(601, 30))).first()
    assert got["horizon_delay_seconds"] == 20


def test_recomputation_in_ranges_equals_a_plain_window(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.8 else f"r{rng.randrange(3)}", 8, plus(T, 60 * k), rng.randrange(1, 4), rng.randrange(2)) for k in rng.sample(range(2000), 500)]
    points = spark.createDataFrame(rows, f"route_id string, hour_of_day int, {feat.AT} timestamp, n int, k int")
    want = {}
    for route, _, at_, n, k in sorted(rows, key=lambda r: r[2]):
        want[route, at_] = want.get(route, (0, 0))
        want[route] = (want.get(route, (0, 0))[0] + n, want.get(route, (0, 0))[1] + k)
        want[route, at_] = (want[route][0] - n, want[route][1] - k)
    got = verify.running_before(points, 16).collect()
    assert len(got) == 500
    assert all((r["n_before"], r["k_before"]) == want[r["route_id"], r[feat.AT].replace(tzinfo=T.tzinfo)] for r in got)


def test_one_corrupted_rate_is_found(labels):
    df = labels(*[row(f"t{i}", 60 * (i // 2), 300 if i % 3 else 0) for i in range(30)])
    good = feat.build(df)
    bad = good.withColumn(RATE, F.when(F.col("trip_id") == "t17", F.col(RATE) / 2).otherwise(F.col(RATE)))
    assert verify.recompute_check(bad, df).first()["mismatches"] == 1
    lost = good.withColumn(RATE, F.when(F.col("trip_id") != "t17", F.col(RATE)))
    assert verify.recompute_check(lost, df).first()["mismatches"] == 1
    made = good.withColumn(RATE, F.coalesce(RATE, F.lit(0.0)))
    assert verify.recompute_check(made, df).first()["mismatches"] == 2  # the two rows without history


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rows_are_exchanged_once_for_all_features(labels):
    """Rows go to their trip; the histories per time are stored first and small ones are broadcast."""
    df = labels(*[row(f"t{i}", 60 * i, i) for i in range(20)])
    assert exchanges(feat.build(df)) == 1


def test_persistence_equals_a_plain_search(labels):
    rng = random.Random(5)
    rows = [
        row(rng.choice(["a", "b", None]), 60 * rng.randrange(8), rng.choice([None, 0, 200]), stop_id=f"s{rng.randrange(4)}")
        for _ in range(80)
    ]
    df = labels(*rows)
    every = lab.training_labels(df).select("trip_id", "scheduled_arrival", "stop_id", "delay_seconds").collect()

    def wanted(trip, time):
        earlier = [r for r in every if r["trip_id"] == trip and r["scheduled_arrival"] < time]
        low = lambda d: (d is not None, d or 0)
        last = max(earlier, key=lambda r: (r["scheduled_arrival"], r["stop_id"], low(r["delay_seconds"])), default=None)
        return last and last["delay_seconds"]

    found = feat.previous_delays(lab.training_labels(df)).collect()
    assert len(found) == len({(r["trip_id"], r["scheduled_arrival"]) for r in every})
    assert all(r[DELAY] == wanted(r["trip_id"], r["scheduled_arrival"]) for r in found)
    built = feat.build(lab.training_labels(df)).collect()
    assert len(built) == len(every)
    assert all(r[DELAY] is None for r in built if r["trip_id"] is None)
