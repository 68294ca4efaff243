from pyspark.sql import functions as F

from stopline.operators import gates, ledger
from tests.conftest import at, plus

T = at("2026-08-12 12:00:00")


def spans(df):
    return sorted((r[0], r[1]) for r in df.select(F.unix_seconds("gap_start"), F.unix_seconds("gap_end")).collect())


def sec(t):
    return int(t.timestamp())


def test_gap_intervals(runs):
    # One missing stretch of 200 s, one errored cycle, one cycle with an empty error text.
    cycles = runs([(T, None), (plus(T, 66), "boom"), (plus(T, 132), ""), (plus(T, 332), None), (plus(T, 432), None)])
    assert spans(ledger.gap_intervals(cycles, 100)) == sorted(
        [(sec(T) + 66,) * 2, (sec(T) + 132,) * 2, (sec(T) + 132, sec(T) + 332)]
    )


def test_a_gap_of_exactly_the_threshold_is_none(runs):
    assert spans(ledger.gap_intervals(runs([(T, None), (plus(T, 100), None)]), 100)) == []


def test_gap_across_days(runs):
    late = at("2026-08-12 23:59:30")
    assert spans(ledger.gap_intervals(runs([(late, None), (plus(late, 3 * 86400), None)]), 100)) == [
        (sec(late), sec(late) + 3 * 86400)
    ]


def test_uptime_and_empty_ledger(runs):
    row = ledger.uptime(runs([(T, None), (plus(T, 60), None), (plus(T, 660), None), (plus(T, 1000), None)]), 100).first()
    assert (row["poll_cycles"], row["gap_count"]) == (4, 2)
    assert abs(row["uptime_pct"] - 100 * (1 - 940 / 1000)) < 1e-9
    assert abs(row["longest_gap_hours"] - 600 / 3600) < 1e-12
    one = ledger.uptime(runs([(T, None)]), 100).first()
    assert (one["poll_cycles"], one["gap_count"], one["uptime_pct"]) == (1, 0, 0.0)


def test_uptime_until(runs):
    cycles = runs([(T, None), (plus(T, 60), None), (plus(T, 6000), None)])
    assert ledger.uptime(cycles, 100, until=F.lit(plus(T, 100))).first()["gap_count"] == 0


def test_median_cadence_interpolates(runs):
    cycles = runs([(plus(T, s), None) for s in (0, 60, 130, 200, 900)])
    assert ledger.median_cadence(cycles).first()[0] == 70.0
    assert ledger.median_cadence(runs([(T, None), (plus(T, 60), None), (plus(T, 130), None)])).first()[0] == 65.0
    assert ledger.median_cadence(runs([(T, None)])).first()[0] is None


def test_public_gaps(runs):
    steps = [(0, None), (60, None), (120, "HTTP 503 status"), (180, ""), (240, None), (840, None), (900, None), (1500, "timed out")]
    rows = {r["started_at"][11:19]: r for r in ledger.public_gaps(runs([(plus(T, s), e) for s, e in steps])).collect()}
    assert set(rows) == {"12:02:00", "12:04:00", "12:15:00"}
    on_time = rows["12:02:00"]
    assert (on_time["reason"], on_time["cycles_missed"], on_time["duration_seconds"]) == (
        "upstream server error (1 of 3 batches)",
        0,
        2,
    )
    silent = rows["12:04:00"]
    assert (silent["reason"], silent["cycles_missed"], silent["detail"]) == ("no poll recorded", 9, None)
    assert rows["12:15:00"]["reason"] == "upstream unreachable (1 of 3 batches)"


def test_shared_start_keeps_the_later_gap(runs):
    cycles = runs([(T, None), (plus(T, 60), "HTTP 503 status"), (plus(T, 660), None), (plus(T, 720), None)])
    rows = ledger.latest_public_gaps(cycles).collect()
    assert [(r["started_at"][11:19], r["reason"]) for r in rows] == [("12:01:00", "no poll recorded")]


def test_ingest_gates_fail_without_data(runs, events):
    now = F.lit(plus(T, 4000))
    got = {r["gate"]: r for r in gates.gate_rows(
        gates.ingest_gates(events(dict(polled_at=T)), runs([(T, None)]).withColumn("inserted", F.lit(1)), now)
    ).collect()}
    assert [got[g]["passed"] for g in ("freshness", "volume", "null_rate")] == [False, False, False]
    assert got["null_rate"]["detail"] == "no snapshots in the last hour"
    empty = runs([(T, None)]).filter("false").withColumn("inserted", F.lit(1))
    got = {r["gate"]: r for r in gates.gate_rows(gates.ingest_gates(events(dict(polled_at=T)), empty, now)).collect()}
    assert got["freshness"]["detail"] == "no cycle recorded"
