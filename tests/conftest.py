import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stopline.session import local_session  # noqa: E402

RUNS = "polled_at timestamp, started_at timestamp, finished_at timestamp, batches_ok int, batches_total int, error string"
EVENTS = (
    "route_id string, direction_id int, stop_id string, trip_id string, vehicle_id string, service_date date, "
    "scheduled_arrival timestamp, predicted_arrival timestamp, status string, polled_at timestamp"
)
LABELS = (
    "service_date_norm date, route_id string, direction_id int, stop_id string, trip_id string, "
    "scheduled_arrival timestamp, final_predicted_arrival timestamp, delay_seconds int, late boolean, "
    "observed_span_start timestamp, observed_span_end timestamp, n_snapshots int, closed_reason string"
)
UTC = dt.timezone.utc


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def plus(t: dt.datetime, seconds: float) -> dt.datetime:
    return t + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "stopline-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def runs(spark):
    """Ledger rows from (polled_at, error) pairs."""

    def make(pairs, ok=3, total=3):
        rows = [(t, t, plus(t, 2), ok if e is None else 2, total, e) for t, e in pairs]
        return spark.createDataFrame(rows, RUNS)

    return make


@pytest.fixture
def events(spark):
    def make(*rows):
        base = dict(
            route_id="1", direction_id=0, stop_id="s1", trip_id="t1", vehicle_id=None, service_date=dt.date(2026, 8, 12),
            scheduled_arrival=None, predicted_arrival=None, status=None, polled_at=None,
        )
        return spark.createDataFrame([tuple((base | r).values()) for r in rows], EVENTS)

    return make


@pytest.fixture
def labels(spark):
    def make(*rows):
        out = []
        for r in rows:
            t = r["scheduled_arrival"]
            base = dict(
                service_date_norm=(t - dt.timedelta(hours=7)).date(), route_id="1", direction_id=0, stop_id="s1",
                trip_id="t1", scheduled_arrival=t, final_predicted_arrival=plus(t, r.get("delay_seconds") or 0),
                delay_seconds=0, late=(r.get("delay_seconds") or 0) > 180, observed_span_start=plus(t, -600),
                observed_span_end=t, n_snapshots=5, closed_reason=None,
            )
            out.append(tuple((base | r).values()))
        return spark.createDataFrame(out, LABELS)

    return make
