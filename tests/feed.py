"""Small prediction pages for tests."""

from __future__ import annotations

import json


def link(ident, kind):
    return {"data": None if ident is None else {"id": ident, "type": kind}}


def prediction(n, trip="t1", stop="s1", route="23", direction=0, arrival="2026-08-12T21:17:46-04:00",
               departure=None, vehicle="v1", schedule=None):
    return {
        "id": f"prediction-{n}",
        "type": "prediction",
        "attributes": {"arrival_time": arrival, "departure_time": departure, "direction_id": direction, "status": None},
        "relationships": {
            "route": link(route, "route"),
            "stop": link(stop, "stop"),
            "trip": link(trip, "trip"),
            "vehicle": link(vehicle, "vehicle"),
            "schedule": link(schedule, "schedule"),
        },
    }


def schedule(ident, arrival="2026-08-12T21:19:30-04:00", **more):
    return {"id": ident, "type": "schedule", "attributes": {"arrival_time": arrival, "departure_time": None} | more}


def page(data=(), included=(), more=None):
    body = {"data": list(data), "included": list(included)}
    if more:
        body["links"] = {"next": more}
    return body


def eight():
    """Eight predictions: three normal, one arrival only, one origin stop, one added, two cancelled."""
    data = [
        prediction(1, "a", schedule="sa"),
        prediction(2, "b", stop="s2", schedule="sb"),
        prediction(3, "c", arrival="2026-08-12T21:40:00-04:00", departure="2026-08-12T21:41:00-04:00", schedule="sc"),
        prediction(4, "d", schedule="sd"),
        prediction(5, "origin", arrival=None, departure="2026-08-12T21:50:00-04:00", vehicle=None, schedule="so"),
        prediction(6, "added", direction=1, schedule=None),
        prediction(7, "gone", arrival=None, schedule="sg"),
        prediction(8, "gone", stop="s2", arrival=None, schedule="sh"),
    ]
    included = [schedule(s) for s in ("sa", "sb", "sc", "sd", "sg", "sh")] + [schedule("so", arrival=None)]
    return data, included


def text(body):
    return body if isinstance(body, str) else json.dumps(body)
