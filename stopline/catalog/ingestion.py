"""Queries on pages, the contract, mapping, sinks and streams."""

from __future__ import annotations

import copy

from pyspark.sql import functions as F

from stopline.catalog import inputs
from stopline.catalog.registry import query
from stopline.catalog.sql import KEY, LABEL_COLS, PAGE, SNAPSHOT, check, seconds
from stopline.config import LABEL_KEY, STOP_EVENT_KEY
from stopline.operators import contract as ct
from stopline.operators import features as feat
from stopline.operators import gates, ledger, status
from stopline.operators import labels as lab
from stopline.operators import predictions as pr
from stopline.plans import ingest
from stopline.session import work_path
from stopline.sources import derived as d
from stopline.sources import pages as pg
from stopline.sources import tables as tb
from stopline.sources.versioned import Table
from stopline.streaming import jobs

PAGE_COLS = PAGE.split(", ")
NOT_FAILED = "NOT EXISTS (SELECT 1 FROM fb WHERE fb.polled_at = {t}.polled_at AND fb.batch = {t}.batch)"


def _reading(spark, sf):
    return ingest.read(inputs.resources(spark, sf))


# --- pages


@query("pages_source", check(f"SELECT {PAGE}, readable, more, CASE WHEN readable THEN n ELSE 0 END AS predictions FROM pg"))
def _(spark, sf):
    folder = work_path(spark, "landed")
    pg.land_page_lines(inputs.pages(spark, sf), folder)
    rows = pg.resources(pg.read_page_lines(spark, folder))
    return rows.groupBy(*PAGE_COLS, "readable", "more").agg(F.count_if(F.col("section") == "data").alias("predictions"))


@query("pages_merge", check(f"SELECT {PAGE}, CAST(pos AS INTEGER) AS pos, 'p' || event_id AS id FROM vev"))
def _(spark, sf):
    return _reading(spark, sf).valid.filter(F.col("section") == "data").select(*PAGE_COLS, "pos", "id")


@query(
    "union_pages",
    check("SELECT polled_at, batch, sum(n)::BIGINT AS predictions, sum(n + vehicles)::BIGINT AS included FROM pg WHERE readable GROUP BY 1, 2"),
)
def _(spark, sf):
    rows = inputs.resources(spark, sf).filter("readable")
    return rows.groupBy("polled_at", "batch").agg(
        F.count_if(F.col("section") == "data").alias("predictions"),
        F.count_if(F.col("section") == "included").alias("included"),
    )


@query(
    "page_truncation_flag",
    check(
        "SELECT polled_at, batch, count(*) AS pages, max(page_no) AS last_page, "
        "max(page_no) >= 5 AND arg_max(more, page_no) AS truncated FROM pg GROUP BY 1, 2"
    ),
)
def _(spark, sf):
    return pg.batch_pages(pg.page_rows(inputs.resources(spark, sf)))


# --- contract


@query("contract_violations", check("SELECT * FROM pv"))
def _(spark, sf):
    return ct.violations(pr.read_resources(inputs.pages(spark, sf)))


def _clause(key, clause):
    def build(spark, sf):
        found = _reading(spark, sf).found
        return found.filter(F.col("clause") == clause).select(*PAGE_COLS, "section", "idx", "path", "value")

    query(key, check(f"SELECT {PAGE}, section, idx, path, value FROM pv WHERE clause = '{clause}'"))(build)


for _name in ("resource_type", "top_level", "attr_missing", "attr_null", "attr_type", "attr_allowed", "rel_missing", "rel_id_type"):
    _clause(f"cv_{_name}", _name)


@query(
    "cv_rel_null_data",
    check(
        f"SELECT {PAGE}, 'data' AS section, CAST(pos AS INTEGER) AS idx, 'relationships.route.data' AS path "
        "FROM rev WHERE user_id % 50 = 7 AND k NOT IN (9, 10, 11, 13)"
    ),
)
def _(spark, sf):
    strict = copy.deepcopy(ct.CONTRACT)
    strict["prediction"]["relationships"]["route"]["nullable_data"] = False
    found = ct.violations(pr.read_resources(inputs.pages(spark, sf), strict))
    return found.filter(F.col("clause") == "rel_null_data").select(*PAGE_COLS, "section", "idx", "path")


@query(
    "cv_included_filter",
    check(f"SELECT {PAGE}, n AS checked, vehicles AS ignored FROM pg WHERE readable"),
)
def _(spark, sf):
    rows = inputs.resources(spark, sf).filter(F.col("section") == "included")
    return rows.groupBy(*PAGE_COLS).agg(
        F.count_if(F.col("kind") == "schedule").alias("checked"), F.count_if(F.col("kind") != "schedule").alias("ignored")
    )


@query("cv_quarantine", check(f"SELECT {PAGE}, n AS predictions FROM pg WHERE readable AND NOT broken"))
def _(spark, sf):
    rows = _reading(spark, sf).valid.filter("readable")
    return rows.groupBy(*PAGE_COLS).agg(F.count_if(F.col("section") == "data").alias("predictions"))


# --- mapping


@query("map_predictions", check(f"SELECT {SNAPSHOT}, batch, page_no, pos FROM mp"))
def _(spark, sf):
    return _reading(spark, sf).mapped.drop("unreadable")


@query("skip_no_time", check(f"SELECT {PAGE}, CAST(pos AS INTEGER) AS pos, 'p' || event_id AS id FROM prd"))
def _(spark, sf):
    return pr.has_time(pr.predictions(_reading(spark, sf).valid)).select(*PAGE_COLS, "pos", "id")


@query("j_schedule", check(
    f"""SELECT p.polled_at, p.batch, p.page_no, CAST(p.pos AS INTEGER) AS pos, arrival IS NOT NULL AS has_arrival, own_date
        FROM prd p LEFT JOIN sch s ON s.polled_at = p.polled_at AND s.batch = p.batch AND s.schedule_id = p.schedule_id"""
))
def _(spark, sf):
    valid = _reading(spark, sf).valid
    rows = pr.with_schedule(pr.has_time(pr.predictions(valid)), pr.schedules(valid))
    return rows.select(
        *PAGE_COLS,
        "pos",
        F.col("schedule.arrival_time").isNotNull().alias("has_arrival"),
        F.to_date("schedule.service_date").alias("own_date"),
    )


@query("service_date_fallback", check(f"SELECT {PAGE}, pos, service_date FROM mp"))
def _(spark, sf):
    return _reading(spark, sf).mapped.select(*PAGE_COLS, "pos", "service_date")


@query(
    "prefilter_required",
    check(
        "SELECT polled_at, count(*) FILTER (WHERE route_id IS NOT NULL) AS kept, "
        "count(*) FILTER (WHERE route_id IS NULL) AS skipped FROM mp GROUP BY 1"
    ),
)
def _(spark, sf):
    return _reading(spark, sf).mapped.groupBy("polled_at").agg(
        F.count_if(pr.complete()).alias("kept"), F.count_if(~pr.complete()).alias("skipped")
    )


@query(
    "json_path",
    check(
        f"""SELECT {PAGE}, CAST(pos AS INTEGER) AS pos, CASE WHEN k <> 14 THEN 'p' || event_id END AS id,
               CASE WHEN k = 10 THEN '23' WHEN k NOT IN (9, 11) AND user_id % 50 <> 7 THEN 'r' || (user_id % 13) END AS route_id,
               CASE WHEN k <> 12 THEN 't' || user_id END AS trip_id, CASE WHEN user_id % 4 <> 0 THEN 'v' || (user_id % 50) END AS vehicle_id
            FROM rev"""
    ),
)
def _(spark, sf):
    rows = inputs.resources(spark, sf).filter(F.col("section") == "data")
    return rows.select(*PAGE_COLS, "pos", "id", "route_id", "trip_id", "vehicle_id")


CYCLE = "polled_at, batches_ok, batches_total, pages_fetched, rows, inserted, skipped, error"


@query("cycle_summary", check(f"SELECT {CYCLE} FROM cs"))
def _(spark, sf):
    r = _reading(spark, sf)
    inserted = ingest.first_sightings(r.snapshots).groupBy("polled_at").agg(F.count(F.lit(1)).alias("inserted"))
    return pr.cycle_summary(r.page_rows, r.found, r.failed, r.mapped, inserted, d.BATCHES)


# --- sinks: the table after two overlapping writes

CUT_A, CUT_B = "2024-01-12", "2024-01-18"


@query(
    "stop_events_sink",
    check(
        f"SELECT {SNAPSHOT.replace('status', 'CASE WHEN polled_at >= TIMESTAMP ' + repr(CUT_B) + chr(32) + 'THEN ' + repr('second') + ' END AS status')} FROM se"
    ),
)
def _(spark, sf):
    path = work_path(spark, "stop-events")
    rows = tb.with_month(d.stop_events(spark, sf))
    tb.insert_absent(rows.filter(F.col("polled_at") < CUT_B), path, STOP_EVENT_KEY, tb.MONTH)
    again = rows.filter(F.col("polled_at") >= CUT_A).withColumn("status", F.lit("second"))
    tb.insert_absent(again, path, STOP_EVENT_KEY, tb.MONTH)
    return tb.read(spark, path).drop(tb.MONTH)


@query(
    "poll_runs_sink",
    check(
        "SELECT polled_at, started_at, finished_at, batches_ok, batches_total, pages_fetched, rows, inserted, "
        f"CASE WHEN polled_at >= TIMESTAMP '{CUT_B}' THEN 1 ELSE 0 END AS skipped, error FROM pr"
    ),
)
def _(spark, sf):
    path = work_path(spark, "poll-runs")
    runs = d.poll_runs(spark, sf)
    tb.insert_absent(runs.filter(F.col("polled_at") < CUT_B), path, ["polled_at"])
    tb.insert_absent(runs.filter(F.col("polled_at") >= CUT_A).withColumn("skipped", F.lit(1)), path, ["polled_at"])
    return tb.read(spark, path)


@query(
    "monthly_partitioning",
    check("SELECT CAST(date_trunc('month', polled_at) AS DATE) AS polled_month, count(*) AS n FROM se GROUP BY 1"),
)
def _(spark, sf):
    path = work_path(spark, "monthly")
    Table(spark, path, tb.MONTH).append(tb.with_month(d.stop_events(spark, sf)))
    return tb.read(spark, path).groupBy(tb.MONTH).agg(F.count(F.lit(1)).alias("n"))


@query("verified_rewrite", check("SELECT count(*) AS rows, count(DISTINCT (trip_id, stop_id, polled_at)) AS keys FROM se"))
def _(spark, sf):
    path = work_path(spark, "rewrite")
    d.stop_events(spark, sf).write.parquet(path)
    tb.verified_rewrite(spark, path, F.lit(CUT_B).cast("timestamp"))
    return tb.read(spark, path).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(F.struct(*STOP_EVENT_KEY)).alias("keys")
    )


LATE_CUT = "2026-11-05"


@query(
    "labels_upsert",
    check(
        f"SELECT {LABEL_COLS.replace('n_snapshots', 'CASE WHEN service_date_norm >= DATE ' + repr(LATE_CUT) + ' THEN 6 ELSE n_snapshots END AS n_snapshots')} FROM lb"
    ),
)
def _(spark, sf):
    path = work_path(spark, "labels")
    rows = inputs.labels(spark, sf)
    tb.upsert(rows.filter(F.col("service_date_norm") < "2026-11-15"), path, LABEL_KEY, "service_date_norm")
    again = rows.filter(F.col("service_date_norm") >= LATE_CUT).withColumn("n_snapshots", F.lit(6))
    tb.upsert(again, path, LABEL_KEY, "service_date_norm")
    return tb.read(spark, path).select(*LABEL_COLS.split(", "))


@query(
    "features_upsert",
    check(f"SELECT {KEY}, route_hour_historical_late_rate, headway_seconds, hour_of_day, day_of_week, current_delay_persistence_seconds FROM ft"),
)
def _(spark, sf):
    path = work_path(spark, "features")
    training = inputs.training(spark, sf)
    day = lambda t: F.lit(t).cast("timestamp")
    tb.upsert(feat.build(training, None, day("2026-11-15")), path, LABEL_KEY, "service_date_norm")
    tb.upsert(feat.build(training, day(LATE_CUT), None), path, LABEL_KEY, "service_date_norm")
    return tb.read(spark, path).select(
        *LABEL_KEY,
        "route_hour_historical_late_rate",
        "headway_seconds",
        "hour_of_day",
        "day_of_week",
        "current_delay_persistence_seconds",
    )


@query(
    "transform_runs_append",
    check(
        f"""
SELECT 'build_labels' AS transform_name, CAST(count(*) AS INTEGER) AS groups_considered, CAST(count(*) AS INTEGER) AS rows_written,
       avg(CAST(closed_reason IS NULL AS INTEGER)) >= 0.5 AS passed, 3 AS gates FROM el
UNION ALL
SELECT 'build_features', CAST(count(*) AS INTEGER), CAST(count(*) AS INTEGER), true, 2 FROM ft"""
    ),
)
def _(spark, sf):
    path = work_path(spark, "transform-runs")
    for name, summary in (
        ("build_labels", gates.label_gates(inputs.event_labels(spark, sf))),
        ("build_features", gates.feature_gates(inputs.features(spark, sf))),
    ):
        counted = summary.withColumn("groups_considered", F.col("rows_written"))
        tb.append(status.transform_record(name, counted, CUT_A, None, CUT_B, CUT_B, None), path)
    return tb.read(spark, path).select(
        "transform_name", "groups_considered", "rows_written", "passed", F.size("gate_results").alias("gates")
    )


PUBLIC = f"""
SELECT strftime(a, '%Y-%m-%dT%H:%M:%S.%fZ') AS started_at, arg_max(strftime(b, '%Y-%m-%dT%H:%M:%S.%fZ'), polled_at) AS ended_at,
       arg_max(CAST(round_even({seconds('a', 'b')}, 0) AS BIGINT), polled_at) AS duration_seconds
FROM (SELECT *, CASE WHEN silent THEN prev ELSE started_at END AS a, CASE WHEN silent THEN polled_at ELSE finished_at END AS b FROM silences)
WHERE silent OR error IS NOT NULL GROUP BY 1"""
NOTHING = "CAST(NULL AS BIGINT)"
COUNTED = "rows_total", "cycles", "distinct_routes", "distinct_trips", "distinct_stops", "labels_total", "labels_gap_abutted", "labels_no_arrival"


def _published(moment, cycles):
    """The snapshot row published at a moment, from the ledger rows known then."""
    return f"""
SELECT 'snapshot' AS kind, strftime(date_trunc('minute', CAST({moment} AS TIMESTAMP)), '%Y-%m-%dT%H:%M:%S.%fZ') AS at, CAST(NULL AS VARCHAR) AS ended_at, {NOTHING} AS duration_seconds,
       (SELECT count(*) FROM se) AS rows_total, (SELECT count(*) FROM pr WHERE {cycles}) AS cycles,
       (SELECT count(DISTINCT route_id) FROM se) AS distinct_routes, (SELECT count(DISTINCT trip_id) FROM se) AS distinct_trips,
       (SELECT count(DISTINCT stop_id) FROM se) AS distinct_stops, (SELECT count(*) FROM el) AS labels_total,
       (SELECT count(*) FROM el WHERE closed_reason = 'gap_abutted') AS labels_gap_abutted,
       (SELECT count(*) FROM el WHERE closed_reason = 'no_arrival_signal') AS labels_no_arrival"""


@query(
    "status_upsert",
    check(
        f"""
SELECT 'gap' AS kind, started_at AS at, ended_at, duration_seconds, {", ".join(f"{NOTHING} AS {c}" for c in COUNTED)} FROM ({PUBLIC})
UNION ALL {_published(repr(CUT_B), f"polled_at < TIMESTAMP '{CUT_B}'")}
UNION ALL {_published("((SELECT as_of FROM latest) + INTERVAL 90 SECOND)", "true")}"""
    ),
)
def _(spark, sf):
    """Both published tables: the gap ledger and the status snapshots."""
    from stopline.functions import timecols as tc
    from stopline.plans import publish

    runs = d.poll_runs(spark, sf)
    events, labels = d.stop_events(spark, sf), inputs.event_labels(spark, sf)
    snapshots, gaps = work_path(spark, "snapshots"), work_path(spark, "gaps")
    as_of = ledger.latest_cycle(runs).scalar()
    early = F.lit(CUT_B).cast("timestamp")
    publish.publish(events, runs.filter(F.col("polled_at") < CUT_B), labels, early, snapshots, gaps)
    publish.publish(events, runs, labels, tc.plus_seconds(as_of, 90), snapshots, gaps)
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    silent = tb.read(spark, gaps).select(
        F.lit("gap").alias("kind"), F.col("started_at").alias("at"), "ended_at", "duration_seconds", *[none(c, "long") for c in COUNTED]
    )
    counted = [F.col(c).cast("long").alias(c) for c in COUNTED]
    shown = tb.read(spark, snapshots).select(
        F.lit("snapshot").alias("kind"), F.col("published_at").alias("at"), none("ended_at", "string"), none("duration_seconds", "long"), *counted
    )
    return silent.unionByName(shown)


@query("snapshot_retention", check("SELECT polled_at FROM pr ORDER BY polled_at DESC LIMIT 2000"))
def _(spark, sf):
    return tb.keep_newest(d.poll_runs(spark, sf).select("polled_at"), "polled_at", 2000)


# --- streams


def _ingested(spark, sf):
    landing, events, runs = (work_path(spark, n) for n in ("pages", "events", "runs"))
    schema = jobs.land_pages(inputs.pages(spark, sf), landing)
    job = jobs.IngestJob(landing, events, runs, d.BATCHES)
    stream = jobs.file_stream(spark, landing, schema, files_per_trigger=16)
    jobs.run_available(stream, job.handle, work_path(spark, "checkpoint"))
    return events, runs


@query("st_ingest", check(f"SELECT {SNAPSHOT} FROM fs"))
def _(spark, sf):
    return tb.read(spark, _ingested(spark, sf)[0]).drop(tb.MONTH)


@query("st_ledger", check(f"SELECT {CYCLE} FROM cs"))
def _(spark, sf):
    return tb.read(spark, _ingested(spark, sf)[1]).select(*CYCLE.split(", "))


def _parts():
    at = F.col("polled_at")
    return [at < CUT_A, (at >= CUT_A) & (at < CUT_B), at >= CUT_B]


@query(
    "st_dedup",
    check("SELECT 't' || user_id AS trip_id, 's' || (user_id % 5) AS stop_id, time_bucket(INTERVAL '10 minutes', ts) AS polled_at FROM events GROUP BY ALL"),
)
def _(spark, sf):
    path = work_path(spark, "dedup")
    jobs.work_off(d.raw_sightings(spark, sf), _parts(), jobs.DedupJob(path).handle)
    return tb.read(spark, path).select(*STOP_EVENT_KEY)


def _settled(spark, sf, parts):
    events, labels, state, runs = (work_path(spark, n) for n in ("events", "labels", "state", "runs"))
    job = jobs.SettleJob(runs, events, labels, state, inputs.RULES)
    jobs.work_off_settling(d.stop_events(spark, sf), d.poll_runs(spark, sf), parts, job)
    return tb.read(spark, labels).select(*LABEL_COLS.split(", "))


@query("st_settle", check(f"SELECT {LABEL_COLS} FROM el"))
def _(spark, sf):
    return _settled(spark, sf, _parts())


@query("st_late_data", check(f"SELECT {LABEL_COLS} FROM el"))
def _(spark, sf):
    """The newest snapshots and cycles land first; older ones arrive late and reopen their groups."""
    return _settled(spark, sf, _parts()[::-1])
