"""Queries on the ledger, labels, gates and status."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopline.catalog import inputs
from stopline.catalog.registry import query
from stopline.catalog.sql import KEY, LABEL_COLS, check, seconds, service_day
from stopline.functions import numeric as num
from stopline.functions import timecols as tc
from stopline.operators import diagnostics as diag
from stopline.operators import features as feat
from stopline.operators import gates, ledger, status
from stopline.operators import labels as lab
from stopline.sources import derived as d

RULES = inputs.RULES
THRESHOLD = RULES.gap_threshold_seconds
SINCE = "2024-01-10"
UNTIL = "2024-01-12"


def _now(spark, sf):
    """The clock of these queries: one and a half minutes after the latest cycle."""
    return tc.plus_seconds(ledger.latest_cycle(d.poll_runs(spark, sf)).scalar(), 90)


NOW = "(SELECT as_of + INTERVAL 90 SECOND FROM latest)"

# --- ledger


@query("w_gap_intervals", check("SELECT gap_start, gap_end FROM gaps"))
def _(spark, sf):
    return ledger.gap_intervals(d.poll_runs(spark, sf), THRESHOLD)


@query(
    "union_gaps",
    check(
        "SELECT gap_start, gap_end, count(*) AS n, count(*) FILTER (WHERE gap_start = gap_end) AS points "
        "FROM gaps GROUP BY ALL"
    ),
)
def _(spark, sf):
    gaps = ledger.gap_intervals(d.poll_runs(spark, sf), THRESHOLD)
    return gaps.groupBy("gap_start", "gap_end").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("gap_start") == F.col("gap_end")).alias("points")
    )


@query("median_cadence", check("SELECT m AS cadence_seconds FROM cad"))
def _(spark, sf):
    return ledger.median_cadence(d.poll_runs(spark, sf))


PUBLIC = f"""
SELECT strftime(a, '%Y-%m-%dT%H:%M:%S.%fZ') AS started_at, strftime(b, '%Y-%m-%dT%H:%M:%S.%fZ') AS ended_at,
       CAST(round_even({seconds('a', 'b')}, 0) AS BIGINT) AS duration_seconds,
       CASE WHEN error IS NULL THEN 'no poll recorded' ELSE 'upstream server error (1 of 3 batches)' END AS reason,
       CAST(CASE WHEN silent THEN greatest(0, round_even({seconds('a', 'b')} / (SELECT m FROM cad), 0) - 1) ELSE 0 END AS BIGINT) AS cycles_missed,
       error AS detail
FROM (SELECT *, CASE WHEN silent THEN prev ELSE started_at END AS a, CASE WHEN silent THEN polled_at ELSE finished_at END AS b FROM silences)
WHERE silent OR error IS NOT NULL"""


@query("w_public_gaps", check(PUBLIC))
def _(spark, sf):
    return ledger.public_gaps(d.poll_runs(spark, sf))


UPTIME = f"""
SELECT count(*) AS poll_cycles, {seconds('min(polled_at)', 'max(polled_at)')} / 3600 AS ledger_span_hours,
       count(*) FILTER (WHERE g > 900) AS gap_count, coalesce(sum(g) FILTER (WHERE g > 900), 0) / 3600 AS gap_hours,
       coalesce(max(g) FILTER (WHERE g > 900), 0) / 3600 AS longest_gap_hours,
       100 * (1 - coalesce(sum(g) FILTER (WHERE g > 900), 0) / {seconds('min(polled_at)', 'max(polled_at)')}) AS uptime_pct
FROM (SELECT *, {seconds('prev', 'polled_at')} AS g FROM walk)"""


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "uptime",
    check(
        "SELECT poll_cycles, round(ledger_span_hours, 6) AS ledger_span_hours, gap_count, round(gap_hours, 6) AS gap_hours, "
        f"round(longest_gap_hours, 6) AS longest_gap_hours, round(uptime_pct, 6) AS uptime_pct FROM ({UPTIME})"
    ),
)
def _(spark, sf):
    return _rounded(
        ledger.uptime(d.poll_runs(spark, sf), THRESHOLD),
        "ledger_span_hours",
        "gap_hours",
        "longest_gap_hours",
        "uptime_pct",
    )


@query(
    "ledger_span",
    check(
        "SELECT min(polled_at) AS first_cycle_at, count(*) AS cycles, max(polled_at) AS last_cycle_at, "
        f"{seconds('min(polled_at)', NOW)} / 86400 AS days_running FROM pr"
    ),
)
def _(spark, sf):
    return ledger.ledger_span(d.poll_runs(spark, sf), _now(spark, sf))


@query("as_of_default", check("SELECT as_of FROM latest"))
def _(spark, sf):
    return ledger.latest_cycle(d.poll_runs(spark, sf))


@query(
    "inserted_last_hour",
    check(f"SELECT CAST(coalesce(sum(inserted), 0) AS BIGINT) AS rows_last_hour FROM pr WHERE polled_at >= {NOW} - INTERVAL 1 HOUR"),
)
def _(spark, sf):
    return ledger.inserted_last_hour(d.poll_runs(spark, sf), _now(spark, sf))


@query("last_hour_filter", check(f"SELECT trip_id, stop_id, polled_at FROM se WHERE polled_at >= {NOW} - INTERVAL 1 HOUR"))
def _(spark, sf):
    return ledger.last_hour(d.stop_events(spark, sf), _now(spark, sf)).select("trip_id", "stop_id", "polled_at")


@query(
    "cycles_missed",
    check(
        f"SELECT polled_at, CAST(greatest(0, round_even({seconds('prev', 'polled_at')} / (SELECT m FROM cad), 0) - 1) AS BIGINT) AS cycles_missed "
        "FROM walk WHERE prev IS NOT NULL"
    ),
)
def _(spark, sf):
    runs = d.poll_runs(spark, sf)
    cadence = ledger.median_cadence(runs).scalar()
    walked = ledger.consecutive(runs.select("polled_at")).filter(F.col("prev_polled_at").isNotNull())
    return walked.select(
        "polled_at",
        num.cycles_missed(tc.epoch_seconds(F.col("prev_polled_at"), F.col("polled_at")), cadence).alias("cycles_missed"),
    )


# --- labels

GROUP_COLS = (
    "trip_id, stop_id, service_date_norm, route_id, direction_id, scheduled_arrival, final_predicted_arrival, "
    "observed_span_start, observed_span_end, n_snapshots"
)


@query("trip_stop_groups", check(f"SELECT {GROUP_COLS} FROM grp"))
def _(spark, sf):
    return lab.trip_stop_groups(d.stop_events(spark, sf)).drop("touched")


@query("touched_groups", check(f"SELECT {GROUP_COLS} FROM grp WHERE touched"))
def _(spark, sf):
    since, until = (F.lit(t).cast("timestamp") for t in (SINCE, UNTIL))
    return lab.touched_groups(d.stop_events(spark, sf), since, until)


@query(
    "is_settled",
    check(
        f"SELECT trip_id, stop_id, service_date_norm, {seconds('observed_span_end', '(SELECT as_of FROM latest)')} >= 1800 AS settled FROM grp"
    ),
)
def _(spark, sf):
    as_of = ledger.latest_cycle(d.poll_runs(spark, sf)).scalar()
    return lab.trip_stop_groups(d.stop_events(spark, sf)).select(
        "trip_id",
        "stop_id",
        "service_date_norm",
        lab.is_settled(F.col("observed_span_end"), as_of, RULES).alias("settled"),
    )


@query(
    "j_gap_abuts",
    check(
        "SELECT trip_id, stop_id, service_date_norm FROM grp WHERE EXISTS (SELECT 1 FROM gaps "
        "WHERE gap_start <= observed_span_end + INTERVAL 1800 SECOND AND gap_end >= observed_span_end)"
    ),
)
def _(spark, sf):
    events = d.stop_events(spark, sf)
    gaps = ledger.gap_intervals(d.poll_runs(spark, sf), THRESHOLD)
    marked = lab.mark_gap_abutted(lab.trip_stop_groups(events), gaps, RULES)
    return marked.filter("gap_abutted").select("trip_id", "stop_id", "service_date_norm")


@query("closed_reason", check(f"SELECT {LABEL_COLS} FROM el"))
def _(spark, sf):
    return inputs.event_labels(spark, sf)


LABEL_COUNTS = """
SELECT count(*) AS labels_total, count(*) FILTER (WHERE closed_reason IS NULL) AS labels_usable,
       count(*) FILTER (WHERE closed_reason = 'gap_abutted') AS labels_gap_abutted,
       count(*) FILTER (WHERE closed_reason = 'no_arrival_signal') AS labels_no_arrival"""


@query("label_counts", check(LABEL_COUNTS + " FROM el"))
def _(spark, sf):
    return lab.label_counts(inputs.event_labels(spark, sf))


@query("training_view", check(f"SELECT {LABEL_COLS} FROM lb WHERE closed_reason IS NULL"))
def _(spark, sf):
    return lab.training_labels(d.labels(spark, sf))


@query("late_flag", check(f"SELECT {KEY}, delay_seconds, late FROM lb"))
def _(spark, sf):
    labels = d.labels(spark, sf)
    return labels.select(*KEY.split(", "), "delay_seconds", lab.late_flag(F.col("delay_seconds"), RULES).alias("late"))


# --- gates, status, regime

GATE_COUNTS = """
SELECT count(*) AS t, count(*) FILTER (WHERE closed_reason IS NULL) AS u,
       count(*) FILTER (WHERE closed_reason IS NULL AND delay_seconds IS NULL) AS d FROM el"""
LABEL_GATES = f"""
SELECT 'volume' AS gate, t >= 1 AS passed, t || ' rows written (threshold: >= 1)' AS detail FROM ({GATE_COUNTS})
UNION ALL
SELECT 'null_rate', coalesce(100.0 * d / nullif(u, 0), 0) <= 0,
       printf('%d/%d normally closed rows lack a delay (%.2f%%, threshold: <= 0.0%%)', d, u, CAST(coalesce(100.0 * d / nullif(u, 0), 0) AS DOUBLE)) FROM ({GATE_COUNTS})
UNION ALL
SELECT 'label_rate', coalesce(100.0 * u / nullif(t, 0), 0) >= 50,
       printf('%d/%d rows are usable (%.2f%%, threshold: >= 50.0%%)', u, t, CAST(coalesce(100.0 * u / nullif(t, 0), 0) AS DOUBLE)) FROM ({GATE_COUNTS})"""


@query("gate_labels", check(LABEL_GATES))
def _(spark, sf):
    return gates.gate_rows(gates.label_gates(inputs.event_labels(spark, sf)))


@query(
    "json_encode",
    check(
        "SELECT '{' || string_agg('\"' || gate || '\":{\"passed\":' || passed || ',\"detail\":\"' || detail || '\"}', ',' "
        f"ORDER BY CASE gate WHEN 'volume' THEN 1 WHEN 'null_rate' THEN 2 ELSE 3 END) || '}}' AS gate_json FROM ({LABEL_GATES})"
    ),
)
def _(spark, sf):
    return gates.label_gates(inputs.event_labels(spark, sf)).select(F.to_json("gate_results").alias("gate_json"))


INGEST_GATES = f"""
SELECT 'freshness' AS gate, {seconds('(SELECT as_of FROM latest)', NOW)} / 60 <= 10 AS passed,
       printf('last cycle %.1f min ago', CAST({seconds('(SELECT as_of FROM latest)', NOW)} / 60 AS DOUBLE)) AS detail
UNION ALL
SELECT 'volume', coalesce(sum(inserted), 0) > 0, printf('%d rows inserted in the last hour', CAST(coalesce(sum(inserted), 0) AS BIGINT))
FROM pr WHERE polled_at >= {NOW} - INTERVAL 1 HOUR
UNION ALL
SELECT 'null_rate', coalesce(100.0 * n / nullif(t, 0) <= 15, false),
       CASE WHEN t = 0 THEN 'no snapshots in the last hour'
            ELSE printf('scheduled arrival null rate %.2f%% over the last hour (%d/%d)', CAST(100.0 * n / nullif(t, 0) AS DOUBLE), n, t) END
FROM (SELECT count(*) FILTER (WHERE scheduled_arrival IS NULL) AS n, count(*) AS t FROM se WHERE polled_at >= {NOW} - INTERVAL 1 HOUR)"""


@query("gate_ingest", check(INGEST_GATES))
def _(spark, sf):
    return gates.gate_rows(gates.ingest_gates(d.stop_events(spark, sf), d.poll_runs(spark, sf), _now(spark, sf)))


@query(
    "distinct_counts",
    check(
        "SELECT count(*) AS rows_total, count(DISTINCT route_id) AS distinct_routes, "
        "count(DISTINCT trip_id) AS distinct_trips, count(DISTINCT stop_id) AS distinct_stops FROM se"
    ),
)
def _(spark, sf):
    return status.distinct_counts(d.stop_events(spark, sf))


@query(
    "ingest_summary",
    check(
        f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE polled_at >= {NOW} - INTERVAL 1 HOUR) AS last_hour_rows,
       count(DISTINCT trip_id) AS distinct_trips, count(DISTINCT route_id) AS distinct_routes,
       count(DISTINCT stop_id) AS distinct_stops, min(polled_at) AS min_polled_at, max(polled_at) AS max_polled_at,
       count(*) FILTER (WHERE scheduled_arrival IS NULL) AS scheduled_arrival_null,
       printf('%.2f%%', CAST(100.0 * count(*) FILTER (WHERE scheduled_arrival IS NULL) / count(*) AS DOUBLE)) AS scheduled_arrival_null_pct,
       count(*) FILTER (WHERE predicted_arrival IS NULL) AS predicted_arrival_null,
       printf('%.2f%%', CAST(100.0 * count(*) FILTER (WHERE predicted_arrival IS NULL) / count(*) AS DOUBLE)) AS predicted_arrival_null_pct
FROM se"""
    ),
)
def _(spark, sf):
    return status.ingest_summary(d.stop_events(spark, sf), _now(spark, sf))


@query(
    "regime_report",
    check(
        f"""
SELECT s.*, (SELECT count(*) FROM se WHERE polled_at <= s.ingest_end) AS stop_events_rows, c.*,
       u.poll_cycles, round(u.ledger_span_hours, 6) AS ledger_span_hours, u.gap_count, round(u.gap_hours, 6) AS gap_hours,
       round(u.longest_gap_hours, 6) AS longest_gap_hours, round(u.uptime_pct, 6) AS uptime_pct,
       {seconds('s.ingest_start', 's.ingest_end')} / 86400 AS ingest_days
FROM (SELECT min(observed_span_start) AS ingest_start, max(observed_span_end) AS ingest_end FROM el) s
CROSS JOIN ({LABEL_COUNTS} FROM el) c
CROSS JOIN ({UPTIME} WHERE polled_at <= (SELECT max(observed_span_end) FROM el)) u"""
    ),
)
def _(spark, sf):
    row = status.regime_report(
        inputs.event_labels(spark, sf), d.stop_events(spark, sf), d.poll_runs(spark, sf), THRESHOLD
    )
    return _rounded(row, "ledger_span_hours", "gap_hours", "longest_gap_hours", "uptime_pct")


STATUS = f"""
SELECT strftime(date_trunc('minute', {NOW}), '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at,
       strftime(first_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS first_cycle_at,
       {seconds('first_at', NOW)} / 86400 AS days_running, cycles,
       rows_total, rows_last_hour, (SELECT m FROM cad) AS cadence_seconds, distinct_routes, distinct_trips, distinct_stops,
       labels_total, labels_gap_abutted, labels_no_arrival, CAST(NULL AS DOUBLE) AS disk_free_gib,
       gates_pass, gates_total, gate_detail
FROM (SELECT min(polled_at) AS first_at, count(*) AS cycles FROM pr)
CROSS JOIN (SELECT CAST(coalesce(sum(inserted), 0) AS BIGINT) AS rows_last_hour FROM pr WHERE polled_at >= {NOW} - INTERVAL 1 HOUR)
CROSS JOIN (SELECT count(*) AS rows_total, count(DISTINCT route_id) AS distinct_routes,
                   count(DISTINCT trip_id) AS distinct_trips, count(DISTINCT stop_id) AS distinct_stops FROM se)
CROSS JOIN ({LABEL_COUNTS} FROM el)
CROSS JOIN (SELECT CAST(count(*) FILTER (WHERE passed) AS INTEGER) AS gates_pass, CAST(count(*) AS INTEGER) AS gates_total,
                   '{{' || string_agg('"' || gate || '":{{"passed":' || passed || ',"detail":"' || detail || '"}}', ','
                                      ORDER BY CASE gate WHEN 'freshness' THEN 1 WHEN 'volume' THEN 2 ELSE 3 END) || '}}' AS gate_detail
            FROM ({INGEST_GATES}))"""


@query("status_snapshot", check(STATUS))
def _(spark, sf):
    return status.status_snapshot(
        d.stop_events(spark, sf), d.poll_runs(spark, sf), inputs.event_labels(spark, sf), _now(spark, sf)
    )


@query(
    "j_scalar_cross",
    check(
        f"SELECT labels_usable, stop_events_rows, poll_cycles FROM ({LABEL_COUNTS} FROM el) "
        "CROSS JOIN (SELECT count(*) AS stop_events_rows FROM se) CROSS JOIN (SELECT count(*) AS poll_cycles FROM pr)"
    ),
)
def _(spark, sf):
    return gates.side_by_side(
        lab.label_counts(inputs.event_labels(spark, sf)).select("labels_usable"),
        d.stop_events(spark, sf).agg(F.count(F.lit(1)).alias("stop_events_rows")),
        d.poll_runs(spark, sf).agg(F.count(F.lit(1)).alias("poll_cycles")),
    )


@query(
    "transform_summary",
    check(
        f"""
SELECT 'build_labels' AS transform_name, CAST(g.n AS INTEGER) AS groups_considered, CAST(l.n AS INTEGER) AS rows_written,
       l.n >= 1 AND l.u * 2 >= l.n AND l.d = 0 AS passed
FROM (SELECT count(*) AS n FROM grp WHERE touched) g
CROSS JOIN (SELECT count(*) AS n, count(*) FILTER (WHERE closed_reason IS NULL) AS u,
                   count(*) FILTER (WHERE closed_reason IS NULL AND delay_seconds IS NULL) AS d
            FROM el JOIN grp USING (trip_id, stop_id, service_date_norm) WHERE touched) l"""
    ),
)
def _(spark, sf):
    from stopline.plans import build_labels as bl

    since, until = (F.lit(t).cast("timestamp") for t in (SINCE, UNTIL))
    events, runs = d.stop_events(spark, sf), d.poll_runs(spark, sf)
    groups = lab.touched_groups(events, since, until)
    summary = gates.side_by_side(
        groups.agg(F.count(F.lit(1)).alias("groups_considered")),
        gates.label_gates(bl.closed_labels(events, runs, RULES, since, until)),
    )
    record = status.transform_record("build_labels", summary, SINCE, SINCE, UNTIL, UNTIL, None)
    return record.select("transform_name", "groups_considered", "rows_written", "passed")


# --- diagnostics


@query(
    "diag_key_reuse",
    check(
        "SELECT count(*) AS pairs, count(*) FILTER (WHERE span > 21600000000) AS long_span_pairs, "
        "count(*) FILTER (WHERE k > 1) AS several_schedule_pairs FROM (SELECT trip_id, stop_id, "
        "epoch_us(max(polled_at)) - epoch_us(min(polled_at)) AS span, count(DISTINCT scheduled_arrival) AS k FROM se GROUP BY 1, 2)"
    ),
)
def _(spark, sf):
    return diag.key_reuse(d.stop_events(spark, sf))


@query(
    "diag_mixed_null",
    check(
        "SELECT count(*) AS pairs, count(*) FILTER (WHERE a AND b) AS mixed_pairs FROM (SELECT trip_id, stop_id, "
        "bool_or(scheduled_arrival IS NULL) AS a, bool_or(scheduled_arrival IS NOT NULL) AS b FROM se GROUP BY 1, 2)"
    ),
)
def _(spark, sf):
    return diag.mixed_null(d.stop_events(spark, sf))


@query(
    "diag_proxy_gap",
    check(
        f"SELECT count(*) AS labels, round(avg({seconds('observed_span_end', 'final_predicted_arrival')}), 6) AS mean_seconds, "
        f"count(*) FILTER (WHERE {seconds('observed_span_end', 'scheduled_arrival')} > 1800) AS vanished_early, "
        f"median({seconds('observed_span_end', 'final_predicted_arrival')}) AS median_seconds FROM el WHERE closed_reason IS NULL"
    ),
)
def _(spark, sf):
    closed = lab.training_labels(inputs.event_labels(spark, sf))
    return _rounded(diag.proxy_gap(closed), "mean_seconds")


@query(
    "feat_horizon_asof_delay",
    check(
        f"""
SELECT trip_id, stop_id, sdn AS service_date_norm, max(polled_at) AS horizon_polled_at,
       arg_max_null(CAST(round_even({seconds('scheduled_arrival', 'predicted_arrival')}, 0) AS INTEGER), polled_at) AS horizon_delay_seconds
FROM (SELECT *, {service_day('scheduled_arrival')} AS sdn FROM se) WHERE polled_at <= scheduled_arrival - INTERVAL 10 MINUTE
GROUP BY ALL"""
    ),
)
def _(spark, sf):
    return feat.horizon_delay(d.stop_events(spark, sf))


@query(
    "diag_horizon_availability",
    check(
        """
SELECT 'current_delay_persistence_seconds' AS feature, count(s) AS available,
       count(*) FILTER (WHERE s <= scheduled_arrival - INTERVAL 10 MINUTE) AS settled_in_time
FROM (SELECT scheduled_arrival, arg_max(observed_span_end, (scheduled_arrival, observed_span_end)) OVER (
        PARTITION BY trip_id, service_date_norm ORDER BY scheduled_arrival GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM tr)
UNION ALL
SELECT 'route_hour_historical_late_rate', count(s), count(*) FILTER (WHERE s <= scheduled_arrival - INTERVAL 10 MINUTE)
FROM (SELECT scheduled_arrival, arg_max(observed_span_end, (scheduled_arrival, observed_span_end)) OVER (
        PARTITION BY route_id, hour_of_day ORDER BY scheduled_arrival GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM tr)"""
    ),
)
def _(spark, sf):
    return diag.horizon_availability(inputs.training(spark, sf))


@query(
    "diag_day_coverage",
    check(
        """
SELECT split, service_date_norm, day_of_week AS weekday, count(*) AS rows,
       sum(CAST(late AS INTEGER)) / CAST(count(*) AS DOUBLE) AS late_rate FROM sp GROUP BY ALL"""
    ),
)
def _(spark, sf):
    return diag.day_coverage(inputs.split_rows(spark, sf))


@query(
    "diag_empty_cells",
    check(
        """
SELECT d.service_date_norm, CAST(h AS INTEGER) AS hour_of_day
FROM (SELECT DISTINCT service_date_norm FROM tr) d CROSS JOIN (SELECT unnest(range(24)) AS h)
WHERE NOT EXISTS (SELECT 1 FROM tr WHERE tr.service_date_norm = d.service_date_norm AND tr.hour_of_day = h)"""
    ),
)
def _(spark, sf):
    return diag.empty_cells(inputs.training(spark, sf))
