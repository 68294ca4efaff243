"""Check SQL: the derived inputs and intermediate results as named common table expressions."""

from __future__ import annotations

import re


def ny(x: str) -> str:
    return f"((({x}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"


def service_day(x: str) -> str:
    return f"CAST({ny(x)} - INTERVAL 3 HOUR AS DATE)"


def ny_hour(x: str) -> str:
    return f"CAST(extract(hour FROM {ny(x)}) AS INTEGER)"


def ny_dow(x: str) -> str:
    return f"CAST(extract(dow FROM {ny(x)}) AS INTEGER)"


def seconds(a: str, b: str) -> str:
    """Elapsed seconds from a to b."""
    return f"((epoch_us({b}) - epoch_us({a})) / 1e6)"


KEY = "service_date_norm, route_id, direction_id, stop_id, trip_id"
LABEL_COLS = (
    KEY + ", scheduled_arrival, final_predicted_arrival, delay_seconds, late, "
    "observed_span_start, observed_span_end, n_snapshots, closed_reason"
)
SNAPSHOT = (
    "route_id, direction_id, stop_id, trip_id, vehicle_id, service_date, scheduled_arrival, "
    "predicted_arrival, status, polled_at"
)
PAGE = "polled_at, batch, page_no"

CTES: dict[str, str] = {
    # --- snapshots and ledger from events
    "se": f"""
        SELECT 'r' || (user_id % 13) AS route_id, CAST(user_id % 2 AS INTEGER) AS direction_id,
               's' || (user_id % 5) AS stop_id, 't' || user_id AS trip_id, 'v' || (user_id % 50) AS vehicle_id,
               CAST({ny('polled_at')} AS DATE) AS service_date, scheduled_arrival,
               CASE WHEN event_type <> 'signup'
                    THEN scheduled_arrival + to_seconds(CAST(round_even(value * 6, 0) AS BIGINT)) END AS predicted_arrival,
               CAST(NULL AS VARCHAR) AS status, polled_at
        FROM (SELECT *, CASE WHEN user_id % 20 <> 0
                             THEN date_trunc('day', polled_at) + to_hours(user_id % 24) + to_minutes(user_id % 60)
                        END AS scheduled_arrival,
                     row_number() OVER (PARTITION BY user_id, polled_at ORDER BY event_id) AS rn
              FROM (SELECT *, time_bucket(INTERVAL '10 minutes', ts) AS polled_at FROM events))
        WHERE rn = 1""",
    "pr": """
        SELECT polled_at, polled_at AS started_at, polled_at + INTERVAL 2 SECOND AS finished_at,
               CASE WHEN error IS NULL THEN 3 ELSE 2 END AS batches_ok, 3 AS batches_total, 3 AS pages_fetched,
               rows, rows AS inserted, 0 AS skipped, error
        FROM (SELECT time_bucket(INTERVAL '10 minutes', ts) AS polled_at, CAST(count(*) AS INTEGER) AS rows,
                     max(CASE WHEN event_type = 'error' AND value > 200 THEN 'HTTP 503 status ' || event_id END) AS error
              FROM events GROUP BY 1)""",
    "walk": "SELECT *, lag(polled_at) OVER (ORDER BY polled_at) AS prev FROM pr",
    "gaps": f"""
        SELECT polled_at AS gap_start, polled_at AS gap_end FROM pr WHERE error IS NOT NULL
        UNION ALL
        SELECT prev, polled_at FROM walk WHERE {seconds('prev', 'polled_at')} > 900""",
    "cad": f"SELECT median({seconds('prev', 'polled_at')}) AS m FROM walk WHERE prev IS NOT NULL",
    "silences": f"SELECT *, coalesce({seconds('prev', 'polled_at')} > 3 * m, false) AS silent FROM walk CROSS JOIN cad",
    "latest": "SELECT max(polled_at) AS as_of FROM pr",
    "grp": f"""
        SELECT trip_id, stop_id, sdn AS service_date_norm, arg_max(route_id, polled_at) AS route_id,
               arg_max(direction_id, polled_at) AS direction_id,
               arg_max(scheduled_arrival, polled_at) FILTER (WHERE scheduled_arrival IS NOT NULL) AS scheduled_arrival,
               arg_max(predicted_arrival, polled_at) FILTER (WHERE predicted_arrival IS NOT NULL) AS final_predicted_arrival,
               min(polled_at) AS observed_span_start, max(polled_at) AS observed_span_end,
               CAST(count(*) AS INTEGER) AS n_snapshots,
               bool_or(polled_at >= TIMESTAMP '2024-01-10' AND polled_at < TIMESTAMP '2024-01-12') AS touched
        FROM (SELECT *, {service_day('coalesce(scheduled_arrival, polled_at)')} AS sdn FROM se)
        GROUP BY 1, 2, 3""",
    "el": f"""
        SELECT service_date_norm, route_id, direction_id, stop_id, trip_id, scheduled_arrival, final_predicted_arrival,
               delay_seconds, delay_seconds > 180 AS late, observed_span_start, observed_span_end, n_snapshots,
               CASE WHEN delay_seconds IS NULL THEN 'no_arrival_signal'
                    WHEN EXISTS (SELECT 1 FROM gaps
                                 WHERE gap_start <= observed_span_end + INTERVAL 1800 SECOND
                                   AND gap_end >= observed_span_end) THEN 'gap_abutted' END AS closed_reason
        FROM (SELECT *, CAST(round_even({seconds('scheduled_arrival', 'final_predicted_arrival')}, 0) AS INTEGER) AS delay_seconds
              FROM grp)
        WHERE {seconds('observed_span_end', '(SELECT as_of FROM latest)')} >= 1800""",
    # --- labels, features and splits from order lines
    "lb": f"""
        SELECT {service_day('scheduled_arrival')} AS service_date_norm, route_id, direction_id, stop_id, trip_id,
               scheduled_arrival, scheduled_arrival + to_seconds(delay_seconds) AS final_predicted_arrival,
               delay_seconds, delay_seconds > 180 AS late,
               scheduled_arrival - INTERVAL 600 SECOND AS observed_span_start, scheduled_arrival AS observed_span_end,
               5 AS n_snapshots, closed_reason
        FROM (SELECT 'r' || (l_orderkey % 13) AS route_id, CAST(l_orderkey % 2 AS INTEGER) AS direction_id,
                     's' || l_linenumber AS stop_id, 't' || l_orderkey AS trip_id,
                     TIMESTAMP '2026-10-10' + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60 AS INTEGER))
                       + to_hours(l_orderkey % 24) + to_minutes(l_linenumber * 7) AS scheduled_arrival,
                     CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN NULL
                          ELSE CAST(round(l_discount * 6000) - 120 AS INTEGER) END AS delay_seconds,
                     CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'no_arrival_signal'
                          WHEN l_quantity >= 48 THEN 'gap_abutted' END AS closed_reason
              FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                                 ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice,
                                                          l_discount, l_returnflag, l_quantity) AS rn FROM lineitem)
              JOIN orders ON o_orderkey = l_orderkey WHERE rn = 1)""",
    "tr": f"SELECT *, {ny_hour('scheduled_arrival')} AS hour_of_day, {ny_dow('scheduled_arrival')} AS day_of_week FROM lb WHERE closed_reason IS NULL",
    "ft": f"""
        SELECT {KEY}, scheduled_arrival, delay_seconds, late,
               sum(CAST(late AS INTEGER)) OVER r / CAST(nullif(count(*) OVER r, 0) AS DOUBLE) AS route_hour_historical_late_rate,
               CAST(round({seconds('max(scheduled_arrival) OVER h', 'scheduled_arrival')}) AS INTEGER) AS headway_seconds,
               hour_of_day, day_of_week,
               arg_max(delay_seconds, (scheduled_arrival, stop_id)) OVER p AS current_delay_persistence_seconds
        FROM tr
        WINDOW r AS (PARTITION BY route_id, hour_of_day ORDER BY scheduled_arrival GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               h AS (PARTITION BY route_id, direction_id, stop_id ORDER BY scheduled_arrival GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               p AS (PARTITION BY trip_id, service_date_norm ORDER BY scheduled_arrival GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "cut": f"""
        SELECT max(scheduled_arrival) AS cut_at
        FROM (SELECT scheduled_arrival, row_number() OVER (ORDER BY scheduled_arrival, {KEY}) AS rn, count(*) OVER () AS n FROM ft)
        WHERE rn = CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT)""",
    "sp": "SELECT *, CASE WHEN scheduled_arrival <= (SELECT cut_at FROM cut) THEN 'train' ELSE 'test' END AS split FROM ft",
    "tlr": "SELECT sum(CAST(late AS INTEGER)) / CAST(count(*) AS DOUBLE) AS rate FROM sp WHERE split = 'train'",
    "bs": """
        SELECT 'baseline_always_on_time' AS candidate, split, CAST(late AS INTEGER) AS y, CAST(0 AS DOUBLE) AS score FROM sp
        UNION ALL
        SELECT 'baseline_route_hour_rate', split, CAST(late AS INTEGER),
               coalesce(route_hour_historical_late_rate, (SELECT rate FROM tlr)) FROM sp
        UNION ALL
        SELECT 'baseline_persistence', split, CAST(late AS INTEGER),
               CASE WHEN coalesce(current_delay_persistence_seconds, 0) > 180 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END FROM sp""",
    "cv": """
        SELECT *, true_positives / CAST(predicted AS DOUBLE) AS "precision",
               true_positives / CAST(nullif(positives, 0) AS DOUBLE) AS recall
        FROM (SELECT candidate, split, score, tp, n,
                     CAST(sum(tp) OVER w AS BIGINT) AS true_positives, CAST(sum(n) OVER w AS BIGINT) AS predicted,
                     sum(tp) OVER (PARTITION BY candidate, split) AS positives,
                     sum(n) OVER (PARTITION BY candidate, split) AS total
              FROM (SELECT candidate, split, score, sum(y) AS tp, count(*) AS n FROM bs GROUP BY ALL)
              WINDOW w AS (PARTITION BY candidate, split ORDER BY score DESC))""",
    "rk": """
        SELECT candidate, split, round(sum(tp / CAST(positives AS DOUBLE) * "precision"), 9) AS pr_auc,
               round(sum((n - tp) * (true_positives - tp + true_positives) / 2.0) / CAST(max(positives) * (max(total) - max(positives)) AS DOUBLE), 9) AS roc_auc,
               max(CASE WHEN "precision" >= 0.8 THEN recall END) AS recall_at_precision,
               min(CASE WHEN "precision" >= 0.8 THEN score END) AS threshold
        FROM cv GROUP BY ALL""",
    # --- pages from events
    "pev": """
        SELECT *, row_number() OVER (PARTITION BY polled_at, batch, page_no ORDER BY event_id) - 1 AS pos
        FROM (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000000 AS at_s,
                     CAST(round_even(value, 0) AS BIGINT) AS wait, TIMESTAMP '2024-01-01 04:45:00' + to_seconds(66 * (event_id // 300)) AS polled_at,
                     CAST(user_id % 3 AS INTEGER) AS batch, CAST(1 + event_id % 5 AS INTEGER) AS page_no, event_id % 499 AS k FROM events)""",
    "pg": f"""
        SELECT {PAGE}, NOT bool_or(event_id % 1999 = 1998) AS readable,
               bool_or(event_id % 11 = 0) AND NOT bool_or(event_id % 1999 = 1998) AS more,
               bool_or(k BETWEEN 1 AND 17) AS broken, count(*) AS n, count(*) FILTER (WHERE event_id % 17 = 0) AS vehicles
        FROM pev GROUP BY ALL""",
    "fb": "SELECT polled_at, batch, min(page_no) AS page_no FROM pg WHERE NOT readable GROUP BY ALL",
    "rev": f"SELECT pev.* FROM pev JOIN pg USING ({PAGE}) WHERE readable",
    "vev": f"SELECT pev.* FROM pev JOIN pg USING ({PAGE}) WHERE readable AND NOT broken",
    "pv": f"""
        SELECT {PAGE}, section, CAST(pos AS INTEGER) AS idx, CAST(seq AS INTEGER) AS seq, path, clause, value
        FROM rev JOIN (VALUES
            (1, 'data', 0, 'attributes.direction_id', 'attr_missing', NULL),
            (2, 'data', 0, 'attributes.direction_id', 'attr_null', NULL),
            (3, 'data', 0, 'attributes.direction_id', 'attr_type', '''0'''),
            (4, 'data', 0, 'attributes.direction_id', 'attr_allowed', '2'),
            (5, 'data', 0, 'attributes.direction_id', 'attr_type', 'true'),
            (6, 'data', 0, 'attributes.direction_id', 'attr_type', '1.5'),
            (7, 'data', 0, 'attributes.arrival_time', 'attr_type', '''soon'''),
            (8, 'data', 0, 'attributes.status', 'attr_type', '7'),
            (9, 'data', 0, 'relationships.route', 'rel_missing', NULL),
            (10, 'data', 0, 'relationships.route.data.id', 'rel_id_type', '23'),
            (11, 'data', 0, 'relationships.route', 'rel_missing', NULL),
            (12, 'data', 0, 'relationships.trip', 'rel_missing', NULL),
            (13, 'data', 0, 'type', 'resource_type', '''prediction-v2'''),
            (14, 'data', 0, 'id', 'top_level', NULL),
            (15, 'data', 0, 'attributes', 'top_level', NULL),
            (15, 'data', 1, 'attributes.direction_id', 'attr_missing', NULL),
            (16, 'included', 0, 'attributes.service_date', 'attr_type', '''20240101'''),
            (17, 'included', 0, 'attributes', 'top_level', NULL)
        ) AS rule(k, section, seq, path, clause, value) USING (k)""",
    "sch": """
        SELECT * FROM (
            SELECT polled_at, batch, 'sch' || (event_id // 2) AS schedule_id,
                   CASE WHEN user_id % 21 <> 0 THEN make_timestamp((at_s + 60 * (event_id % 2)) * 1000000) END AS arrival,
                   CASE WHEN event_id % 7 = 0 THEN CAST(make_timestamp(at_s * 1000000) AS DATE) END AS own_date,
                   row_number() OVER (PARTITION BY polled_at, batch, event_id // 2 ORDER BY page_no DESC, pos DESC) AS rn
            FROM vev) WHERE rn = 1""",
    "prd": """
        SELECT *, CASE WHEN user_id % 20 <> 0
                       THEN CASE WHEN event_id % 13 = 0 THEN 'gone' || event_id ELSE 'sch' || (event_id // 2) END END AS schedule_id
        FROM vev WHERE NOT (event_type = 'signup' AND event_id % 5 = 0)""",
    "mp": f"""
        SELECT CASE WHEN user_id % 50 <> 7 THEN 'r' || (user_id % 13) END AS route_id,
               CAST(user_id % 2 AS INTEGER) AS direction_id, 's' || (user_id % 5) AS stop_id, 't' || user_id AS trip_id,
               CASE WHEN user_id % 4 <> 0 THEN 'v' || (user_id % 50) END AS vehicle_id,
               coalesce(own_date, CAST({ny('p.polled_at')} AS DATE)) AS service_date, arrival AS scheduled_arrival,
               CASE WHEN event_type <> 'signup' THEN make_timestamp((at_s + wait) * 1000000) END AS predicted_arrival,
               CAST(NULL AS VARCHAR) AS status, p.polled_at, p.batch, page_no, CAST(pos AS INTEGER) AS pos
        FROM prd p LEFT JOIN sch s ON s.polled_at = p.polled_at AND s.batch = p.batch AND s.schedule_id = p.schedule_id
        WHERE NOT EXISTS (SELECT 1 FROM fb WHERE fb.polled_at = p.polled_at AND fb.batch = p.batch)""",
    "fs": f"""
        SELECT {SNAPSHOT} FROM (
            SELECT *, row_number() OVER (PARTITION BY trip_id, stop_id, polled_at ORDER BY batch, page_no, pos) AS rn
            FROM mp WHERE route_id IS NOT NULL) WHERE rn = 1""",
    "err": f"""
        SELECT polled_at, string_agg(line, '; ' ORDER BY batch, rank, page_no, section, idx, seq) AS error
        FROM (SELECT polled_at, batch, 0 AS rank, 0 AS page_no, '' AS section, 0 AS idx, 0 AS seq,
                     'batch ' || batch || ' hit 5-page cap; data truncated' AS line
              FROM (SELECT polled_at, batch, max(page_no) AS last, arg_max(more, page_no) AS more FROM pg GROUP BY ALL) pg
              WHERE last >= 5 AND more AND NOT EXISTS (SELECT 1 FROM fb WHERE fb.polled_at = pg.polled_at AND fb.batch = pg.batch)
              UNION ALL
              SELECT polled_at, batch, 1, page_no, section, idx, seq,
                     'batch ' || batch || ' contract violation: page ' || page_no || ': ' || section || '[' || idx || ']' ||
                     CASE WHEN section = 'included' THEN '(schedule)' ELSE '' END ||
                     CASE clause
                          WHEN 'top_level' THEN ': missing required top-level field ''' || path || ''''
                          WHEN 'resource_type' THEN '.type: ' || value || ', expected ''prediction'''
                          WHEN 'attr_missing' THEN '.' || path || ': missing (required by contract)'
                          WHEN 'rel_missing' THEN '.' || path || ': missing (required by contract)'
                          WHEN 'attr_null' THEN '.' || path || ': null, but contract marks this field non-nullable'
                          WHEN 'attr_type' THEN '.' || path || ': value ' || value || ' does not match contract type ''' ||
                               CASE path WHEN 'attributes.direction_id' THEN 'int' WHEN 'attributes.arrival_time' THEN 'string_datetime'
                                         WHEN 'attributes.status' THEN 'string' ELSE 'string_date' END || ''''
                          WHEN 'attr_allowed' THEN '.' || path || ': value ' || value || ' not in allowed values [0, 1]'
                          ELSE '.' || path || ': not a string (' || value || ')' END
              FROM pv WHERE NOT EXISTS (SELECT 1 FROM fb WHERE fb.polled_at = pv.polled_at AND fb.batch = pv.batch)
              UNION ALL
              SELECT polled_at, batch, 2, 0, '', 0, 0, 'batch ' || batch || ' failed: page ' || page_no || ' is not JSON' FROM fb)
        GROUP BY 1""",
    "cs": """
        SELECT p.polled_at, batches_ok, 3 AS batches_total, pages_fetched, CAST(coalesce(rows, 0) AS INTEGER) AS rows,
               CAST(coalesce(inserted, 0) AS INTEGER) AS inserted, CAST(coalesce(skipped, 0) AS INTEGER) AS skipped, error
        FROM (SELECT polled_at, CAST(count(*) FILTER (WHERE ok) AS INTEGER) AS batches_ok,
                     CAST(coalesce(sum(pages) FILTER (WHERE ok), 0) AS INTEGER) AS pages_fetched
              FROM (SELECT polled_at, batch, bool_and(readable) AS ok, count(*) AS pages FROM pg GROUP BY ALL) GROUP BY 1) p
        LEFT JOIN (SELECT polled_at, count(*) FILTER (WHERE route_id IS NOT NULL) AS rows,
                          count(*) FILTER (WHERE route_id IS NULL) AS skipped FROM mp GROUP BY 1) m USING (polled_at)
        LEFT JOIN (SELECT polled_at, count(*) AS inserted FROM fs GROUP BY 1) f USING (polled_at)
        LEFT JOIN err USING (polled_at)""",
}
def _needs(text: str) -> list[str]:
    return [name for name in CTES if re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text)]


def check(body: str) -> str:
    """The body with every common table expression it uses, directly or through others."""
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in _needs(text):
            if name not in wanted:
                visit(CTES[name])
                if name not in wanted:
                    wanted.append(name)

    visit(body)
    if not wanted:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in wanted) + "\n" + body.strip()
