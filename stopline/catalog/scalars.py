"""Queries on the column functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopline.catalog.registry import query
from stopline.catalog.sql import check, ny_dow, ny_hour, seconds, service_day
from stopline.functions import numeric as num
from stopline.functions import text
from stopline.functions import timecols as tc
from stopline.sources import derived as d


def _events(name, column, expression, sql):
    def build(spark, sf):
        return d.table(spark, sf, "events").select("event_id", expression().alias(column))

    query(name, check(f"SELECT event_id, {sql} AS {column} FROM events"))(build)


_events("service_date_norm", "service_date_norm", lambda: tc.service_date_norm(F.col("ts")), service_day("ts"))
_events("local_hour", "local_hour", lambda: tc.local_hour(F.col("ts")), ny_hour("ts"))
_events("local_dow", "local_dow", lambda: tc.local_dow(F.col("ts")), ny_dow("ts"))
_events("iso_utc", "iso", lambda: tc.iso_utc(F.col("ts")), "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')")
_events("truncate_minute", "minute", lambda: tc.truncate_minute(F.col("ts")), "date_trunc('minute', ts)")
_events(
    "round_delay", "seconds", lambda: tc.whole_seconds(F.col("value") * 50 * 1_000_000), "CAST(round_even(value * 50 * 1000000 / 1e6, 0) AS INTEGER)"
)
_events(
    "int_headway", "seconds", lambda: tc.int_seconds(F.col("value") * 50 * 1_000_000), "CAST(round(value * 50 * 1000000 / 1e6) AS INTEGER)"
)


def _iso_text():
    """ISO text in three shapes: an offset, a trailing Z, and none (read as UTC)."""
    plain = "yyyy-MM-dd'T'HH:mm:ss"
    local = F.date_format(F.col("ts") - F.expr("INTERVAL 5 HOURS"), plain)
    utc = F.date_format("ts", plain)
    shape = F.col("event_id") % 4
    return (
        F.when(shape == 0, F.concat(local, F.lit("-05:00")))
        .when(shape == 1, F.concat(utc, F.lit("Z")))
        .when(shape == 2, utc)
        .otherwise("")
    )


_events(
    "parse_iso", "parsed", lambda: tc.parse_iso(_iso_text()), "CASE WHEN event_id % 4 < 3 THEN date_trunc('second', ts) END"
)


@query(
    "epoch_seconds",
    check(f"SELECT trip_id, stop_id, polled_at, {seconds('polled_at', 'predicted_arrival')} AS elapsed FROM se"),
)
def _(spark, sf):
    rows = d.stop_events(spark, sf)
    return rows.select(
        "trip_id", "stop_id", "polled_at", tc.epoch_seconds(F.col("polled_at"), F.col("predicted_arrival")).alias("elapsed")
    )


def _any(words):
    return "(" + " OR ".join(f"contains(low, '{w}')" for w in words) + ")"


REASONS = f"""
SELECT source, id, c || CASE WHEN c <> 'warehouse unreachable' AND total <> 0 AND ok < total
                             THEN ' (' || (total - ok) || ' of ' || total || ' batches)' ELSE '' END AS reason
FROM (SELECT *, CASE WHEN {_any(text.UNREACHABLE_MARKERS)} THEN 'upstream unreachable'
                     WHEN {_any(text.RATE_LIMIT_MARKERS)} THEN 'rate limited by the upstream API'
                     WHEN regexp_matches(raw, '\\b5[0-9][0-9]\\b') AND {_any(text.SERVER_ERROR_WORDS)} THEN 'upstream server error'
                     WHEN {_any(text.WAREHOUSE_MARKERS)} THEN 'warehouse unreachable' ELSE 'poll failed' END AS c
      FROM (SELECT 'ledger' AS source, CAST(epoch_us(polled_at) AS BIGINT) AS id, error AS raw, lower(error) AS low, batches_ok AS ok, batches_total AS total
            FROM pr WHERE error IS NOT NULL
            UNION ALL
            SELECT 'documents', doc_id, text, lower(text), doc_id % 4, 3 FROM documents WHERE text IS NOT NULL
            UNION ALL
            SELECT 'pages', page_id, html, lower(html), page_id % 4, 3 FROM pages WHERE html IS NOT NULL))"""


@query("classify_reason", check(REASONS))
def _(spark, sf):
    """Reasons of the ledger's errors, and of whole documents and raw pages, which hold every kind of marker."""
    runs = d.poll_runs(spark, sf).select(
        F.lit("ledger").alias("source"), F.unix_micros("polled_at").alias("id"), "error", F.col("batches_ok").cast("long").alias("ok"), F.col("batches_total").cast("long").alias("total")
    )
    of = lambda name, key, column: d.table(spark, sf, name).select(
        F.lit(name).alias("source"), F.col(key).cast("long").alias("id"), F.col(column).alias("error"), (F.col(key) % 4).cast("long").alias("ok"), F.lit(3).cast("long").alias("total")
    )
    rows = runs.unionByName(of("documents", "doc_id", "text")).unionByName(of("pages", "page_id", "html"))
    reason = text.classify_reason(F.col("error"), F.col("ok"), F.col("total"))
    return rows.filter(F.col("error").isNotNull()).select("source", "id", reason.alias("reason"))


@query(
    "truncate_text",
    check(
        "SELECT doc_id, CASE WHEN length(text) <= 200 THEN text ELSE substring(text, 1, 185) || '... [truncated]' END AS short FROM documents"
    ),
)
def _(spark, sf):
    return d.table(spark, sf, "documents").select("doc_id", text.truncate_text(F.col("text"), 200).alias("short"))


@query(
    "null_pct",
    check(
        """
SELECT event_type, printf('%.2f%%', CAST(100.0 * count(*) FILTER (WHERE value > 200) / count(*) AS DOUBLE)) AS high, 'n/a' AS of_none
FROM events GROUP BY 1"""
    ),
)
def _(spark, sf):
    rows = d.table(spark, sf, "events").groupBy("event_type")
    return rows.agg(
        num.pct_text(F.count_if(F.col("value") > 200), F.count(F.lit(1))).alias("high"),
        num.pct_text(F.count(F.lit(1)), F.count_if(F.col("event_type").isNull())).alias("of_none"),
    )
