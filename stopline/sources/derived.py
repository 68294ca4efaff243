"""The pipeline's input tables, derived from the given star-schema and event tables.

``events`` plays the prediction feed (snapshots, ledger, pages) and ``lineitem`` joined with
``orders`` plays a closed label table. All derivations are per-row expressions plus one
deterministic dedup on the natural key; no row is dropped otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.config import LabelRules
from stopline.functions import timecols as tc
from stopline.session import prepare, shared_folder

CYCLE_SECONDS = 600
RULES = LabelRules(cycle_seconds=600.0, gap_threshold_seconds=900.0, settle_cycles=3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, its zone-less timestamps read as UTC instants."""
    df = prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    casts = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(casts) if casts else df


def text_id(prefix: str, number) -> F.Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _floor_seconds(instant, width: int):
    seconds = F.unix_seconds(instant)
    return F.timestamp_seconds(seconds - seconds % width)


def stop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows, unique on (trip, stop, poll); the lowest event id of a key is kept."""
    events = table(spark, sf_dir, "events").withColumn("polled_at", _floor_seconds(F.col("ts"), CYCLE_SECONDS))
    first = events.groupBy("user_id", "polled_at").agg(
        F.min(F.struct("event_id", "event_type", "value")).alias("e")
    )
    user = F.col("user_id")
    polled = F.unix_seconds("polled_at")
    scheduled = F.when(
        user % 20 != 0,
        F.timestamp_seconds(polled - polled % 86400 + (user % 24) * 3600 + (user % 60) * 60),
    )
    predicted = F.when(
        F.col("e.event_type") != "signup",
        F.timestamp_seconds(F.unix_seconds("scheduled_arrival") + F.bround(F.col("e.value") * 6).cast("long")),
    )
    return first.withColumn("scheduled_arrival", scheduled).select(
        text_id("r", user % 13).alias("route_id"),
        (user % 2).cast("int").alias("direction_id"),
        text_id("s", user % 5).alias("stop_id"),
        text_id("t", user).alias("trip_id"),
        text_id("v", user % 50).alias("vehicle_id"),
        tc.local_date(F.col("polled_at")).alias("service_date"),
        "scheduled_arrival",
        predicted.alias("predicted_arrival"),
        F.lit(None).cast("string").alias("status"),
        "polled_at",
    )


def raw_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot keys as the feed repeats them, before any dedup."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        text_id("t", user).alias("trip_id"),
        text_id("s", user % 5).alias("stop_id"),
        _floor_seconds(F.col("ts"), CYCLE_SECONDS).alias("polled_at"),
        "event_id",
    )


def poll_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger row per polling cycle seen in ``events``."""
    events = table(spark, sf_dir, "events").withColumn("polled_at", _floor_seconds(F.col("ts"), CYCLE_SECONDS))
    failed = (F.col("event_type") == "error") & (F.col("value") > 200)
    cycles = events.groupBy("polled_at").agg(
        F.count(F.lit(1)).cast("int").alias("rows"),
        F.max(F.when(failed, text_id("HTTP 503 status ", F.col("event_id")))).alias("error"),
    )
    return cycles.select(
        "polled_at",
        F.col("polled_at").alias("started_at"),
        tc.plus_seconds(F.col("polled_at"), 2).alias("finished_at"),
        F.when(F.col("error").isNull(), 3).otherwise(2).alias("batches_ok"),
        F.lit(3).alias("batches_total"),
        F.lit(3).alias("pages_fetched"),
        "rows",
        F.col("rows").alias("inserted"),
        F.lit(0).alias("skipped"),
        "error",
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed label rows from order lines: one per (order, line), all three closing reasons."""
    # One exchange by order serves the dedup and the join.
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
        F.min(
            F.struct(
                "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_returnflag", "l_quantity"
            )
        ).alias("l")
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    order, line = F.col("l_orderkey"), F.col("l_linenumber").cast("long")
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    base = F.unix_seconds(F.lit("2026-10-10 00:00:00").cast("timestamp"))
    scheduled = F.timestamp_seconds(base + (day % 60) * 86400 + (order % 24) * 3600 + line * 420)
    silent = (F.col("l.l_returnflag") == "N") & (F.col("l_linenumber") == 1)
    rows = lines.join(orders, "l_orderkey").select(
        text_id("r", order % 13).alias("route_id"),
        (order % 2).cast("int").alias("direction_id"),
        text_id("s", line).alias("stop_id"),
        text_id("t", order).alias("trip_id"),
        scheduled.alias("scheduled_arrival"),
        F.when(~silent, (F.round(F.col("l.l_discount") * 6000) - 120).cast("int")).alias("delay_seconds"),
        F.when(silent, F.lit("no_arrival_signal"))
        .when(F.col("l.l_quantity") >= 48, F.lit("gap_abutted"))
        .alias("closed_reason"),
    )
    at = F.col("scheduled_arrival")
    # The keys are never null; saying so up front gives all consumers one shared scan and shuffle.
    keyed = rows.dropna(subset=["route_id", "direction_id", "stop_id", "trip_id", "scheduled_arrival"])
    return keyed.select(
        tc.service_date_norm(at).alias("service_date_norm"),
        "route_id",
        "direction_id",
        "stop_id",
        "trip_id",
        "scheduled_arrival",
        F.timestamp_seconds(F.unix_seconds(at) + F.col("delay_seconds")).alias("final_predicted_arrival"),
        "delay_seconds",
        (F.col("delay_seconds") > RULES.late_threshold_seconds).alias("late"),
        tc.plus_seconds(at, -600).alias("observed_span_start"),
        at.alias("observed_span_end"),
        F.lit(5).alias("n_snapshots"),
        "closed_reason",
    )


BATCHES = 3
PAGES_PER_BATCH = 5
EVENTS_PER_CYCLE = 300
FIRST_CYCLE = "2024-01-01 04:45:00"
PAGE_CADENCE_SECONDS = 66


def _stamp(seconds) -> F.Column:
    """Epoch seconds as ISO text with a -05:00 offset, quoted for JSON."""
    return F.concat(
        F.lit('"'), F.date_format(F.timestamp_seconds(seconds - 18000), "yyyy-MM-dd'T'HH:mm:ss"), F.lit('-05:00"')
    )


def _link(name: str, ident) -> F.Column:
    """A relationship entry; a null id is written as null data."""
    data = F.coalesce(F.concat(F.lit('{"id":"'), ident, F.lit(f'","type":"{name}"}}')), F.lit("null"))
    return F.concat(F.lit(f'"{name}":{{"data":'), data, F.lit("}"))


def page_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the page they are printed on.

    A cycle prints the next 300 events, so more data means more cycles and never larger ones."""
    events = table(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")
    first = F.unix_seconds(F.lit(FIRST_CYCLE).cast("timestamp"))
    cycle = F.floor(event / EVENTS_PER_CYCLE)
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        F.unix_seconds("ts").alias("at"),
        F.bround("value").cast("long").alias("wait"),
        F.timestamp_seconds(first + cycle * PAGE_CADENCE_SECONDS).alias("polled_at"),
        (user % BATCHES).cast("int").alias("batch"),
        (1 + event % PAGES_PER_BATCH).cast("int").alias("page_no"),
        (event % 499).alias("k"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction pages printed from ``events``, with one contract breach per residue of 499.

    Some pages are cut off mid-JSON, some name a next page, schedules repeat within a batch."""
    event, user, k = F.col("event_id"), F.col("user_id"), F.col("k")
    none = F.lit(None).cast("string")
    signup = F.col("event_type") == "signup"
    direction = (
        F.when(k == 1, F.lit(""))
        .when(k == 2, F.lit('"direction_id":null,'))
        .when(k == 3, F.lit('"direction_id":"0",'))
        .when(k == 4, F.lit('"direction_id":2,'))
        .when(k == 5, F.lit('"direction_id":true,'))
        .when(k == 6, F.lit('"direction_id":1.5,'))
        .otherwise(F.concat(F.lit('"direction_id":'), (user % 2).cast("string"), F.lit(",")))
    )
    arrival = F.when(k == 7, F.lit('"soon"')).when(signup, F.lit("null")).otherwise(_stamp(F.col("at") + F.col("wait")))
    departure = F.when(signup & (event % 5 == 0), F.lit("null")).otherwise(_stamp(F.col("at") + F.col("wait") + 30))
    status = F.when(k == 8, F.lit("7")).otherwise(F.lit("null"))
    attributes = F.concat(
        F.lit('"attributes":{'), direction, F.lit('"arrival_time":'), arrival, F.lit(',"departure_time":'), departure,
        F.lit(',"status":'), status, F.lit("}")
    )
    route = (
        F.when(k == 9, F.lit(""))
        .when(k == 10, F.lit('"route":{"data":{"id":23,"type":"route"}},'))
        .when(k == 11, F.lit('"route":null,'))
        .otherwise(F.concat(_link("route", F.when(user % 50 != 7, text_id("r", user % 13))), F.lit(",")))
    )
    trip = F.when(k == 12, F.lit("")).otherwise(F.concat(_link("trip", text_id("t", user)), F.lit(",")))
    schedule_id = F.when(event % 13 == 0, text_id("gone", event)).otherwise(text_id("sch", F.floor(event / 2)))
    relationships = F.concat(
        F.lit('"relationships":{'), route, trip, _link("stop", text_id("s", user % 5)), F.lit(","),
        _link("vehicle", F.when(user % 4 != 0, text_id("v", user % 50))), F.lit(","),
        _link("schedule", F.when(user % 20 != 0, schedule_id)), F.lit("}")
    )
    kind = F.when(k == 13, F.lit('"prediction-v2"')).otherwise(F.lit('"prediction"'))
    ident = F.when(k == 14, F.lit("")).otherwise(F.concat(F.lit('"id":"p'), event.cast("string"), F.lit('",')))
    prediction = F.concat(
        F.lit("{"), ident, F.lit('"type":'), kind, F.lit(","),
        F.when(k == 15, F.lit("")).otherwise(F.concat(attributes, F.lit(","))), relationships, F.lit("}")
    )
    planned = F.when(user % 21 == 0, F.lit("null")).otherwise(_stamp(F.col("at") + 60 * (event % 2)))
    date = F.when(k == 16, F.lit(',"service_date":"20240101"')).when(
        event % 7 == 0, F.concat(F.lit(',"service_date":"'), F.to_date(F.timestamp_seconds("at")).cast("string"), F.lit('"'))
    ).otherwise(F.lit(""))
    schedule = F.concat(
        F.lit('{"id":"sch'), F.floor(event / 2).cast("string"), F.lit('","type":"schedule"'),
        F.when(k == 17, F.lit("")).otherwise(F.concat(F.lit(',"attributes":{"arrival_time":'), planned, date, F.lit("}"))),
        F.lit("}")
    )
    vehicle = F.when(event % 17 == 0, F.lit(',{"id":"v","type":"vehicle"}')).otherwise(none)
    printed = page_events(spark, sf_dir).withColumns({"p": prediction, "s": schedule, "v": vehicle})
    grouped = printed.groupBy("polled_at", "batch", "page_no").agg(
        # A page holds at most a fifth of its cycle's 300 events.
        F.array_sort(F.collect_list(F.struct("event_id", "p", "s", "v"))).alias("items"),
        F.bool_or(event % 11 == 0).alias("more"),
        F.bool_or(event % 1999 == 1998).alias("cut"),
    )
    text = lambda c, sep: F.array_join(F.transform("items", lambda i: i[c]), sep)
    body = F.concat(
        F.lit('{"data":['), text("p", ","), F.lit('],"included":['), text("s", ","), text("v", ""),
        F.when(F.col("more"), F.lit('],"links":{"next":"more"}}')).otherwise(F.lit("]}"))
    )
    return grouped.select(
        "polled_at", "batch", "page_no", F.when(F.col("cut"), F.substring(body, 1, 40)).otherwise(body).alias("body")
    )


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table that several steps read, written once per application to the shared folder.

    It plays the pipeline's stored table: readers prune columns from Parquet and a lost executor
    costs a re-read instead of a rebuild."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        df = build()
        path = f"{shared_folder(spark)}/stopline/derived/{key[0]}/{abs(hash(sf_dir))}/{name}"
        df.write.mode("overwrite").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])
