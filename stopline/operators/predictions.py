"""Valid pages to snapshot rows, and the ledger row each polling cycle leaves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.config import MAX_PAGES_PER_BATCH, REQUIRED_FIELDS
from stopline.functions import timecols as tc
from stopline.operators import contract as ct
from stopline.sources import pages as pg

SCOPE = ["polled_at", "batch"]
ORDER = ["page_no", "pos"]
SNAPSHOT_COLUMNS = [
    "route_id",
    "direction_id",
    "stop_id",
    "trip_id",
    "vehicle_id",
    "service_date",
    "scheduled_arrival",
    "predicted_arrival",
    "status",
    "polled_at",
]


def _text(path: str) -> Column:
    return F.try_variant_get("item", path, "string")


def relationship_id(name: str) -> Column:
    return _text(f"$.relationships.{name}.data.id")


def fields(checked: DataFrame) -> DataFrame:
    """Checked resources with the fields that rows are built from, read out of the variant once."""
    return checked.select(
        *pg.PAGE_KEY,
        "readable",
        "more",
        "section",
        "pos",
        "kind",
        "found",
        _text("$.id").alias("id"),
        _text("$.attributes.arrival_time").alias("arrival_time"),
        _text("$.attributes.departure_time").alias("departure_time"),
        _text("$.attributes.service_date").alias("own_date"),
        _text("$.attributes.status").alias("status"),
        F.try_variant_get("item", "$.attributes.direction_id", "int").alias("direction_id"),
        *[relationship_id(r).alias(f"{r}_id") for r in ("schedule", "route", "stop", "trip", "vehicle")],
    )


def read_resources(pages: DataFrame, contract: dict = ct.CONTRACT) -> DataFrame:
    """Pages to checked, flat resource rows: one parse, one pass, no shuffle."""
    return fields(ct.check(pg.resources(pages), contract))


def schedules(valid: DataFrame) -> DataFrame:
    """One schedule per (cycle, batch, id): the last one wins, in page then position order."""
    rows = valid.filter((F.col("section") == "included") & (F.col("kind") == "schedule"))
    return rows.groupBy(*SCOPE, F.col("id").alias("schedule_id")).agg(
        F.max_by(F.struct("arrival_time", F.col("own_date").alias("service_date")), F.struct(*ORDER)).alias("schedule")
    )


def predictions(valid: DataFrame) -> DataFrame:
    """The predictions among the resources of valid pages."""
    return valid.filter(F.col("section") == "data")


def has_time(predicted: DataFrame) -> DataFrame:
    """Drop predictions with neither arrival nor departure (cancelled trips)."""
    return predicted.filter(F.coalesce("arrival_time", "departure_time").isNotNull())


def with_schedule(predicted: DataFrame, scheduled: DataFrame) -> DataFrame:
    """Left join to the schedule of the same cycle and batch; added trips have none."""
    return predicted.join(scheduled, [*SCOPE, "schedule_id"], "left")


def service_date(scheduled_date: Column, polled_at: Column) -> Column:
    """The schedule's own date if it has one, else the feed-local date of the poll."""
    return F.coalesce(F.try_to_date(F.nullif(scheduled_date, F.lit(""))), tc.local_date(polled_at))


def _unreadable(text: Column, value: Column) -> Column:
    return F.coalesce(text != "", F.lit(False)) & value.isNull()


def map_predictions(valid: DataFrame) -> DataFrame:
    """Snapshot rows with their page order, and ``unreadable`` where a time or date is not one.

    Direction comes from the prediction; arrivals are read from arrival times only, so an origin
    stop keeps its row with null arrivals."""
    rows = with_schedule(has_time(predictions(valid)), schedules(valid))
    planned, own_date = F.col("schedule.arrival_time"), F.col("schedule.service_date")
    predicted_at, scheduled_at = tc.parse_iso(F.col("arrival_time")), tc.parse_iso(planned)
    return rows.select(
        "route_id",
        "direction_id",
        "stop_id",
        "trip_id",
        "vehicle_id",
        service_date(own_date, F.col("polled_at")).alias("service_date"),
        scheduled_at.alias("scheduled_arrival"),
        predicted_at.alias("predicted_arrival"),
        "status",
        "polled_at",
        "batch",
        *ORDER,
        (
            _unreadable(F.col("arrival_time"), predicted_at)
            | _unreadable(planned, scheduled_at)
            | _unreadable(own_date, F.try_to_date(own_date))
        ).alias("unreadable"),
    )


def complete() -> Column:
    """All fields a snapshot must have are known."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUIRED_FIELDS])


def prefilter(rows: DataFrame) -> DataFrame:
    return rows.filter(complete())


def failed_batches(page_rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """Batches that cannot be read at all: a page that is not JSON, or a time that is not one.

    Such a batch contributes nothing and is named in the ledger; other batches go on."""
    broken = page_rows.filter(~F.col("readable")).select(
        *SCOPE, "page_no", F.lit(-1).alias("pos"), F.format_string("page %d is not JSON", F.col("page_no")).alias("why")
    )
    garbled = mapped.filter("unreadable").select(
        *SCOPE, *ORDER, F.format_string("page %d holds an unreadable time", F.col("page_no")).alias("why")
    )
    return broken.unionByName(garbled).groupBy(*SCOPE).agg(F.min_by("why", F.struct(*ORDER)).alias("why"))


def accepted(mapped: DataFrame, failed: DataFrame) -> DataFrame:
    """Mapped rows of the batches that could be read."""
    return mapped.join(failed.select(*SCOPE), SCOPE, "left_anti")


SEGMENT_LINES = 100
SEGMENT_PLACE = ["batch", "rank", "page_no", "section", "segment"]


def _lines(rows: DataFrame, rank: int, text: Column, *place: str) -> DataFrame:
    """Ledger lines with a common order: batch, kind of line, place in the pages."""
    known = {"page_no": F.lit(0), "section": F.lit(""), "idx": F.lit(0), "seq": F.lit(0)}
    known.update({c: F.col(c) for c in place})
    order = F.struct("batch", F.lit(rank).alias("rank"), *[v.alias(k) for k, v in known.items()])
    return rows.select(*SCOPE, order.alias("place"), F.concat(F.format_string("batch %d ", "batch"), text).alias("text"))


def cycle_errors(page_rows: DataFrame, found: DataFrame, failed: DataFrame, max_pages: int = MAX_PAGES_PER_BATCH) -> DataFrame:
    """Ledger error text per cycle: per batch the page cap, then violations in page order, or the
    reason the batch failed. A cycle without errors has no row."""
    capped = _lines(
        pg.batch_pages(page_rows, max_pages).filter("truncated"), 0, F.lit(f"hit {max_pages}-page cap; data truncated")
    )
    broken = _lines(
        found, 1, F.concat(F.lit("contract violation: "), ct.message()), "page_no", "section", "idx", "seq"
    )
    alive = capped.unionByName(broken).join(failed.select(*SCOPE), SCOPE, "left_anti")
    dead = _lines(failed, 2, F.concat(F.lit("failed: "), F.col("why")))
    # The text is one ledger cell by definition. It is put together in segments: lines of a page by the
    # hundred, then the segments of a cycle, so that no list holds all lines of a cycle.
    lines = alive.unionByName(dead).select("polled_at", "place.*", "text")
    lines = lines.withColumn("segment", F.floor(F.col("idx") / SEGMENT_LINES))
    within = F.array_sort(F.collect_list(F.struct("idx", "seq", "text")))
    joined = lambda parts: F.array_join(F.transform(parts, lambda e: e["text"]), "; ")
    segments = lines.groupBy("polled_at", *SEGMENT_PLACE).agg(joined(within).alias("text"))
    across = F.array_sort(F.collect_list(F.struct(*SEGMENT_PLACE, "text")))
    return segments.groupBy("polled_at").agg(joined(across).alias("error"))


def cycle_summary(
    page_rows: DataFrame,
    found: DataFrame,
    failed: DataFrame,
    mapped: DataFrame,
    inserted: DataFrame,
    batches_total: int,
    max_pages: int = MAX_PAGES_PER_BATCH,
) -> DataFrame:
    """One ledger row per cycle, errors and all.

    ``mapped`` holds the accepted rows, ``inserted`` the number of new rows per polled_at."""
    ok = F.col("failed").isNull()
    pages = (
        pg.batch_pages(page_rows, max_pages)
        .join(failed.select(*SCOPE, F.lit(True).alias("failed")), SCOPE, "left")
        .groupBy("polled_at")
        .agg(
            F.count_if(ok).cast("int").alias("batches_ok"),
            F.coalesce(F.sum(F.when(ok, F.col("pages"))), F.lit(0)).cast("int").alias("pages_fetched"),
        )
    )
    rows = mapped.groupBy("polled_at").agg(F.count_if(complete()).alias("rows"), F.count_if(~complete()).alias("skipped"))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
    return (
        pages.join(rows, "polled_at", "left")
        .join(inserted, "polled_at", "left")
        .join(cycle_errors(page_rows, found, failed, max_pages), "polled_at", "left")
        .select(
            "polled_at",
            "batches_ok",
            F.lit(batches_total).alias("batches_total"),
            "pages_fetched",
            count("rows"),
            count("inserted"),
            count("skipped"),
            "error",
        )
    )
