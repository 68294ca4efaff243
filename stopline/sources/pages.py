"""Prediction pages as records: one row per landed JSON page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.config import MAX_PAGES_PER_BATCH

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("polled_at", T.TimestampType(), False),
        T.StructField("batch", T.IntegerType(), False),
        T.StructField("page_no", T.IntegerType(), False),
        T.StructField("body", T.StringType()),
    ]
)
PAGE_KEY = ["polled_at", "batch", "page_no"]

# Landed files sit in a folder tree polled=<epoch seconds>/batch=<n>/page_no=<n>/, one page each.
LANDED = "value string, polled long, batch int, page_no int"


def read_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """Landed page files, each read whole as one record."""
    return spark.read.schema(LANDED).text(folder, wholetext=True).select(
        F.timestamp_seconds("polled").alias("polled_at"), "batch", "page_no", F.col("value").alias("body")
    )


def land_page_lines(pages: DataFrame, folder: str) -> None:
    """Write page records as JSON lines: many pages per file, which large archives need."""
    pages.write.mode("append").json(folder)


def read_page_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).json(folder)


def parsed(pages: DataFrame) -> DataFrame:
    """Pages with their body as a variant, which keeps a missing field apart from a JSON null.

    ``readable`` is false where the body is not JSON; ``more`` says that a next page was named."""
    docs = pages.withColumn("doc", F.try_parse_json("body"))
    return docs.select(
        *PAGE_KEY,
        "doc",
        F.col("doc").isNotNull().alias("readable"),
        F.coalesce(F.try_variant_get("doc", "$.links.next", "string") != "", F.lit(False)).alias("more"),
    )


def _placed(section: str):
    """A section's elements, each with the section's name and its position in the page."""
    items = F.coalesce(F.try_variant_get("doc", f"$.{section}", "array<variant>"), F.array().cast("array<variant>"))
    return F.transform(
        items, lambda item, pos: F.struct(F.lit(section).alias("section"), pos.alias("pos"), item.alias("item"))
    )


def resources(pages: DataFrame) -> DataFrame:
    """One row per element of ``data`` and ``included`` of every page; the page is parsed once.

    Pages are not merged: (page_no, section, pos) carries the merged order, repeats are kept, and a
    page without elements keeps one row with a null section."""
    placed = F.concat(_placed("data"), _placed("included"))
    rows = parsed(pages).withColumn("placed", F.when(F.col("readable"), placed))
    return rows.select(*PAGE_KEY, "readable", "more", F.explode_outer("placed").alias("r")).select(
        *PAGE_KEY, "readable", "more", "r.section", "r.pos", "r.item"
    )


def page_rows(resources: DataFrame) -> DataFrame:
    """One row per page, from resource rows."""
    return resources.select(*PAGE_KEY, "readable", "more").distinct()


def batch_pages(page_rows: DataFrame, max_pages: int = MAX_PAGES_PER_BATCH) -> DataFrame:
    """Per batch: pages landed, and whether its last page hit the cap with more to come."""
    return page_rows.groupBy("polled_at", "batch").agg(
        F.count(F.lit(1)).alias("pages"),
        F.max("page_no").alias("last_page"),
        ((F.max("page_no") >= max_pages) & F.max_by("more", "page_no")).alias("truncated"),
    )
