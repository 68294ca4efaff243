"""One ingestion run: pages to snapshots and ledger rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.config import MAX_PAGES_PER_BATCH, STOP_EVENT_KEY
from stopline.functions import timecols as tc
from stopline.operators import contract as ct
from stopline.operators import predictions as pr
from stopline.sources import pages as pg
from stopline.sources import tables as tb
from stopline.sources.versioned import Table


@dataclass
class Reading:
    """What a set of pages holds, all derived from one parse."""

    page_rows: DataFrame
    found: DataFrame
    valid: DataFrame
    failed: DataFrame
    mapped: DataFrame

    @property
    def snapshots(self) -> DataFrame:
        return pr.prefilter(self.mapped)


def read(resources: DataFrame) -> Reading:
    """Checked resources (:func:`predictions.read_resources`) to everything ingestion needs."""
    page_rows = pg.page_rows(resources)
    valid = ct.on_valid_pages(resources)
    raw = pr.map_predictions(valid)
    failed = pr.failed_batches(page_rows, raw)
    return Reading(page_rows, ct.violations(resources), valid, failed, pr.accepted(raw, failed))


def first_sightings(snapshots: DataFrame) -> DataFrame:
    """One row per snapshot key; overlapping pages repeat rows and the first one counts."""
    order = [F.col("batch"), F.col("page_no"), F.col("pos")]
    return tb.first_per_key(snapshots, STOP_EVENT_KEY, order).select(*pr.SNAPSHOT_COLUMNS)


def ingest(
    pages: DataFrame,
    events_path: str,
    runs_path: str,
    batches_total: int,
    contract: dict = ct.CONTRACT,
    max_pages: int = MAX_PAGES_PER_BATCH,
    refresh_ledger: bool = False,
) -> int:
    """Validate, quarantine, map and store pages; every cycle leaves a ledger row.

    The flat resources are staged, so JSON is parsed once. Safe to repeat after a crash at any step:
    snapshots are stored once, and a cycle's ledger row counts all its stored snapshots, also those
    that a broken run had stored before. A cycle that has a ledger row keeps it; with
    ``refresh_ledger`` the row is replaced, for callers that see a cycle in several pieces. The ledger
    is a log: only this run's rows are written."""
    spark = pages.sparkSession
    with tb.scratch(spark):
        reading = read(tb.stage(pr.read_resources(pages, contract), "resources"))
        mapped = tb.stage(reading.mapped, "mapped")
        batch = tb.with_month(first_sightings(pr.prefilter(mapped)))
        fresh = Table(spark, events_path, tb.MONTH).insert_absent(batch, STOP_EVENT_KEY)
        cycles = reading.page_rows.select("polled_at").distinct().withColumn(tb.MONTH, tc.month_of(F.col("polled_at")))
        stored = tb.read(spark, events_path).join(F.broadcast(cycles), ["polled_at", tb.MONTH], "left_semi")
        inserted = stored.groupBy("polled_at").agg(F.count(F.lit(1)).alias("inserted"))
        summary = pr.cycle_summary(
            reading.page_rows, reading.found, reading.failed, mapped, inserted, batches_total, max_pages
        )
        # Landed pages carry one time per cycle, so a rerun writes the same ledger row.
        ledger_rows = summary.withColumns({"started_at": F.col("polled_at"), "finished_at": F.col("polled_at")})
        tb.log_rows(ledger_rows, runs_path, ["polled_at"], "polled_at", replace=refresh_ledger)
        return fresh
