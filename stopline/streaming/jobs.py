"""Structured Streaming jobs over landed files.

Every job works in ``foreachBatch`` with idempotent sinks, so a replayed micro-batch changes
nothing and late rows are never dropped by a watermark: they touch their cycle or group again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stopline.config import LABEL_KEY, STOP_EVENT_KEY, LabelRules
from stopline.functions import timecols as tc
from stopline.operators import ledger
from stopline.operators import labels as lab
from stopline.plans import ingest
from stopline.session import prepare, work_path
from stopline.sources import pages as pg
from stopline.sources import tables as tb
from stopline.sources import versioned

DAY = "service_date_norm"
GROUP_KEY = ["trip_id", "stop_id", DAY]


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int) -> DataFrame:
    """A stream over Parquet files as they land."""
    reader = prepare(spark).readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def run_available(stream: DataFrame, handle, checkpoint: str) -> None:
    """Work off everything that has landed, in as many micro-batches as it takes, then stop."""
    query = start(stream, handle, checkpoint, trigger={"availableNow": True})
    query.awaitTermination()


def start(stream: DataFrame, handle, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


@dataclass
class IngestJob:
    """Pages in, snapshots and ledger rows out.

    A cycle's pages may arrive in several micro-batches. Each touched cycle is therefore read again
    whole from the landing folder, which is laid out by day so that only its days are read."""

    landing: str
    events_path: str
    runs_path: str
    batches_total: int

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = tb.stage(batch.select("polled_day", "polled_at").distinct(), "cycles")
        # One value per day in the micro-batch, which maxFilesPerTrigger bounds.
        days = [r[0] for r in touched.select("polled_day").distinct().collect()]
        if not days:
            return
        landed = spark.read.schema(batch.schema).parquet(self.landing).filter(F.col("polled_day").isin(days))
        pages = landed.join(touched.select("polled_at"), "polled_at", "left_semi").select(*pg.PAGE_SCHEMA.names)
        ingest.ingest(pages, self.events_path, self.runs_path, self.batches_total, refresh_ledger=True)


def land_pages(pages: DataFrame, landing: str, target: int = versioned.TARGET_BYTES) -> T.StructType:
    """Land pages as Parquet, by day, in files of about ``target`` bytes; returns the schema of the folder."""
    daily = pages.withColumn("polled_day", F.to_date("polled_at"))
    versioned.sized(daily, "polled_day", None, target, landing)
    return daily.schema


@dataclass
class DedupJob:
    """Snapshots in, each (trip, stop, poll) stored once over the table's whole history."""

    events_path: str

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        tb.insert_absent(tb.with_month(batch), self.events_path, STOP_EVENT_KEY, tb.MONTH)


def drop_repeats(stream: DataFrame, delay: str) -> DataFrame:
    """Cheaper dedup for feeds that are never later than ``delay``: state instead of a table read.

    Rows later than the watermark are dropped by Spark, so :class:`DedupJob` is the safe choice."""
    return stream.withWatermark("polled_at", delay).dropDuplicatesWithinWatermark(STOP_EVENT_KEY)


SIGHTING, RUN = "sighting", "run"


def tagged(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Snapshots and ledger rows as one stream (or table): each row holds one of the two."""
    a = rows.select(F.struct("*").alias(SIGHTING), F.lit(None).cast(runs.schema).alias(RUN))
    b = runs.select(F.lit(None).cast(rows.schema).alias(SIGHTING), F.struct("*").alias(RUN))
    return a.unionByName(b)


@dataclass
class SettleJob:
    """Snapshots and ledger rows in, labels out: a group is closed once quiet, reopened by later sightings.

    The ledger moves the clock, also by cycles that stored nothing. Snapshots are stored by service
    day, which is part of the group key, so a touched group's full history lies in the partitions of
    the touched days; a snapshot key that came under another day before is not stored again. Touched
    are groups that were sighted, that were not settled yet, or whose settle window a new ledger row
    can change: late cycles may close or open a gap beside labels that are stored already."""

    runs_path: str
    events_path: str
    labels_path: str
    state_path: str
    rules: LabelRules

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        parts = [batch.filter(F.col(k).isNotNull()).select(f"{k}.*") for k in (SIGHTING, RUN)]
        self.settle(*parts, batch_id)

    def settle(self, sightings: DataFrame, runs: DataFrame, batch_id: int) -> None:
        with tb.scratch(sightings.sparkSession):
            self._settle(sightings, tb.stage(runs, "runs"), batch_id)

    def _settle(self, sightings: DataFrame, runs: DataFrame, batch_id: int) -> None:
        spark = sightings.sparkSession
        if not runs.isEmpty():
            tb.log_rows(runs, self.runs_path, ["polled_at"], "polled_at", replace=True)
        day = tc.service_date_norm(F.coalesce("scheduled_arrival", "polled_at"))
        rows = tb.stage(sightings.withColumn(DAY, day), "sightings")
        tb.insert_absent(rows, self.events_path, STOP_EVENT_KEY, DAY, clock="polled_at")
        cycles = tb.read(spark, self.runs_path)
        as_of = None if cycles is None else cycles.agg(F.max("polled_at")).first()[0]
        keys = [rows.select(*GROUP_KEY), tb.read_or_none(spark, self._pending(batch_id - 1)), self._beside(cycles, runs)]
        keys = tb.stage(reduce(DataFrame.unionByName, [k for k in keys if k is not None]).distinct(), "touched")
        days = [r[0] for r in keys.select(DAY).distinct().collect()]  # one value per service day
        history = tb.read(spark, self.events_path).filter(F.col(DAY).isin(days))
        groups = tb.stage(lab.trip_stop_groups(history.join(keys, GROUP_KEY, "left_semi")).drop("touched"), "groups")
        if as_of is None:  # no cycle is known yet, so nothing is settled
            groups.select(*GROUP_KEY).write.mode("overwrite").parquet(self._pending(batch_id))
            return
        moment = F.lit(as_of)
        gaps = ledger.gap_intervals(cycles, self.rules.gap_threshold_seconds)
        tb.upsert(lab.close_labels(groups, gaps, moment, self.rules), self.labels_path, LABEL_KEY, DAY)
        quiet = tc.micros_between(F.col("observed_span_end"), moment)
        still = groups.filter(quiet <= int(self.rules.settle_margin_seconds * tc.MICROS))
        still.select(*GROUP_KEY).write.mode("overwrite").parquet(self._pending(batch_id))

    def _pending(self, batch_id: int) -> str:
        """Groups that the micro-batch left open, or whose window ended at its latest cycle."""
        return f"{self.state_path}/pending/{batch_id}"

    def _beside(self, cycles: DataFrame | None, runs: DataFrame) -> DataFrame | None:
        """Stored labels whose settle window reaches the gaps around the new ledger rows: between the
        cycle before the first of them, less the margin, and the cycle after the last."""
        labels = tb.read(runs.sparkSession, self.labels_path)
        first, last = runs.agg(F.min("polled_at"), F.max("polled_at")).first()
        if labels is None or first is None:
            return None
        before, after = cycles.agg(
            F.max(F.when(F.col("polled_at") < F.lit(first), F.col("polled_at"))),
            F.min(F.when(F.col("polled_at") > F.lit(last), F.col("polled_at"))),
        ).first()
        low = tc.plus_seconds(F.lit(before or first), -self.rules.settle_margin_seconds)
        return labels.filter(F.col("observed_span_end").between(low, F.lit(after or last))).select(*GROUP_KEY)


def work_off_settling(sightings: DataFrame, runs: DataFrame, parts: list, job: SettleJob) -> None:
    """Land both sources part by part and work off each landing as one stream of the two.

    ``parts`` are conditions on polled_at that together cover all rows."""
    spark = sightings.sparkSession
    folders, checkpoint = [work_path(spark, n) for n in ("sightings", "runs")], work_path(spark, "checkpoint")
    for part in parts:
        for rows, folder in zip((sightings, runs), folders):
            rows.filter(part).write.mode("append").parquet(folder)
        streams = [file_stream(spark, f, r.schema, 1000) for r, f in zip((sightings, runs), folders)]
        run_available(tagged(*streams), job.handle, checkpoint)


def work_off(rows: DataFrame, parts: list, handle) -> None:
    """Land the rows part by part in the shared folder and work off each landing as it arrives.

    ``parts`` are conditions that together cover all rows."""
    spark = rows.sparkSession
    landing, checkpoint = work_path(spark, "landing"), work_path(spark, "checkpoint")
    for part in parts:
        rows.filter(part).write.mode("append").parquet(landing)
        run_available(file_stream(spark, landing, rows.schema, 1000), handle, checkpoint)
