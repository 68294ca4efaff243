"""Status publication: the snapshot row and the gap ledger, both or neither."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from stopline.config import MAX_SNAPSHOTS
from stopline.operators import ledger, status
from stopline.sources import tables as tb
from stopline.sources.versioned import Table


def publish(
    stop_events: DataFrame,
    runs: DataFrame,
    labels: DataFrame,
    as_of: Column,
    snapshots_path: str,
    gaps_path: str,
    keep: int = MAX_SNAPSHOTS,
) -> None:
    """Compute and write everything before either table's pointer moves, so a failure leaves the old state.

    Snapshots replace their minute and only the newest are kept; gaps replace their start time. A
    repeated call after a crash between the two pointers ends in the same state."""
    spark = stop_events.sparkSession
    with tb.scratch(spark):
        snapshot = tb.stage(status.status_snapshot(stop_events, runs, labels, as_of), "snapshot")
        gaps = tb.stage(ledger.latest_public_gaps(runs), "gaps")
        old = tb.read(spark, snapshots_path)
        if old is not None:
            kept = tb.absent_rows(old, snapshot, ["published_at"]).unionByName(snapshot)
            snapshot = tb.keep_newest(kept, "published_at", keep)
        tb.upsert(gaps, gaps_path, ["started_at"])
        Table(spark, snapshots_path).replace_all(snapshot)
        for path in (gaps_path, snapshots_path):
            Table(spark, path).vacuum()
