"""The feature build: compute, upsert, gate, record."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.config import LABEL_KEY
from stopline.functions import timecols as tc
from stopline.operators import features as feat
from stopline.operators import gates, status
from stopline.operators import labels as lab
from stopline.sources import tables as tb


def build_features(
    labels: DataFrame,
    features_path: str,
    records_path: str,
    since: datetime | None = None,
    until: datetime | None = None,
    git_sha: str | None = None,
) -> DataFrame:
    """Run one build and record it; stored rows of labels excluded later are left in place."""
    started = datetime.now(timezone.utc)
    since, until = tc.as_utc(since), tc.as_utc(until)
    spark = labels.sparkSession
    low, high = (None if v is None else F.lit(v).cast("timestamp") for v in (since, until))
    with tb.scratch(spark):
        training = lab.training_labels(labels)
        rows = feat.build(training, low, high).withColumn("built_at", F.lit(started).cast("timestamp"))
        written = tb.upsert(rows, features_path, LABEL_KEY, "service_date_norm")
        stored = feat.written_in_window(tb.read(spark, features_path), training, low, high)
        summary = gates.side_by_side(
            feat.candidates(training, low, high).withColumnRenamed("candidate_rows", "groups_considered"),
            written.agg(F.count(F.lit(1)).alias("rows_written")),
            gates.feature_gates(stored).select("gate_results"),
        )
        record = tb.stage(
            status.transform_record("build_features", summary, started, since, until or started, started, git_sha), "record"
        )
        tb.append(record, records_path)
    return tb.read(spark, records_path).filter(F.col("started_at") == F.lit(started).cast("timestamp"))
