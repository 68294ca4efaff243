"""Named queries and the check SQL that goes with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less UTC values, the form the given tables use."""
    casts = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under a name, with its check SQL if any."""

    def keep(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep
