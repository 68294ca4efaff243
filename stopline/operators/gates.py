"""Quality gates. Each function returns one row with a map gate -> (passed, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline import config
from stopline.functions import numeric as num
from stopline.functions import timecols as tc
from stopline.operators import ledger


def _gate(name: str, passed: Column, detail: Column) -> list[Column]:
    return [F.lit(name), F.struct(passed.alias("passed"), detail.alias("detail"))]


def _gates(*pairs: list[Column]) -> Column:
    return F.create_map(*[c for pair in pairs for c in pair]).alias("gate_results")


def _pct_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(num.pct(part, whole), F.lit(0.0))


def label_gates(written: DataFrame) -> DataFrame:
    """Volume, null delays among normal closes, and the usable share of this run's rows."""
    normal = F.col("closed_reason").isNull()
    counts = written.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(normal).alias("normal"),
        F.count_if(normal & F.col("delay_seconds").isNull()).alias("undelayed"),
    )
    total, usable, undelayed = F.col("total"), F.col("normal"), F.col("undelayed")
    null_rate = _pct_or_zero(undelayed, usable)
    label_rate = _pct_or_zero(usable, total)
    return counts.select(
        total.alias("rows_written"),
        _gates(
            _gate(
                "volume",
                total >= config.MIN_ROWS_WRITTEN,
                F.format_string(f"%d rows written (threshold: >= {config.MIN_ROWS_WRITTEN})", total),
            ),
            _gate(
                "null_rate",
                null_rate <= config.MAX_NULL_DELAY_RATE_PCT,
                F.format_string(
                    "%d/%d normally closed rows lack a delay (%.2f%%, threshold: <= "
                    f"{config.MAX_NULL_DELAY_RATE_PCT}%%)",
                    undelayed,
                    usable,
                    null_rate,
                ),
            ),
            _gate(
                "label_rate",
                label_rate >= config.MIN_TRAINING_LABEL_RATE_PCT,
                F.format_string(
                    f"%d/%d rows are usable (%.2f%%, threshold: >= {config.MIN_TRAINING_LABEL_RATE_PCT}%%)",
                    usable,
                    total,
                    label_rate,
                ),
            ),
        ),
    )


def feature_gates(written: DataFrame) -> DataFrame:
    """Volume and the share of written rows that have any history."""
    counts = written.agg(
        F.count(F.lit(1)).alias("total"), F.count("route_hour_historical_late_rate").alias("with_history")
    )
    total, known = F.col("total"), F.col("with_history")
    coverage = _pct_or_zero(known, total)
    return counts.select(
        total.alias("rows_written"),
        _gates(
            _gate(
                "volume",
                total >= config.MIN_ROWS_WRITTEN,
                F.format_string(f"%d rows written (threshold: >= {config.MIN_ROWS_WRITTEN})", total),
            ),
            _gate(
                "historical_rate_coverage",
                coverage >= config.MIN_HISTORICAL_RATE_COVERAGE_PCT,
                F.format_string(
                    f"%d/%d rows have history (%.2f%%, threshold: >= {config.MIN_HISTORICAL_RATE_COVERAGE_PCT}%%)",
                    known,
                    total,
                    coverage,
                ),
            ),
        ),
    )


def ingest_gates(stop_events: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """Freshness, volume and null rate of the last hour; no rows to judge means failed."""
    last = runs.agg(F.max("polled_at").alias("last_run_at"))
    volume = ledger.inserted_last_hour(runs, as_of)
    nulls = ledger.last_hour(stop_events, as_of).agg(
        F.count_if(F.col("scheduled_arrival").isNull()).alias("nulls"), F.count(F.lit(1)).alias("seen")
    )
    age = tc.epoch_seconds(F.col("last_run_at"), F.col("now")) / 60
    null_pct = num.pct(F.col("nulls"), F.col("seen"))
    return side_by_side(last, volume, nulls).withColumn("now", as_of).select(
        _gates(
            _gate(
                "freshness",
                F.coalesce(age <= config.FRESHNESS_MAX_MINUTES, F.lit(False)),
                F.coalesce(
                    F.concat(F.lit("last cycle "), num.fixed(age, 1), F.lit(" min ago")), F.lit("no cycle recorded")
                ),
            ),
            _gate(
                "volume",
                F.col("rows_last_hour") > 0,
                F.format_string("%d rows inserted in the last hour", F.col("rows_last_hour")),
            ),
            _gate(
                "null_rate",
                F.coalesce(null_pct <= config.NULL_RATE_MAX_PCT, F.lit(False)),
                F.coalesce(
                    F.concat(
                        F.lit("scheduled arrival null rate "),
                        num.fixed(null_pct, 2),
                        F.format_string("%% over the last hour (%d/%d)", F.col("nulls"), F.col("seen")),
                    ),
                    F.lit("no snapshots in the last hour"),
                ),
            ),
        )
    )


def all_passed(gate_results: str = "gate_results") -> Column:
    return F.forall(F.map_values(gate_results), lambda g: g["passed"])


def gate_rows(gates: DataFrame) -> DataFrame:
    """One row per gate."""
    return gates.select(F.explode("gate_results").alias("gate", "result")).select(
        "gate", "result.passed", "result.detail"
    )


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row aggregates with different columns as one row, without a cross join."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
