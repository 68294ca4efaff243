"""Training: split by time, score baselines and models, evaluate, log."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.config import FEATURE_COLUMNS, TRAIN_FRACTION
from stopline.operators import features as feat
from stopline.operators import gates, metrics, scoring, splits
from stopline.sources import tables as tb


@dataclass
class TrainingRun:
    results: DataFrame
    sensitivity: DataFrame
    log: DataFrame
    best: str
    model: scoring.Model


def prepare(features: DataFrame, labels: DataFrame, fraction: float = TRAIN_FRACTION, keep=tb.staged) -> DataFrame:
    """The training set with its split column.

    The set and its cut are stored by ``keep``: the join runs once, the cut reads one column of the set,
    and the split is told from the time on reading."""
    rows = keep(lambda: feat.training_set(features, labels), "training")
    return splits.temporal_split(rows, fraction, keep)


def frozen_scores(split_rows: DataFrame, rules: scoring.ModelRules, facts: scoring.FeatureFacts, names=scoring.MODELS) -> DataFrame:
    """Scores of models refitted with the route-hour rate frozen on train.

    Only that feature is counted and binned anew; the others keep their medians and bins."""
    frozen = tb.stage(splits.with_frozen_rate(split_rows), "frozen")
    return scoring.model_scores(frozen, rules, names, facts.without("route_hour_historical_late_rate"))[0]


def frozen_sensitivity(frozen_scored: DataFrame, results: DataFrame) -> DataFrame:
    """Metrics with the frozen rate, and the change in PR-AUC."""
    frozen = metrics.evaluate(frozen_scored)
    base = results.select("candidate", F.col("pr_auc").alias("base_pr_auc"))
    # One row per model on either side.
    return frozen.join(F.broadcast(base), "candidate").withColumn("pr_auc_delta", F.col("pr_auc") - F.col("base_pr_auc"))


def _text(value: Column) -> Column:
    return value.cast("string")


def experiment_log(results: DataFrame, split_rows: DataFrame, run_id: str, model_path: str | None = None) -> DataFrame:
    """One row per candidate: kind, parameters and metrics, as an appendable table."""
    s = splits.split_summary(split_rows)
    side = lambda name: s.filter(F.col("split") == name).select(
        F.col("rows").alias(f"{name}_rows"), F.round("late_rate", 4).alias(f"{name}_late_rate")
    )
    facts = gates.side_by_side(side("train"), side("test"), splits.preliminary_flag(split_rows)).select(
        F.struct("train_rows", "test_rows", "train_late_rate", "test_late_rate", F.round("window_days", 2).alias("window_days")).alias("facts"),
        "preliminary",
    )
    rows = results.withColumn("_f", facts.select(F.struct("facts", "preliminary")).scalar())
    candidate = F.col("candidate")
    kind = (
        F.when(candidate.startswith("baseline_"), "baseline")
        .when(candidate.endswith("_frozen_route_hour"), "sensitivity")
        .otherwise("model")
    )
    known = ["pr_auc", "roc_auc", "recall_at_precision", "train_threshold", "tn", "fp", "fn", "tp", "precision", "recall", "accuracy"]
    measured = F.map_filter(
        F.create_map(*[x for m in known for x in (F.lit(m), F.col(m).cast("double"))]), lambda _, v: v.isNotNull()
    )
    return rows.select(
        F.lit(run_id).alias("run_id"),
        candidate,
        kind.alias("kind"),
        F.create_map(
            F.lit("features"),
            F.lit(",".join(FEATURE_COLUMNS)),
            *[
                x
                for f in ("train_rows", "test_rows", "train_late_rate", "test_late_rate", "window_days")
                for x in (F.lit(f), _text(F.col(f"_f.facts.{f}")))
            ],
        ).alias("params"),
        measured.alias("metrics"),
        F.col("_f.preliminary").alias("preliminary"),
        F.lit(model_path).cast("string").alias("model_path"),
    )


def train(
    features: DataFrame,
    labels: DataFrame,
    log_path: str,
    models_path: str,
    rules: scoring.ModelRules = scoring.ModelRules(),
    run_id: str | None = None,
) -> TrainingRun:
    """Fit, evaluate, log every candidate and save the best model by test PR-AUC.

    The training set is staged: the iterative fits read it many times."""
    run_id = run_id or datetime.now(timezone.utc).strftime("v%Y%m%d-%H%M%S")
    rows = prepare(features, labels)
    scored, fitted = scoring.model_scores(rows, rules)
    results = tb.stage(metrics.evaluate(tb.stage(scoring.baseline_scores(rows).unionByName(scored), "scores")), "results")
    frozen = tb.stage(frozen_scores(rows, rules, fitted.facts), "frozen-scores")
    sensitivity = tb.stage(frozen_sensitivity(frozen, results), "sensitivity")
    best = metrics.best_candidate(results.filter(F.col("candidate").isin(scoring.MODELS))).first()["candidate"]
    model_path = f"{models_path}/{run_id}-{best}"
    scoring.save_model(fitted.models[best], rows.sparkSession, model_path)
    frozen = sensitivity.withColumn("candidate", F.concat("candidate", F.lit("_frozen_route_hour"))).select(*results.columns)
    log = tb.stage(experiment_log(results.unionByName(frozen), rows, run_id, model_path), "log")
    tb.append(log, log_path)
    return TrainingRun(results, sensitivity, log, best, fitted.models[best])
