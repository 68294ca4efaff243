"""Ranking and threshold metrics per candidate, from per-score totals.

Input rows are (candidate, split, y, score). They are reduced to one row per distinct score
before any ordering, and cumulated in nested score buckets, so no candidate has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.config import MIN_PRECISION
from stopline.functions import numeric as num
from stopline.operators import prefix
from stopline.sources import tables as tb

KEY = ["candidate", "split"]


def score_curve(scored: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Per distinct score, from high to low: rows at or above it, and the rates they give.

    The totals per score are staged: the scored rows are read once, however often the curve is."""
    totals = scored.groupBy(*keys, "score").agg(F.sum("y").alias("tp"), F.count(F.lit(1)).alias("n"))
    points = tb.stage(totals, "score-points").withColumn("rank_key", -F.col("score"))
    cumulative = prefix.prefix_sums(points, keys, "rank_key", ["tp", "n"], prefix.score_buckets("rank_key"))
    # One row per candidate and split.
    totals = points.groupBy(*keys).agg(F.sum("tp").alias("positives"), F.sum("n").alias("total"))
    hits, predicted = F.col("tp_before") + F.col("tp"), F.col("n_before") + F.col("n")
    return cumulative.join(F.broadcast(totals), keys).select(
        *keys,
        "score",
        "tp",
        "n",
        "tp_before",
        "n_before",
        "positives",
        "total",
        hits.alias("true_positives"),
        predicted.alias("predicted"),
        num.ratio(hits, predicted).alias("precision"),
        num.ratio(hits, F.col("positives")).alias("recall"),
    )


def _average_precision() -> Column:
    step = num.ratio(F.col("tp"), F.col("positives"))
    return F.coalesce(F.sum(step * F.col("precision")), F.lit(0.0))


def _roc_auc() -> Column:
    negatives_here = F.col("n") - F.col("tp")
    area = F.sum(negatives_here * (F.col("tp_before") + F.col("true_positives")) / 2.0)
    positives, total = F.max("positives"), F.max("total")
    return num.ratio(area, positives * (total - positives))


def ranking_metrics(curve: DataFrame, min_precision: float = MIN_PRECISION, keys: list[str] = KEY) -> DataFrame:
    """Average precision, ROC area, best recall and lowest threshold at the wanted precision.

    Only scores that occur count as thresholds, so a candidate that never reaches the precision
    gets nulls."""
    good = F.col("precision") >= min_precision
    return curve.groupBy(*keys).agg(
        _average_precision().alias("pr_auc"),
        _roc_auc().alias("roc_auc"),
        F.max(F.when(good, F.coalesce("recall", F.lit(1.0)))).alias("recall_at_precision"),
        F.min(F.when(good, F.col("score"))).alias("threshold"),
    )


def confusion(points: DataFrame, threshold: Column, keys: list[str]) -> DataFrame:
    """Counts and rates when scores at or above the threshold are called late.

    Precision is null when nothing is called late. A null threshold gives nulls throughout."""
    called = F.col("score") >= threshold
    positives = F.col("tp")
    negatives = F.col("n") - F.col("tp")
    usable = F.max(threshold).isNotNull()

    def count(condition: Column, value: Column) -> Column:
        return F.when(usable, F.coalesce(F.sum(F.when(condition, value)), F.lit(0)))

    counts = points.groupBy(*keys).agg(
        count(~called, negatives).alias("tn"),
        count(called, negatives).alias("fp"),
        count(~called, positives).alias("fn"),
        count(called, positives).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {
            "precision": num.ratio(tp, tp + fp),
            "recall": num.ratio(tp, tp + fn),
            "accuracy": num.ratio(tn + tp, tn + fp + fn + tp),
        }
    )


def evaluate(scored: DataFrame, min_precision: float = MIN_PRECISION) -> DataFrame:
    """Every candidate on test, at the threshold chosen on train."""
    curve = score_curve(scored)
    ranked = ranking_metrics(curve, min_precision)
    thresholds = ranked.filter(F.col("split") == "train").select(
        "candidate", F.col("threshold").alias("train_threshold")
    )
    test_points = curve.filter(F.col("split") == "test").select("candidate", "score", "tp", "n")
    # One row per candidate on each broadcast side.
    fixed = test_points.join(F.broadcast(thresholds), "candidate", "left")
    matrix = confusion(fixed, F.col("train_threshold"), ["candidate"])
    return (
        ranked.filter(F.col("split") == "test")
        .select("candidate", "pr_auc", "roc_auc", "recall_at_precision")
        .join(F.broadcast(thresholds), "candidate", "left")
        .join(F.broadcast(matrix), "candidate", "left")
    )


def best_candidate(results: DataFrame) -> DataFrame:
    """Highest PR-AUC; equal values go to the first candidate by name."""
    return results.orderBy(F.desc("pr_auc"), "candidate").limit(1)
