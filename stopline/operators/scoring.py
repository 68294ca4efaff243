"""Baseline scores and fitted models as (candidate, split, y, score) rows, and checks of the fits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.config import FEATURE_COLUMNS, LabelRules
from stopline.functions import numeric as num
from stopline.operators import boosting, prefix
from stopline.session import work_path
from stopline.sources import tables as tb

BASELINES = ["baseline_always_on_time", "baseline_route_hour_rate", "baseline_persistence"]
MODELS = ["logistic_regression", "gradient_boosting"]


@dataclass(frozen=True)
class ModelRules:
    """Settings of the two fitted candidates."""

    logistic_iterations: int = 1000
    boosting_rounds: int = 100
    boosting_step: float = 0.1
    tree_depth: int = 5
    most_leaves: int = 31
    min_rows_per_leaf: int = 20
    bins: int = 255


Model = PipelineModel | boosting.Boosted


def late_rate(split_rows: DataFrame, split: str = "train") -> DataFrame:
    return split_rows.filter(F.col("split") == split).agg(
        F.coalesce(num.ratio(F.sum(F.col("late").cast("int")), F.count(F.lit(1))), F.lit(0.0)).alias("late_rate")
    )


def always_on_time() -> Column:
    return F.lit(0.0)


def route_hour_score(train_rate: Column) -> Column:
    """The as-of rate; without history the train split's late rate, never the test split's."""
    return F.coalesce(F.nanvl("route_hour_historical_late_rate", train_rate), train_rate)


def persistence_score(rules: LabelRules = LabelRules()) -> Column:
    late = F.coalesce("current_delay_persistence_seconds", F.lit(0)) > rules.late_threshold_seconds
    return F.when(late, 1.0).otherwise(0.0)


def baseline_scores(split_rows: DataFrame, names: list[str] = BASELINES) -> DataFrame:
    """Scores of the baselines for every row of both splits, one row per candidate."""
    scores = {
        "baseline_always_on_time": always_on_time,
        "baseline_route_hour_rate": lambda: route_hour_score(late_rate(split_rows).scalar()),
        "baseline_persistence": persistence_score,
    }
    pairs = F.array(*[F.struct(F.lit(n).alias("candidate"), scores[n]().alias("score")) for n in names])
    return split_rows.select("split", F.col("late").cast("int").alias("y"), F.explode(pairs).alias("p")).select(
        "p.candidate", "split", "y", "p.score"
    )


@dataclass(frozen=True)
class FeatureFacts:
    """Per feature its exact median and its bin edges, both from one count of its values."""

    medians: dict[str, float]
    edges: dict[str, list[float]]

    def without(self, *features: str) -> FeatureFacts:
        """The facts of the other features, for a refit in which these have changed."""
        keep = lambda facts: {c: v for c, v in facts.items() if c not in features}
        return FeatureFacts(keep(self.medians), keep(self.edges))


def feature_counts(train: DataFrame) -> DataFrame:
    """Rows per (feature, known value), with the rows at smaller values."""
    return boosting.value_counts(train, FEATURE_COLUMNS)


def feature_facts(train: DataFrame, bins: int = boosting.BINS, known: FeatureFacts | None = None) -> FeatureFacts:
    """Facts of all features; values are counted only for features that are not known yet."""
    known = known or FeatureFacts({}, {})
    new = [c for c in FEATURE_COLUMNS if c not in known.edges]
    if not new:
        return known
    counts = tb.stage(boosting.value_counts(train, new), "feature-counts")
    found = {r["feature"]: r["median"] for r in prefix.median_of(counts, "value", ["feature"]).collect()}
    edges = boosting.bin_edges(counts, bins)
    return FeatureFacts(
        known.medians | {c: found.get(c, 0.0) for c in new}, known.edges | {c: edges.get(c, []) for c in new}
    )


def feature_medians(train: DataFrame) -> dict[str, float]:
    """Exact medians of the known feature values: one number per feature reaches the driver."""
    return feature_facts(train).medians


def _numeric(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("double") for c in FEATURE_COLUMNS}).withColumn(
        "label", F.col("late").cast("double")
    )


def with_median_fill(rows: DataFrame, medians: dict[str, float]) -> DataFrame:
    return _numeric(rows).withColumns({f"{c}_x": F.coalesce(c, F.lit(medians[c])) for c in FEATURE_COLUMNS})


def fit_logistic(filled: DataFrame, rows: int, rules: ModelRules) -> PipelineModel:
    """Scaled logistic regression; the penalty equals an L2 term of weight 1 on the summed loss."""
    columns = [f"{c}_x" for c in FEATURE_COLUMNS]
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(
                maxIter=rules.logistic_iterations, regParam=1.0 / max(rows, 1), standardization=False
            ),
        ]
    ).fit(filled)


def fit_boosting(train: DataFrame, rules: ModelRules, edges: dict[str, list[float]], rounds: int | None = None) -> boosting.Boosted:
    return boosting.fit(
        train,
        FEATURE_COLUMNS,
        F.col("late"),
        rounds=rules.boosting_rounds if rounds is None else rounds,
        step=rules.boosting_step,
        depth=rules.tree_depth,
        most_leaves=rules.most_leaves,
        least_rows=rules.min_rows_per_leaf,
        edges=edges,
    )


def stored_model(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as saved and loaded: without the fit's summary, which holds the session."""
    path = work_path(spark, "model")
    model.write().save(path)
    return PipelineModel.load(path)


def save_model(model: Model, spark: SparkSession, path: str) -> None:
    if isinstance(model, boosting.Boosted):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def _scored(model: Model, rows: DataFrame, name: str, facts: FeatureFacts) -> DataFrame:
    kept = [F.lit(name).alias("candidate"), F.col("split"), F.col("late").cast("int").alias("y")]
    if isinstance(model, boosting.Boosted):
        return model.score(rows, kept, "candidate string, split string, y int")
    scored = model.transform(with_median_fill(rows, facts.medians))
    return scored.select(*kept, vector_to_array("probability")[1].alias("score"))


@dataclass(frozen=True)
class Fitted:
    """Models by name, and the facts of the train split they were fitted with."""

    models: dict[str, Model]
    facts: FeatureFacts


def model_scores(
    split_rows: DataFrame, rules: ModelRules = ModelRules(), names: list[str] = MODELS, known: FeatureFacts | None = None
) -> tuple[DataFrame, Fitted]:
    """Fit the named models on train and score both splits."""
    train = split_rows.filter(F.col("split") == "train")
    facts = feature_facts(train, rules.bins, known)
    models: dict[str, Model] = {}
    scored: list[DataFrame] = []
    for name in names:
        if name == "logistic_regression":
            fit = fit_logistic(with_median_fill(train, facts.medians), train.count(), rules)
            models[name] = stored_model(fit, split_rows.sparkSession)
        else:
            models[name] = fit_boosting(train, rules, facts.edges)
        scored.append(_scored(models[name], split_rows, name, facts))
    out = scored[0]
    for more in scored[1:]:
        out = out.unionByName(more)
    return out, Fitted(models, facts)


# --- checks of the fits -------------------------------------------------------------------


def score_check(scored: DataFrame) -> DataFrame:
    """Per candidate and split: rows, positives, and scores that are no probability."""
    outside = ~F.coalesce(F.col("score").between(0.0, 1.0), F.lit(False))
    return scored.groupBy("candidate", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("y").cast("long").alias("positives"), F.count_if(outside).alias("outside")
    )


def logistic_gradient(fit: Fitted, train: DataFrame) -> DataFrame:
    """One row, ``steepest``: the largest part of the penalised loss's gradient at the fit, per row.

    At the optimum every part is 0: the sum of (score - y) x over rows plus the weight itself, and
    without that weight for the intercept. One pass over the rows, nothing of the optimiser's."""
    model = fit.models["logistic_regression"]
    weights = model.stages[-1].coefficients.toArray()
    scored = model.transform(with_median_fill(train, fit.facts.medians))
    x, p = vector_to_array("features"), vector_to_array("probability")[1]
    rows = scored.select((p - F.col("label")).alias("error"), x.alias("x"))
    parts = [F.abs(F.sum(F.col("error") * F.col("x")[k]) + F.lit(float(w))) for k, w in enumerate(weights)]
    steepest = F.greatest(F.abs(F.sum("error")), *parts) / F.count(F.lit(1))
    return rows.agg(F.coalesce(steepest, F.lit(0.0)).alias("steepest"))


def leaf_values(model: boosting.Boosted, train: DataFrame) -> DataFrame:
    """(leaf, value): the last tree's Newton steps, added up anew from the rows.

    The scores before that tree and the rows' leaves come from the model; sums are Spark's."""
    before = boosting.Boosted(model.features, model.edges, model.start, model.trees[:-1])
    shared = train.sparkSession.sparkContext.broadcast((before, model.trees[-1]))
    names = model.features

    def run(batches):
        for batch in batches:
            values = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names]
            earlier, last = shared.value
            bins = np.stack([boosting.binned(v, np.array(earlier.edges.get(c, ()))) for c, v in zip(names, values)])
            columns = [pa.array(last.leaves(bins)), pa.array(boosting.sigmoid(earlier.raw(values))), batch.column("y")]
            yield pa.RecordBatch.from_arrays(columns, names=["leaf", "p", "y"])

    doubles = train.select(*[F.col(c).cast("double").alias(c) for c in names], F.col("late").cast("int").alias("y"))
    sums = doubles.mapInArrow(run, "leaf long, p double, y int").groupBy("leaf")
    return sums.agg((F.sum(F.col("y") - F.col("p")) / F.sum(F.col("p") * (1 - F.col("p")))).alias("value"))


def boosting_check(model: boosting.Boosted, train: DataFrame, rules: ModelRules, refit_rounds: int = 2) -> dict[str, int]:
    """Leaves of the last tree whose value is not its Newton step, and nodes of the first trees that a
    second fit makes otherwise. Both are 0 for a right and repeatable fit."""
    off = 0
    if model.trees:
        last = model.trees[-1]
        for r in leaf_values(model, train).collect():  # one row per leaf
            off += abs(last.value[r["leaf"]] - rules.boosting_step * r["value"]) > 1e-6
    again = fit_boosting(train, rules, model.edges, min(refit_rounds, rules.boosting_rounds))
    differs = sum(
        (a, b, c) != (d, e, f) or abs(v - w) > 1e-6
        for one, two in zip(model.trees, again.trees)
        for a, b, c, v, d, e, f, w in zip(one.feature, one.cut, one.missing_left, one.value, two.feature, two.cut, two.missing_left, two.value)
    )
    return {"leaf_errors": int(off), "refit_errors": int(differs)}
