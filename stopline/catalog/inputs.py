"""The tables the queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stopline.operators import features as feat
from stopline.operators import labels as lab
from stopline.operators import predictions as pr
from stopline.operators import scoring
from stopline.plans import build_labels as bl
from stopline.plans import train as tr
from stopline.sources import derived as d

RULES = d.RULES
QUERY_MODELS = scoring.ModelRules()


def event_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels closed from the snapshots and the ledger."""
    return bl.closed_labels(d.stop_events(spark, sf_dir), d.poll_runs(spark, sf_dir), RULES)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.stored(spark, sf_dir, "labels", lambda: d.labels(spark, sf_dir))


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.training_labels(labels(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.stored(spark, sf_dir, "features", lambda: feat.build(training(spark, sf_dir)))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.training_set(features(spark, sf_dir), labels(spark, sf_dir))


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = lambda build, name: d.stored(spark, sf_dir, name, build)
    return tr.prepare(features(spark, sf_dir), labels(spark, sf_dir), keep=keep)


_FITTED: dict[tuple[str, str], scoring.Fitted] = {}


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the fitted models, stored; the models themselves are small and stay at hand."""

    def build() -> DataFrame:
        scored, _FITTED[spark.sparkContext.applicationId, sf_dir] = scoring.model_scores(split_rows(spark, sf_dir), QUERY_MODELS)
        return scored

    return d.stored(spark, sf_dir, "scores", build)


def fitted(spark: SparkSession, sf_dir: str) -> scoring.Fitted:
    model_scores(spark, sf_dir)
    return _FITTED[spark.sparkContext.applicationId, sf_dir]


def frozen_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fitted(spark, sf_dir).facts
    return d.stored(spark, sf_dir, "frozen", lambda: tr.frozen_scores(split_rows(spark, sf_dir), QUERY_MODELS, facts))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.stored(spark, sf_dir, "pages", lambda: d.pages(spark, sf_dir))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.stored(
        spark, sf_dir, "resources", lambda: pr.read_resources(pages(spark, sf_dir))
    )
