"""A corpus pipeline: five stages, each written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stopline.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from stopline.llm.common import ship, table
from stopline.session import prepare, work_path
from stopline.sources.tables import scratch
from stopline.sources.versioned import Files

TOXIC = 0.7
#: Near copies share this many per cent of their shingles of so many words; op5's own defaults differ.
NEAR_PERCENT, NEAR_WORDS = 80, 5


def ready(spark: SparkSession) -> SparkSession:
    """Stages may be run one by one, so each sets what it relies on: above all small batches of whole texts."""
    return ship(prepare(spark))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the model learns from the labels."""
    model = toxicity.learn(docs, table(ready(spark), sf_dir, "labels"))
    return toxicity.reject(docs, model, TOXIC)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    ready(spark)
    return exact_dedup.deduplicate(docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    ready(spark)
    return jaccard_join.keep_first(docs, jaccard_join.components(docs, percent=NEAR_PERCENT, size=NEAR_WORDS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a document taken twice is two rows."""
    ready(spark)
    return mixing.take(docs, mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and the sequences they lie in."""
    ready(spark)
    return packing.with_digest(packing.pack(docs))


STAGES = [
    ("toxicity", clean),
    ("exact dedup", distinct),
    ("n-gram Jaccard join", apart),
    ("mixing", mixed),
    ("packing", packed),
]

#: Classifier, components and tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it.

    What a stage has staged goes when its result is stored, and a stored result when the next one is."""
    docs, before = table(ready(spark), sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = work_path(spark, f"pipeline-{k}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            Files(spark, before).remove(before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
