"""One query per operator over its whole table, with production parameters, and check SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.llm import (
    alignment,
    exact_dedup,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    neighbours,
    packing,
    periodic_runs,
    private_data,
    suffix_dedup,
    token_counts,
    toxicity,
)
from stopline.llm.common import held_out, ship, table
from stopline.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKEN_LIMIT = 1024
TOXIC = 0.7


def query(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = lambda spark, sf_dir: build(ship(prepare(spark)), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op2_neighbours")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model).withColumn("held_out", held_out())
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@query("op5_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


@query("op6_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs.filter(~held_out()))
    said = language_id.predict(docs, model)
    return said.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op9_private_data")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.find(table(spark, sf_dir, "documents"))
    counts = [f"n_{k}" for k in private_data.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_digest(packing.pack(table(spark, sf_dir, "documents")))


@query(
    "op10_exact_dedup",
    """
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
    g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256
    FROM n JOIN g ON n.t = g.t
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"), digest=True)


@query(
    "op11_line_dedup",
    """
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines),
    repeated AS (
        SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
    judged AS (
        SELECT k.*, first IS NOT NULL AND doc_id <> first AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def contract_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Op13's words: in a tenth of the documents a tail repeats with a period given by the id."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), change=contract_words)
    return periodic_runs.with_digests(found)
