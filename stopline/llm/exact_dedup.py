"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

One pass reads each text's normalised length and the hash of its first characters. Lengths that occur
twice become a bit filter, sized by their number; of the texts it lets through, prefix hashes that occur
twice with their length become another. The last pass takes the full hash of texts that both may hold;
every other text is certainly unique and is neither hashed nor grouped. Groups are counted with map-side
partial aggregates, and large groups are dealt out in slices when their rows learn the result, so a
group with a third of all rows is never in one task.

Defined results: a null text equals the empty text. Rows that repeat a document id and its text
belong to the group of that text and count in its size; in ``mark`` all rows that carry the
smallest id are kept, in ``deduplicate`` exactly one row stays: of rows that share the smallest id, the
one whose other columns have the smallest hash. A null id sorts after all others. Ids are of any
type that has an order, other columns of any type and name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import WHITE, bit_filter, filter_bits, salted_join, stage, text_of, tidy, with_candidate

PREFIX_CHARS = 64


def normalised(column: str = "text") -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text_of(column), WHITE, " ")


def _twice(rows: DataFrame, key: str, bits: int | None) -> tuple[DataFrame, int]:
    """A bit filter of the values of ``key`` that occur twice, stored, and its bits."""
    repeated = stage(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), "dedup-keys")
    bits = bits or filter_bits(repeated.count())
    return stage(bit_filter(repeated, key, bits), "dedup-filter"), bits


def _candidates(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, bits: int | None) -> DataFrame:
    """(row, id, norm, maybe): each input row and whether its length and prefix may occur twice."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
    length = F.xxhash64(F.length("norm"))
    prefix = F.xxhash64(F.length("norm"), F.substring("norm", 1, prefix_chars))
    slim = stage(rows.select(length.alias("length"), prefix.alias("prefix")), "dedup-slim")
    lengths, n = _twice(slim, "length", bits)
    near = with_candidate(slim, "length", lengths, n, "may").filter("may")
    prefixes, n = _twice(near, "prefix", bits)
    return with_candidate(rows.withColumn("prefix", prefix), "prefix", prefixes, n, "maybe").drop("prefix")


@tidy
def mark(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    bits: int | None = None,
    digest: bool = False,
) -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept``; texts are not carried.

    With ``digest`` also ``text_sha256`` of every normalised text, unique ones included."""
    full = F.sha2("norm", 256)
    rows = _candidates(docs, id_col, text_col, prefix_chars, bits).select(
        "id", F.when(F.col("maybe"), full).alias("hash"), *([full.alias("text_sha256")] if digest else [])
    )
    rows = stage(rows, "dedup-rows")
    maybe = rows.filter("hash IS NOT NULL")
    # the count tells groups of null ids apart from groups without rows, so min never hides them
    groups = maybe.groupBy("hash").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    joined = salted_join(maybe, stage(groups, "dedup-groups"), "hash", "left")
    kind = rows.schema["id"].dataType
    alone = rows.filter("hash IS NULL").withColumns({"keep": F.lit(None).cast(kind), "size": F.lit(None).cast("long")})
    keep = F.coalesce("keep", "id")
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        *(["text_sha256"] if digest else []),
    )


@tidy
def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    bits: int | None = None,
) -> DataFrame:
    """The input rows without their exact duplicates: of each group the row with the smallest id.

    Texts that are certainly unique pass without a shuffle; the others are combined map-side."""
    rows = _candidates(docs, id_col, text_col, prefix_chars, bits)
    others = F.xxhash64(F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"row.`{c}`") for c in docs.columns if c != id_col])))
    order = F.struct(F.col("id").isNull(), F.col("id"), others)
    picked = rows.filter("maybe").groupBy(F.sha2("norm", 256)).agg(F.min_by("row", order).alias("row"))
    return rows.filter("not maybe").select("row.*").unionByName(picked.select("row.*"))
