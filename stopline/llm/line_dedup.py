"""Lines that other documents hold too: exploded, hashed, counted by distinct documents, dropped.

Each line becomes a key (white space stripped at both ends, A-Z in lower case) and each key two
64-bit hashes; only hashes travel. One aggregate counts the distinct documents of every key and
finds the smallest id among them; it combines map-side and deals rows by key and document, so a line
that a third of all documents hold is never one group of rows. Keys in too many documents meet the lines again:
the few that hold more than a thousandth of them are broadcast (there are fewer than a thousand
such keys, whatever the data), the others are joined by key after a bit filter, sized by the number
of keys, has let go the lines that surely stay. Dropped positions go back to their document, where
the remaining lines are joined in their order.

Defined results: a null or empty text is one empty line. Rows that share a document id are one
document for the counts, each with its own lines; a null id is one document after all others. All
lines of a repeated key stay in the smallest id that holds it, so does every line whose key is
shorter than ``min_chars`` code points. A text whose lines all go is the empty text. Other columns
are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import bit_filter, filter_bits, stage, text_of, tidy, with_candidate

MIN_CHARS = 10
MIN_DOCUMENTS = 2
HOT_SHARE = 1000
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, sig, pos and the two hashes of every line whose key is long enough."""
    exploded = rows.select("doc_id", "sig", F.posexplode("lines").alias("pos", "line"))
    keyed = exploded.select("doc_id", "sig", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select("doc_id", "sig", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


def repeated_keys(lines: DataFrame, min_documents: int) -> DataFrame:
    """h1, h2, first (smallest id that holds the key), n (documents) of keys in enough documents."""
    unnamed = F.max(F.col("doc_id").isNull().cast("int"))
    counted = lines.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first"), (F.count_distinct("doc_id") + unnamed).alias("n")
    )
    return counted.filter(F.col("n") >= min_documents)


def dropped_positions(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, sig, drop: the positions of lines that another, smaller document holds."""
    size = repeated.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    common = F.col("n") * HOT_SHARE > size.n  # fewer than HOT_SHARE keys
    hot = repeated.filter(common).select("h1", "h2", F.col("first").alias("hot_first"), F.lit(True).alias("hot"))
    cold = repeated.filter(~common).select("h1", "h2", "first")
    bits = filter_bits(size["keys"])
    words = stage(bit_filter(cold, "h1", bits), "line-filter")
    found = with_candidate(lines.join(F.broadcast(hot), ["h1", "h2"], "left"), "h1", words, bits, "maybe")
    found = found.filter("case when hot then not (doc_id <=> hot_first) else maybe end").drop("hot_first", "maybe")
    found = stage(found, "line-candidates")
    rest = found.filter("hot is null").join(cold, ["h1", "h2"]).filter("not (doc_id <=> first)")
    gone = found.filter("hot").select("doc_id", "sig", "pos").unionByName(rest.select("doc_id", "sig", "pos"))
    return gone.groupBy("doc_id", "sig").agg(F.collect_list("pos").alias("drop"))


@tidy
def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """One row per input row: its id, n_lines, n_dropped and ``kept``, the text without those lines."""
    text = text_of(text_col)
    # equal texts of one id share a signature, and their decisions too
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("sig"), F.split(text, "\n", -1).alias("lines")
    )
    lines = _lines(rows, min_chars)
    repeated = stage(repeated_keys(lines, min_documents), "line-keys")
    drops = dropped_positions(lines, repeated).select(F.col("doc_id").alias("d_id"), F.col("sig").alias("d_sig"), "drop")
    met = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("sig") == F.col("d_sig")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    left = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get(F.col("lines"), i)))
    n = F.size("lines").cast("long")
    return met.select(F.col("doc_id").alias(id_col), n.alias("n_lines"), left.alias("left")).select(
        id_col, "n_lines", (F.col("n_lines") - F.size("left")).alias("n_dropped"), F.array_join("left", "\n").alias("kept")
    )
