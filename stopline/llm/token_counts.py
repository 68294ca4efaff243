"""Token counts by a map-side two-tier lookup; no pre-token is ever shuffled.

One pass over all texts counts space-separated pieces in each task and hands on only a bounded
summary of its most frequent ones. Their token counts become a compact table of at most
``table_entries`` short strings, which is broadcast. The second pass looks every piece up in that
table, then in a bounded cache of the worker, and encodes only what neither knows. The result does
not depend on the table: it decides only how often the encoder is called.

Defined results: null and empty texts have 0 bytes and 0 tokens. A special string inside a text is
one token, as the library does by default. Repeated rows each get their own result; other columns
are not read. A text is never cut.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import text_of
from stopline.llm.vocabulary import BYTE_PATTERN, LONGEST_KEPT, SPACE_RUN, Bounded, Encoder, tokenizer_path

TABLE_ENTRIES = 65_536
SUMMARY_ENTRIES = 16_384
COUNTER_ENTRIES = 300_000


def _summaries(entries: int, room: int):
    """Count the pieces of all texts of a task; pass on its most frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(text.split(" ")[1:])
                if len(counts) > room:
                    counts = Counter(dict(counts.most_common(room // 2)))
        top = [(k, n) for k, n in counts.most_common(entries) if 0 < len(k) <= LONGEST_KEPT]
        yield pa.RecordBatch.from_pydict(
            {"piece": [k for k, _ in top], "n": [n for _, n in top]}, schema=pa.schema({"piece": pa.string(), "n": pa.int64()})
        )

    return run


def frequent_pieces(docs: DataFrame, text_col: str = "text", entries: int = TABLE_ENTRIES) -> list[str]:
    """The most frequent pieces after a space: at most ``entries`` strings of at most 64 characters."""
    texts = docs.select(text_of(text_col).alias("text"))
    found = texts.mapInArrow(_summaries(SUMMARY_ENTRIES, COUNTER_ENTRIES), "piece string, n long")
    ranked = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(entries)
    return [r.piece for r in ranked.select("piece").toLocalIterator()]


class Counts:
    """Token counts of texts: the broadcast table first, the worker's cache next, the encoder last."""

    def __init__(self, path: str, table: dict[str, int]):
        import regex

        self.encoder, self.table = Encoder(path), table
        self.split = regex.compile(BYTE_PATTERN).findall
        self.pre_tokens = Bounded(lambda p: len(self.encoder.ids(p)))
        self.pieces = Bounded(self._piece)

    def _piece(self, piece: str) -> int:
        """Tokens of a space and what follows it up to the next space."""
        known = self.table.get(piece)
        return sum(map(self.pre_tokens.__getitem__, self.split(" " + piece))) if known is None else known

    def count(self, text: str) -> int:
        if not self.encoder.plain(text):
            return len(self.encoder.ids(text))
        if SPACE_RUN.search(text) or text[-1:] == " ":  # a space before white space joins its pre-token
            return sum(map(self.pre_tokens.__getitem__, self.split(text)))
        first, *rest = text.split(" ")
        return sum(map(self.pre_tokens.__getitem__, self.split(first))) + sum(map(self.pieces.__getitem__, rest))


def _counted(path: str, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(path, table.value)
        for batch in batches:
            n = [counts.count(t) for t in batch.column("text").to_pylist()]
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n, pa.int64())], names=[*names, "n_tokens"])

    return run


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    table_entries: int = TABLE_ENTRIES,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens."""
    spark, path = docs.sparkSession, tokenizer_path(vocabulary)
    encoder = Encoder(path)
    table = {p: len(encoder.ids(" " + p)) for p in frequent_pieces(docs, text_col, table_entries) if encoder.plain(p)}
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), text_of(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_counted(path, spark.sparkContext.broadcast(table)), f"doc_id {kind}, n_bytes long, n_tokens long")
