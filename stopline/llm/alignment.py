"""Alignment of two tokenizers over every text, and how often their tokens stand for each other.

Both tokenizers encode the same bytes, so their tokens are intervals on one axis. The tokens of a
stretch of documents are laid end to end and coalesced: all A and B tokens are lexsorted by start,
``maximum.accumulate`` carries the furthest end so far, and a group breaks where a start reaches it.
Inside a group overlaps expand to links between an A and a B token. A first pass writes, for each
document, its counts and its distinct linked id pairs. One aggregate, combined map-side, counts the
documents of every pair. The second pass looks pairs up in a broadcast table of the most frequent
ones (``table_pairs`` entries at most, as sorted arrays); pairs beyond it, each in a tiny share of
the documents, are joined by key. Both ways give the same sums.

Defined results: a text that is null, empty, or not given back byte for byte by either tokenizer has
no tokens: all counts 0, groups ''. Every row is a document of its own for the counts of pairs,
rows that repeat an id included. Special strings inside texts are plain text. Texts are never cut;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import stage, text_of, tidy
from stopline.llm.packing import BYTE_LETTERS
from stopline.llm.vocabulary import BYTE_PATTERN, tokenizer_path

TABLE_PAIRS = 1 << 20
STRETCH_CHARS = 200_000
META = "▁"  # how the second vocabulary writes a space


class ByteSide:
    """A byte-level vocabulary: ids of a space and the text, from the file's own entries."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        special = {t["id"] for t in stored["added_tokens"]}
        letter = {chr(code): byte for byte, code in BYTE_LETTERS.items()}
        entries = {i: bytes(letter.get(c, ord(c) & 255) for c in piece) for piece, i in stored["model"]["vocab"].items()}
        self.bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        ranks = {b: i for i, b in entries.items() if i not in special}  # an entry's id is the rank of its merge
        self.encoding = tiktoken.Encoding("a", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(" " + text)


class PieceSide:
    """A piece vocabulary with byte fallback, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(len(self.model))]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(META, " ").encode() for i, p in enumerate(pieces)
        ]

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text)


def coalesce(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of A tokens and of B tokens, both given by the ends of gapless intervals."""
    ends = np.concatenate([a_end, b_end])
    starts = np.concatenate([[0], a_end[:-1], [0], b_end[:-1]])[: len(ends)]
    is_b = np.arange(len(ends)) >= len(a_end)
    order = np.lexsort((is_b, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.zeros(len(ends), np.int64)
    group[1:] = np.cumsum(starts[order][1:] >= reach[:-1])
    back = np.empty_like(group)
    back[order] = group
    return back[: len(a_end)], back[len(a_end) :]


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (A token, B token) whose intervals overlap; a group's boundary is never crossed."""
    a_start, b_start = np.append(0, a_end[:-1]), np.append(0, b_end[:-1])
    low = np.searchsorted(b_end, a_start, "right")
    n = np.searchsorted(b_start, a_end, "left") - low
    a = np.repeat(np.arange(len(a_end)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


class Aligner:
    """Aligns stretches of texts; one per task."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.len_a, self.len_b = (np.array([len(b) for b in s.bytes], np.int64) for s in (self.a, self.b))
        # each token as text: continuing its list, or opening a group (A) or the second list (B)
        self.said = np.array(
            [mark + str(i) for side, marks in ((self.a, ",;"), (self.b, ",|")) for mark in marks for i in range(len(side.bytes))], object
        )
        self.at_b = 2 * len(self.a.bytes)

    def _tokens(self, text: str) -> tuple[list[int], list[int]]:
        if not text:
            return [], []
        a, b, want = self.a.ids(text), self.b.ids(text), b" " + text.encode()
        same = all(b"".join(map(s.bytes.__getitem__, ids)) == want for s, ids in ((self.a, a), (self.b, b)))
        return (a, b) if same else ([], [])

    def align(self, texts: list[str]) -> dict[str, list]:
        """Per text n_a, n_b, n_groups, n_links, groups, and its distinct id pairs with their links."""
        tokens = [self._tokens(t) for t in texts]
        a, b = (np.array([i for t in tokens for i in t[side]], np.int64) for side in (0, 1))
        n_a, n_b = (np.array([len(t[side]) for t in tokens]) for side in (0, 1))
        a_end, b_end = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        group_a, group_b = coalesce(a_end, b_end)
        link_a, link_b = overlaps(a_end, b_end)
        doc_of_a = np.repeat(np.arange(len(texts)), n_a)
        # tokens by group, A before B, in their order
        opens_a = np.diff(group_a, prepend=-1) != 0
        opens_b = np.diff(group_b, prepend=-1) != 0
        code = np.concatenate([a + opens_a * len(self.a.bytes), b + self.at_b + opens_b * len(self.b.bytes)])
        order = np.lexsort((np.arange(len(code)) >= len(a), np.concatenate([group_a, group_b])))
        said = self.said[code[order]].tolist()
        at = np.append(0, np.cumsum(n_a + n_b)).tolist()
        pairs, links = np.unique((doc_of_a[link_a] * len(self.a.bytes) + a[link_a]) * len(self.b.bytes) + b[link_b], return_counts=True)
        size = len(self.a.bytes) * len(self.b.bytes)
        cut = np.searchsorted(pairs, np.arange(len(texts) + 1) * size)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(doc_of_a[opens_a], minlength=len(texts)),
            "n_links": np.bincount(doc_of_a[link_a], minlength=len(texts)),
            "groups": ["".join(said[i:j])[1:] for i, j in zip(at, at[1:])],
            "pairs": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(pairs % size)),
            "links": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(links.astype(np.int32))),
        }


def _stretches(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list]]:
    """Ids and texts, some hundred thousand characters at a time; a text is never divided."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _aligned(path_a: str, path_b: str, whole: bool, kind: pa.DataType | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, row = Aligner(path_a, path_b), TaskContext.get().partitionId() << 40
        for ids, texts in _stretches(batches, STRETCH_CHARS):
            found = aligner.align(texts)
            groups = found.pop("groups")
            out = {"row": pa.array(np.arange(row, row + len(texts))), "doc_id": pa.array([i.as_py() for i in ids], ids[0].type)}
            row += len(texts)
            out |= {k: v if isinstance(v, pa.ListArray) else pa.array(v.astype(np.int64)) for k, v in found.items()}
            out["groups_sha256"] = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups])
            if whole:
                out["groups"] = pa.array(groups)
            yield pa.RecordBatch.from_pydict(out)

    return run


def _looked_up(keys, counts, best, width: int):
    """Sums over the pairs the table holds; the others go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, most = keys.value, counts.value, best.value
        for batch in batches:
            pairs, links = (batch.column(c) for c in ("pairs", "links"))
            at = pairs.offsets.to_numpy().astype(np.int64) - pairs.offsets[0].as_py()
            pair, link = pairs.flatten().to_numpy(), links.flatten().to_numpy().astype(np.int64)
            place = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[place] == pair if len(known) else np.zeros(len(pair), bool)
            count = np.where(hit, n[place] if len(known) else 0, 0)
            top = hit & (count == most[pair // width])

            def sums(x):
                total = np.append(0, np.cumsum(x))
                return pa.array(total[at[1:]] - total[at[:-1]])

            left = np.append(0, np.cumsum(~hit))[at]
            rest = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(v[~hit])) for v in (pair, link)]
            names = [c for c in batch.schema.names if c not in ("pairs", "links")]
            columns = [*(batch.column(c) for c in names), sums(link * top), sums(link * count), *rest]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_best", "count_sum", "pairs", "links"])

    return run


def table_floor(counted: DataFrame, entries: int) -> int:
    """The smallest count such that at most ``entries`` pairs reach it, in steps of an eighth of a power
    of two: found from some hundred rows."""
    step = F.floor(F.log2("n") * 8)
    steps = sorted(counted.groupBy(step.alias("step")).agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("pairs")).collect(), reverse=True)
    floor, total = (steps[0].n + 1 if steps else 1), 0
    for s in steps:
        total += s.pairs
        if total > entries:
            break
        floor = s.n
    return floor


@tidy
def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_a: str = "byte_bpe_50k.json",
    vocabulary_b: str = "piece_bpe_32k.model",
    table_pairs: int = TABLE_PAIRS,
    groups: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256;
    with ``groups`` also the aligned groups themselves, ``a1,a2|b1;a3|b2,b3``."""
    spark = docs.sparkSession
    paths = tokenizer_path(vocabulary_a), tokenizer_path(vocabulary_b)
    sides = ByteSide(paths[0]), PieceSide(paths[1])
    width = len(sides[1].bytes)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = "n_a long, n_b long, n_groups long, n_links long"
    extra = ", groups string" if groups else ""
    made = f"row long, doc_id {kind}, {counts}, pairs array<long>, links array<int>, groups_sha256 string{extra}"
    aligned = stage(rows.mapInArrow(_aligned(*paths, groups), made), "aligned")
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counted = stage(counted, "pair-counts")
    first = F.floor(F.col("pair") / width).cast("long")
    best = counted.groupBy(first.alias("a")).agg(F.max("n").alias("best"))  # one row per A id at most
    most = np.zeros(len(sides[0].bytes), np.int64)
    for r in best.toLocalIterator():
        most[r.a] = r.best
    floor = table_floor(counted, table_pairs)
    common = counted.filter(F.col("n") >= floor).orderBy("pair").toArrow()  # at most table_pairs rows
    table = [spark.sparkContext.broadcast(v) for v in (common["pair"].to_numpy(), common["n"].to_numpy(), most)]
    seen = f"row long, doc_id {kind}, {counts}, groups_sha256 string{extra}, n_best long, count_sum long, pairs array<long>, links array<long>"
    summed = aligned.mapInArrow(_looked_up(*table, width), seen)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if groups else [])]
    rare = counted.filter(F.col("n") < floor)
    if rare.isEmpty():
        return summed.select(*names).withColumnRenamed("doc_id", id_col)
    summed = stage(summed, "pair-sums")
    missed = summed.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("row", "p.pairs", "p.links")
    top = F.broadcast(best.withColumnRenamed("a", "b_a"))
    named = rare.join(top, first == F.col("b_a")).select("pair", "n", (F.col("n") == F.col("best")).alias("top"))
    late = missed.join(named, F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.expr("if(top, links, 0L)")).alias("late_best"), F.sum(F.expr("links * n")).alias("late_sum")
    )
    full = summed.join(late, "row", "left").withColumns(
        {"n_best": F.expr("n_best + coalesce(late_best, 0)"), "count_sum": F.expr("count_sum + coalesce(late_sum, 0)")}
    )
    return full.select(*names).withColumnRenamed("doc_id", id_col)
