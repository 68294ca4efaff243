"""Periodic runs of words: maximal stretches that repeat with some period.

A run is a stretch with smallest period q, at least ``min_repeats`` periods and ``min_words`` words
long, that no neighbouring word extends. Runs are found through their Lyndon roots: the longest
Lyndon word that starts at a position, under the order of symbols and under its reverse, is the root
of every run that holds it. Ukkonen's algorithm builds the suffix trees of the words and of their
reversal; over an Euler tour a sparse table gives the depth of any two leaves' lowest common
ancestor in constant time, which is how far two positions agree to the right or, in the reversed
tree, to the left. Each root is extended by both, and what is long enough is a run.

Trees are built only where a run can lie. With L words and period q a run repeats L - q of them, so every
window of ``min_words * (1 - 1 / min_repeats)`` words in it occurs again at a distance of at most
q, and such windows cover it whole. Stretches covered by windows that recur near enough thus hold all
runs, each in one stretch; in most texts there are none. Every text is handled whole by one task,
nothing is shuffled, and memory follows the longest stretch.

Defined results: a null, empty or blank text has no words, no runs and null columns for the best
run. Rows are independent, so rows that repeat an id each get their own result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import text_of

MIN_WORDS = 24
MIN_REPEATS = 3
STEP = np.uint64(0x9E3779B97F4A7C15)


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of symbols from 1 on, closed by the smallest symbol, 0."""

    def __init__(self, symbols: list[int]):
        self.symbols = s = [*symbols, 0]
        self.size = n = len(s)
        width = max(s) + 1
        start, end, parent, link, child = [0], [0], [0], [0], {}
        leaves = []
        node = length = pending = edge = 0
        for i, c in enumerate(s):
            fresh = 0
            pending += 1
            while pending:
                if not length:
                    edge = i
                key = node * width + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(n)
                    parent.append(node)
                    link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    first = start[below]
                    span = min(end[below], i + 1) - first
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    if s[first + length] == c:
                        length += 1
                        if fresh:
                            link[fresh] = node
                        break
                    middle = len(start)
                    start += [first, i]
                    end += [first + length, n]
                    parent += [node, middle]
                    link += [0, 0]
                    child[key] = middle
                    start[below] = first + length
                    parent[below] = middle
                    child[middle * width + s[start[below]]] = below
                    child[middle * width + c] = middle + 1
                    leaves.append(middle + 1)
                    if fresh:
                        link[fresh] = middle
                    fresh = middle
                pending -= 1
                if not node and length:
                    length -= 1
                    edge = i - pending + 1
                else:
                    node = link[node]
        self.leaves = np.array(leaves)  # the k-th leaf that was made is the suffix from k
        self.parent, self.start, self.end = np.array(parent), np.array(start), np.array(end)

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Depths along the Euler tour, a leaf once and an inner node between its children, and the place
        of each suffix in it. ``reverse`` visits children by falling symbol, the closing one first."""
        first = np.array(self.symbols)[self.start]
        falling = np.where(first > 0, -first, -first.max() - 1)
        order = np.lexsort((falling if reverse else first, self.parent))
        order = order[order != 0]  # the root is nobody's child
        bounds = np.searchsorted(self.parent[order], np.arange(len(self.start) + 1))
        at, stop, order = bounds[:-1].tolist(), bounds[1:].tolist(), order.tolist()
        span, depth = (self.end - self.start).tolist(), [0] * len(self.start)
        begin, out, place, stack = bounds[:-1].tolist(), [], [0] * len(self.start), [0]
        while stack:
            node = stack[-1]
            k = at[node]
            if k == stop[node]:
                stack.pop()
                continue
            if k > begin[node]:
                out.append(depth[node])
            at[node] = k + 1
            below = order[k]
            depth[below] = depth[node] + span[below]
            if begin[below] == stop[below]:
                place[below] = len(out)
                out.append(depth[below])
            else:
                stack.append(below)
        return np.array(out, np.int32), np.array(place)[self.leaves]


class Extension:
    """How many symbols agree from two positions on, for arrays of positions."""

    def __init__(self, depths: np.ndarray, places: np.ndarray):
        self.places = places
        rows = [depths]
        while 2 << (len(rows) - 1) <= len(depths):
            half, row = 1 << (len(rows) - 1), rows[-1].copy()
            np.minimum(row[:-half], row[half:], out=row[:-half])
            rows.append(row)
        self.least = np.stack(rows)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        one, two = self.places[i], self.places[j]
        low, high = np.minimum(one, two), np.maximum(one, two)
        power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        return np.minimum(self.least[power, low], self.least[power, high - (1 << power) + 1]).astype(np.int64)


def longest_lyndon(ranks: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word from each position: up to the next smaller suffix."""
    n = len(ranks)
    out, waiting = [0] * n, []
    for i, rank in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > rank:
            j = waiting.pop()
            out[j] = i - j
        waiting.append(i)
    for j in waiting:
        out[j] = n - j
    return np.array(out, np.int64)


def runs_of(symbols: np.ndarray, min_words: int = 2, min_repeats: int = 2) -> np.ndarray:
    """All runs of a sequence as sorted rows (start, length, period); ``min_repeats`` is 2 or more."""
    n = len(symbols)
    dense = (np.unique(symbols, return_inverse=True)[1] + 1).tolist()
    tree = SuffixTree(dense)
    depths, places = tree.tour()
    falling = tree.tour(reverse=True)[1]
    right, left = Extension(depths, places), Extension(*SuffixTree(dense[::-1]).tour())
    found = []
    for ranks in (places, falling):
        period = longest_lyndon(ranks[:n].tolist())
        i = np.arange(n)
        j = i + period
        before = left(n - i, n - j)
        length = before + right(i, j) + period
        keep = (length >= np.maximum(min_words, min_repeats * period)) & (length >= 2 * period)
        found.append(np.stack([(i - before)[keep], length[keep], period[keep]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def window_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive symbols, put together from powers of two."""
    power = (symbols.astype(np.uint64) + np.uint64(1)) * STEP
    power ^= power >> np.uint64(29)
    base, width, out, have = STEP | np.uint64(1), 1, None, 0
    while size >> (width.bit_length() - 1):
        if size & width:
            if out is None:
                out = power
            else:
                m = len(symbols) - have - width + 1
                out = out[:m] * base + power[have : have + m]
            have += width
        m = max(len(power) - width, 0)
        power = power[:m] * base + power[width : width + m]
        with np.errstate(over="ignore"):
            base = base * base
        width *= 2
    return out


def stretches(symbols: np.ndarray, min_words: int, min_repeats: int) -> list[tuple[int, int]]:
    """Disjoint stretches (start, end) that together hold every run, each run whole in one of them."""
    n, size = len(symbols), -(-min_words * (min_repeats - 1) // min_repeats)
    if n < min_words:
        return []
    hashes = window_hashes(symbols, size)
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    i, j = order[same], order[same + 1]  # a window and its next occurrence
    limit = np.full(n, n)
    while len(i):
        near = (j - i) * min_repeats <= limit[i]
        i, j = i[near], j[near]
        edge = np.zeros(n + 1, np.int64)
        for at in (i, j):
            np.add.at(edge, at, 1)
            np.add.at(edge, at + size, -1)
        covered = np.cumsum(edge) > 0  # the last entry is False
        change = np.flatnonzero(np.diff(covered, prepend=False))
        parts = list(zip(change[::2].tolist(), change[1::2].tolist()))
        if near.all():
            return [(a, b) for a, b in parts if b - a >= min_words]
        for a, b in parts:
            limit[a:b] = b - a
    return []


class Numbers(dict):
    def __missing__(self, word):
        self[word] = len(self)
        return self[word]


def word_runs(words: list[bytes], min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """The runs of a text's words, by start and then period, as rows (start, length, period)."""
    none = np.empty((0, 3), np.int64)
    if len(words) < min_words:
        return none
    symbols = np.fromiter(map(Numbers().__getitem__, words), np.int64, len(words))
    found = [runs_of(symbols[a:b], min_words, min_repeats) + [a, 0, 0] for a, b in stretches(symbols, min_words, min_repeats)]
    found = np.concatenate(found) if found else none
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that any run repeats from its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


def best_of(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest exact exponent; ties go to the smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():  # by start, then period
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


Words = Callable[[object, list[bytes]], list[bytes]]


def _found(min_words: int, min_repeats: int, names: list[str], change: Words | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().encode().split()
                words = change(doc, words) if change else words
                runs = word_runs(words, min_words, min_repeats)
                best = best_of(runs) or (None,) * 3
                milli = 1000 * best[1] // best[2] if best[2] else None
                rows.append((len(runs), *best, milli, runs.tolist(), b" ".join(collapse(words, runs)).decode()))
            kinds = [*[pa.int64()] * 5, pa.list_(pa.list_(pa.int64())), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return run


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    min_repeats: int = MIN_REPEATS,
    change: Words | None = None,
) -> DataFrame:
    """One row per input row: its id, n_runs, the best run (start, length, period, exponent_milli), ``runs``
    (each [start, length, period]) and ``collapsed``, the kept words joined by one space.

    ``change`` may replace a text's words before they are searched."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = "n_runs long, start long, length long, period long, exponent_milli long, runs array<array<long>>, collapsed string"
    names = ["doc_id", *(c.split()[0] for c in made.split(", "))]
    found = rows.mapInArrow(_found(min_words, min_repeats, names, change), f"doc_id {kind}, {made}")
    return found.withColumnRenamed("doc_id", id_col)


def with_digests(found: DataFrame) -> DataFrame:
    """``runs`` and ``collapsed`` as lowercase hex of sha256; a run is ``start,length,period`` and a line feed."""
    lines = F.transform("runs", lambda r: F.concat(F.array_join(r.cast("array<string>"), ","), F.lit("\n")))
    return found.withColumns(
        {"runs_sha256": F.sha2(F.array_join(lines, ""), 256), "collapsed_sha256": F.sha2("collapsed", 256)}
    ).drop("runs", "collapsed")
