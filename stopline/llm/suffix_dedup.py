"""Repeated byte strings by a distributed merge sort of sampled suffixes that knows common prefixes.

Every string of ``LENGTH`` bytes has an anchor: the position in it whose few bytes hash lowest, the
leftmost of ties. Equal strings have equal anchors, so only suffixes at anchors are sorted, about
one in a hundred. An anchor stands for a run of string starts before it. Such a string is the bytes
from its start to the anchor and the bytes from the anchor to its end, and one of the two parts
has at least half of the bytes; the suffixes are sorted once by what follows the anchor and once,
reversed, by what precedes it, so that this longer part decides the order.

1. Hashes of the anchors' halves are counted; a half that occurs once repeats nowhere. This is the
   duplicate detection that keeps suffixes out of the exchange.
2. Each task sorts its remaining suffixes, merges equal ones and sends each range of the order as a
   front-coded run: the length of the prefix shared with the run's suffix before, and the rest.
3. The runs of a range are merged by a loser tree that compares shared prefix lengths first and
   bytes only from there on, so a known prefix is never compared again.
4. In the merged order, shared prefix lengths bound the suffixes that agree on any number of bytes;
   among them the other parts are refined byte by byte. Starts whose two parts agree with
   another's repeat, and their bytes are removed.

Defined results: a null text is empty. A text shorter than ``LENGTH`` bytes keeps all its bytes.
Strings are judged on the input; overlaps and repeats inside one document count. Rows that repeat an
id and text repeat each other. Long texts are taken in segments that overlap, never cut.
"""

from __future__ import annotations

import hashlib
import os
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import bit_filter, filter_bits, stage, text_of, tidy, with_candidate

LENGTH = 200
HALF = LENGTH // 2
GRAM = 8
SEGMENT = 400_000
HELD_BYTES = 32_000_000
ENTRIES_PER_RANGE = 40_000
MOST_BITS = 27
EDGES_PER_RANGE = 4
BLOCK = 20_000
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SIDES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


# --- anchors ------------------------------------------------------------------------------


class Powers:
    """Powers of the hash base and of its inverse, modulo 2**64, made once per worker."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, BASE)]))
            self.down = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, BASE_INVERSE)]))
        return self.up, self.down


def segments(texts: list[bytes], size: int = SEGMENT) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Joined texts of bounded size, with the number of the text and its offset for each part.

    A long text comes in parts that overlap by all but one byte of a string, so that each of its
    strings lies in exactly one part."""
    parts, numbers, offsets, room = [], [], [], size
    for k, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for start in range(0, len(text) - LENGTH + 1, size):
            part = text[start : start + size + LENGTH - 1]
            parts.append(part)
            numbers.append(k)
            offsets.append(start)
            room -= len(part)
            if room <= 0:
                yield parts, numbers, offsets
                parts, numbers, offsets, room = [], [], [], size
    if parts:
        yield parts, numbers, offsets


def anchors(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes, and per run of starts with one anchor: first start, last start, anchor, part."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts)), sizes)
    n = len(data) - GRAM + 1
    word = np.zeros(n, np.uint64)
    for k in range(GRAM):
        word |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    word *= BASE
    word ^= word >> np.uint64(29)
    word *= SIDES[0]
    low = (word & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    window, width = LENGTH - GRAM + 1, 1
    while 2 * width <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if window > width:
        low = np.minimum(low[: len(low) - (window - width)], low[window - width :])
    starts = np.flatnonzero(owner[: len(low)] == owner[LENGTH - 1 :])
    anchor = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return data, starts[first], starts[last], anchor[first], owner[starts[first]]


def half_keys(data: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray, powers: Powers):
    """Hashes of the half after the anchor and of the half before it; masks of the runs that have them.

    Starts at most half a string before the anchor need the first, all others the second."""
    up, down = powers.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data.astype(np.uint64) * up[: len(data)], out=sums[1:])

    def hashed(at: np.ndarray, size: int, side: np.uint64) -> np.ndarray:
        h = ((sums[at + size] - sums[at]) * down[at] + side) * SIDES[1]
        return h ^ (h >> np.uint64(31))

    after, before = anchor - last <= HALF, anchor - first > HALF
    right, left = np.zeros(len(first), np.uint64), np.zeros(len(first), np.uint64)
    right[after] = hashed(anchor[after], HALF, SIDES[0])
    left[before] = hashed(anchor[before] - HALF - 1, HALF + 1, SIDES[1])
    return (right, after), (left, before)


def route(side: int, primary: bytes) -> bytes:
    """What decides the range of the order a suffix goes to: side and the half that must agree."""
    return b"LR"[1 - side : 2 - side] + primary[:HALF]


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1: hashes of halves with counts, and the half itself for a few hashes to split by."""
    powers = Powers()
    for batch in batches:
        for parts, _, _ in segments([t.encode() for t in batch.column("text").to_pylist()]):
            data, first, last, anchor, _ = anchors(parts)
            raw = data.tobytes()
            for side, (keys, there) in enumerate(half_keys(data, first, last, anchor, powers)):
                found, at, n = np.unique(keys[there], return_index=True, return_counts=True)
                spot = anchor[there][at]
                sample = [None] * len(found)
                for k in np.flatnonzero(found % np.uint64(64) == 0):
                    p = int(spot[k])
                    sample[k] = route(side, raw[p : p + HALF] if side == 0 else raw[p - HALF : p][::-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(n), pa.array(sample, pa.binary())], names=["key", "n", "sample"]
                )


# --- sorted runs --------------------------------------------------------------------------


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be at least ``at``."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    return at + len(os.path.commonprefix([a[at:n], b[at:n]]))


def front_coded(entries: list[tuple[bytes, bytes, list]]) -> list[bytes]:
    """Sorted entries (primary, secondary, origins) as columns: shared lengths and rests."""
    shared, rests, before = [], [], b""
    for primary, _, _ in entries:
        h = common(before, primary)
        shared.append(h)
        rests.append(primary[h:])
        before = primary
    small = lambda values: np.array(values, "<u2").tobytes()
    origins = [o for e in entries for o in e[2]]  # a row and a place in turn
    return [
        small(shared), small([len(r) for r in rests]), b"".join(rests),
        small([len(e[1]) for e in entries]), b"".join(e[1] for e in entries),
        np.array([len(e[2]) // 2 for e in entries], "<u4").tobytes(), np.array(origins, "<i8").tobytes(),
    ]


def decoded(columns: list[bytes]) -> Iterator[tuple[int, bytes, bytes, np.ndarray]]:
    """(shared length with the entry before, primary, secondary, origins) in the run's order."""
    shared, size, second = (np.frombuffer(columns[k], "<u2").tolist() for k in (0, 1, 3))
    count = np.frombuffer(columns[5], "<u4").tolist()
    origins = np.frombuffer(columns[6], "<i8").reshape(-1, 2)
    at = at2 = at3 = 0
    before = b""
    for h, n, m, c in zip(shared, size, second, count):
        before = before[:h] + columns[2][at : at + n]
        yield h, before, columns[4][at2 : at2 + m], origins[at3 : at3 + c]
        at, at2, at3 = at + n, at2 + m, at3 + c


RUN = "part int, " + ", ".join(f"c{k} binary" for k in range(7))


def _runs(filter_words, bits: int, splitters):
    """Step 2: the sorted, front-coded runs of a task, one per range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, edges, powers = filter_words.value, splitters.value, Powers()
        held: dict[tuple[int, bytes, bytes], list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            ranges: dict[int, list] = {}
            for (side, primary, secondary), origins in sorted(held.items()):
                ranges.setdefault(2 * bisect_right(edges, route(side, primary)) + side, []).append((primary, secondary, origins))
            held.clear()
            rows = [(part, *front_coded(entries)) for part, entries in ranges.items()]
            columns = list(zip(*rows)) if rows else [()] * 8
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                names=["part", *[f"c{k}" for k in range(7)]],
            )

        for batch in batches:
            ids = batch.column("rid").to_pylist()
            for parts, numbers, offsets in segments([t.encode() for t in batch.column("text").to_pylist()]):
                data, first, last, anchor, owner = anchors(parts)
                raw = data.tobytes()
                begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                for side, (keys, there) in enumerate(half_keys(data, first, last, anchor, powers)):
                    slot = keys % np.uint64(1 << bits)
                    may = there & ((words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1)
                    for a, b, p, o in zip(*(x[may].tolist() for x in (first, last, anchor, owner))):
                        base = offsets[o] - int(begins[o])
                        if side == 0:
                            primary, secondary = raw[p : b + LENGTH], raw[p - min(p - a, HALF) : p][::-1]
                            origin = p + base
                        else:
                            primary, secondary = raw[a:p][::-1], raw[p : p + LENGTH - max(p - b, HALF + 1)]
                            origin = p - LENGTH + base
                        if len(secondary) < LENGTH - len(primary):
                            continue
                        spots = held.setdefault((side, primary, secondary), [])
                        if not spots:  # two byte strings, their tuple, a dictionary's entry and a list
                            size += len(primary) + len(secondary) + 400
                        spots += (ids[numbers[o]], origin)
                        size += 60
                if size > HELD_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    return run


# --- merge --------------------------------------------------------------------------------


def merged(runs: list[Iterator[tuple]]) -> Iterator[tuple[int, tuple]]:
    """Entries of all runs in order, each with the prefix length it shares with the one before.

    A node of the tree keeps the loser of its match with the prefix it shares with the winner. Of
    two suffixes that share different lengths with the last winner, the one that shares more is
    smaller; only equal lengths call for bytes, and only from that length on."""
    k = len(runs)
    heads = [next(r, None) for r in runs]
    shared = [0] * k
    tree = [-1] * k  # node 0 holds the winner

    def better(x: int, y: int) -> bool:
        """Whether x goes before y; the loser's shared length becomes that with the winner."""
        if heads[y] is None:
            return True
        if heads[x] is None:
            return False
        if shared[x] != shared[y]:
            return shared[x] > shared[y]
        a, b = heads[x][1], heads[y][1]
        h = common(a, b, shared[x])
        first = h == len(a) or (h < len(b) and a[h] < b[h])
        shared[y if first else x] = h
        return first

    def play(leaf: int) -> None:
        node, cur = (leaf + k) // 2, leaf
        while node:
            if tree[node] == -1:  # while the tree is built: wait for the other side
                tree[node] = cur
                return
            if not better(cur, tree[node]):
                cur, tree[node] = tree[node], cur
            node //= 2
        tree[0] = cur

    for leaf in range(k):
        play(leaf)
    if k == 1:
        tree[0] = 0
    while k and heads[tree[0]] is not None:
        w = tree[0]
        yield shared[w], heads[w]
        heads[w] = next(runs[w], None)
        if heads[w] is not None:
            shared[w] = heads[w][0]  # with the run's suffix before, which is the last winner
        if k > 1:
            play(w)


def repeats(shared: np.ndarray, least: np.ndarray, most: np.ndarray, second: np.ndarray, several: np.ndarray) -> np.ndarray:
    """For entries in order: which lengths s of the other part make a repeated string.

    An entry has strings for s from ``least`` to ``most``: the first LENGTH - s bytes of its primary
    and the first s of its secondary. ``several`` entries stand for more than one place."""
    n, top = len(shared), int(most.max(initial=0))
    out = np.zeros((n, HALF + 1), bool)
    kind = np.zeros(n, np.int64)
    for s in range(top + 1):
        if s:
            _, kind = np.unique(kind * 257 + second[:, s - 1], return_inverse=True)
        have = np.flatnonzero((least <= s) & (s <= most))
        if not len(have):
            continue
        group = np.cumsum(shared < LENGTH - s)
        key = group[have] * n + kind[have]
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        out[have, s] = (count[inverse] > 1) | several[have]
    return out


SPAN = "rid long, a long, b long"


def _resolved(entries: list[tuple], side: int) -> pa.Table:
    """Removed byte ranges of every place in a block of merged entries."""
    shared = np.array([h for h, _ in entries])
    several = np.array([len(e[3]) > 1 for _, e in entries])
    # an entry whose half no neighbour shares, and which stands for one place, repeats nothing
    near = shared >= HALF
    use = several | near | np.append(near[1:], False)
    if not use.any():
        return pa.table({c: pa.array([], pa.int64()) for c in ("rid", "a", "b")})
    # a skipped entry shares less than half with both sides, so its successor keeps its own border
    kept = [e for (_, e), u in zip(entries, use) if u]
    shared, several = shared[use], several[use]
    least = LENGTH - np.array([len(e[1]) for e in kept])
    most = np.array([len(e[2]) for e in kept])
    second = np.zeros((len(kept), HALF), np.int64)
    for k, e in enumerate(kept):
        second[k, : most[k]] = np.frombuffer(e[2], np.uint8).astype(np.int64) + 1
    found = np.zeros((len(kept), HALF + 3), np.int8)
    found[:, 1:-1] = repeats(shared, least, most, second, several)
    step = np.diff(found, axis=1)
    row, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)
    high = high - 1
    places = [kept[r][3] for r in row.tolist()]
    counts = np.fromiter(map(len, places), np.int64, len(places))
    spots = np.concatenate(places) if places else np.zeros((0, 2), np.int64)
    low, high, origin = np.repeat(low, counts), np.repeat(high, counts), spots[:, 1]
    a, b = (origin - high, origin - low + LENGTH) if side == 0 else (origin + low, origin + high + LENGTH)
    return pa.table({"rid": pa.array(spots[:, 0]), "a": pa.array(a), "b": pa.array(b)})


def _merge(table: pa.Table) -> pa.Table:
    """Steps 3 and 4 for one range: merge its runs, resolve block by block of whole groups."""
    side = table.column("part")[0].as_py() % 2
    columns = [table.column(f"c{k}").to_pylist() for k in range(7)]
    block, out = [], []
    for shared, entry in merged([decoded(list(c)) for c in zip(*columns)]):
        if shared < HALF and len(block) >= BLOCK:
            out.append(_resolved(block, side))
            block = []
        block.append((shared, entry))
    out.append(_resolved(block, side))
    return pa.concat_tables(out)


# --- documents ----------------------------------------------------------------------------


def _filter_array(keys: DataFrame, bits: int) -> np.ndarray:
    words = np.zeros(max(1, 1 << bits >> 6), np.int64)
    table = bit_filter(keys, "key", bits).toArrow()
    words[table.column("word").to_numpy()] = table.column("mask").to_numpy()
    return words.view(np.uint64)


def repeated_spans(rows: DataFrame, bits: int | None = None, entries_per_range: int = ENTRIES_PER_RANGE) -> DataFrame:
    """(rid, a, b): byte ranges to remove, overlapping, from rows (rid, text).

    The order is split into ranges of like size, as many as the counted halves ask for; the driver sees
    about four halves of 100 bytes for each range of 40,000 suffixes."""
    spark = rows.sparkSession
    halves = rows.select("text").mapInArrow(_halves, "key long, n long, sample binary")
    counted = halves.groupBy("key").agg(F.sum("n").alias("n"), F.min("sample").alias("sample"))
    counted = stage(counted.filter("n > 1"), "suffix-halves")
    size = counted.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("n"), F.count("sample").alias("samples")).first()
    if not size["keys"]:
        return spark.createDataFrame([], SPAN)
    bits = bits or filter_bits(size["keys"], most=MOST_BITS)
    words = _filter_array(counted.select("key"), bits)
    ranges = -(-size.n // entries_per_range)
    every = max(1, size.samples // (EDGES_PER_RANGE * ranges))
    sample = counted.filter(F.col("sample").isNotNull() & (F.pmod(F.xxhash64("key"), F.lit(every)) == 0)).select("sample").collect()
    sample = sorted(bytes(r.sample) for r in sample)
    ranges = min(len(sample) + 1, ranges)
    edges = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []
    runs = rows.select("rid", "text").mapInArrow(
        _runs(spark.sparkContext.broadcast(words), bits, spark.sparkContext.broadcast(edges)), RUN
    )
    return runs.groupBy("part").applyInArrow(_merge, SPAN)


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, count, digest, size, kept = [], [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data, done, parts = text.encode(), 0, []
                spans = union([(s["a"], s["b"]) for s in spans or ()])
                for a, b in spans:
                    parts.append(data[done:a])
                    done = b
                rest = b"".join([*parts, data[done:]])
                size.append(len(data))
                removed.append(len(data) - len(rest))
                count.append(len(spans))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(size, pa.int64())]
            names = ["doc_id", "n_removed", "n_spans", "kept_sha256", "n_bytes"]
            if keep_text:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    return run


@tidy
def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_removed, n_spans, kept_sha256, n_bytes; with ``keep_text`` also the kept bytes."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), F.xxhash64(id_col, text_of(text_col)).alias("rid")
    )
    spans = stage(repeated_spans(rows).distinct(), "suffix-spans")
    each = stage(spans.groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "suffix-documents")
    bits = filter_bits(each.count())
    words = stage(bit_filter(each.select("rid"), "rid", bits), "suffix-docs")
    marked = with_candidate(rows, "rid", words, bits, "may")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_removed long, n_spans long, kept_sha256 string, n_bytes long" + ", kept binary" * keep_text
    touched = marked.filter("may").join(each, "rid", "left").select("doc_id", "text", "spans").mapInArrow(_cut(keep_text), schema)
    whole = marked.filter("not may").select(
        "doc_id", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), F.octet_length("text").cast("long").alias("n_bytes"), *([F.encode("text", "UTF-8").alias("kept")] if keep_text else []),
    )
    return touched.unionByName(whole)
