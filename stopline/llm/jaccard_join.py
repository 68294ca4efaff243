"""Exact n-gram Jaccard join with signature trees, as components of linked documents.

Two sets whose Jaccard similarity reaches the threshold share a shingle among the first few of each
in any common order, so documents meet only in buckets of such shingles. The order puts frequent
shingles last, by a count table of fixed size, which keeps buckets small. Documents with equal
sets are one representative from the start.

Inside a bucket, members form a signature tree: a node holds the bitwise or of its members' token
bitmaps and their range of set sizes. Two nodes are traversed together and dropped as soon as the
most their members could overlap is below the least that the threshold needs. Members of pairs that
are left meet again in the same bucket with their whole sets and are verified there, so that pairs,
whose number grows with the square of a group, are never rows; only links that join components are.

Large groups of near copies are collapsed first: each representative is verified against the pivots
of a few of its buckets, and linked ones become one component. Then only buckets
that still hold several components are searched in full, in blocks, and only pairs across
components count: no link can be lost, and no group is expanded into its pairs.

Defined results: a null text, or one without words, has an empty set and links with nothing. A text
with fewer words than a shingle has one shingle, its whole sequence. Rows that repeat an id count
as documents with that id. Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import bit_filter, filter_bits, lean, salted_join, stage, text_of, tidy, with_candidate
from stopline.llm.vocabulary import Bounded

SHINGLE = 4
PERCENT = 85
LEAST_PERCENT = 50
SLOT_BITS = 20
SLOT_BLOCK = 4096
STAR_ROUNDS = 3
BLOCK = 256
MINI = 16
MINI_SHARED = 8
LEAF = 8
SHARPER = 8
FIRST_UNITS = 32
SPOKES = 64
WANTED_BITS = 64
HOT = "key long, i int, j int, sig long, comp long, at int"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
FINAL = np.uint64(0xD6E8FEB86659FD93)


# --- sets ---------------------------------------------------------------------------------


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles; word hashes are remembered."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.words = Bounded(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        n = min(self.size, len(words))
        out = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            out = out * MULTIPLIER + h[k : k + len(out)]
            out ^= out >> np.uint64(32)
        out *= FINAL
        return np.unique(out ^ (out >> np.uint64(29)))


def signature(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def needed(n: int, percent: int = PERCENT) -> int:
    """The least overlap a set of n needs with any set it links with."""
    return -(-percent * n // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


# --- order of shingles --------------------------------------------------------------------


def _counted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingles(size), np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                np.add.at(counts, (shingles(text) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
        blocks = [(k, counts[k * SLOT_BLOCK : (k + 1) * SLOT_BLOCK]) for k in range(len(counts) // SLOT_BLOCK)]
        some = [(k, c.astype("<i4").tobytes()) for k, c in blocks if c.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in some], pa.int32()), pa.array([c for _, c in some], pa.binary())], names=["block", "counts"]
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, "<i4").astype(np.int64) for c in table.column("counts").to_pylist())
    total = np.minimum(total, 2**31 - 1).astype("<i4")
    return pa.table({"block": table.column("block").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def frequency_classes(texts: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Per slot of the hash space how far above the mean its count is, in powers of two: 1 MB."""
    kind = "block int, counts binary"
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for r in texts.mapInArrow(lean(_counted(size)), kind).groupBy("block").applyInArrow(_added, kind).toLocalIterator():
        counts[r.block * SLOT_BLOCK : (r.block + 1) * SLOT_BLOCK] = np.frombuffer(r.counts, "<i4")
    # a few documents of chance in one slot are not a frequent shingle
    scale = counts.mean() + 8 * np.sqrt(counts.mean()) + 8
    return np.floor(np.log2(np.maximum(counts / scale, 1))).astype(np.uint8)


def prefix(tokens: np.ndarray, classes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first tokens in the common order, one of which any linked set shares."""
    if not len(tokens):
        return tokens
    order = np.lexsort((tokens, classes[(tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]))
    return tokens[order[: len(tokens) - needed(len(tokens), percent) + 1]]


def _described(shared, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, classes = Shingles(size), shared.value
        for batch in batches:
            n, sig, keys, mini, maps = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingles(text)
                n.append(len(tokens))
                sig.append(signature(tokens))
                keys.append(prefix(tokens, classes, percent).view(np.int64))
                mini.append(tokens[:MINI].view(np.int64))
                maps.append(bitmap(tokens, width_for(len(tokens))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(mini, pa.list_(pa.int64())), pa.array(maps, pa.binary())],
                names=["doc_id", "n", "sig", "keys", "mini", "map"],
            )

    return run


# --- signature trees ----------------------------------------------------------------------


def bitmap(tokens: np.ndarray, width: int) -> bytes:
    """One bit for each token, ``width`` bits (a power of two); tokens that share a bit count as hidden."""
    bits = np.zeros(width, bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def width_for(n: int) -> int:
    """Four to eight bits for each token of small sets, one to two from 1,024 tokens on, up to 4 KB."""
    return 1 << min(15, max(6, min((4 * n).bit_length(), 10), n.bit_length()))


def folded(bits: int, width: int, to: int) -> int:
    while width > to:
        width //= 2
        bits = (bits >> width) | (bits & ((1 << width) - 1))
    return bits


class Node:
    """Members or children, the or of their bitmaps, their sizes, and the most tokens without a bit of their own."""

    __slots__ = ("below", "bits", "least", "most", "hidden", "member")

    def __init__(self, below, bits, least, most, hidden, member=None):
        self.below, self.bits, self.least, self.most, self.hidden, self.member = below, bits, least, most, hidden, member


def tree(members: list[tuple], width: int) -> Node | None:
    """A signature tree over (sig, comp, n, bits of ``width``); members of like size stand together."""
    level = [Node((), b, n, n, n - b.bit_count(), (s, c)) for s, c, n, b in sorted(members, key=lambda m: (m[2], m[0]))]
    while len(level) > 1:
        up = []
        for k in range(0, len(level), LEAF):
            group = level[k : k + LEAF]
            bits = 0
            for g in group:
                bits |= g.bits
            up.append(Node(tuple(group), bits, min(g.least for g in group), max(g.most for g in group), max(g.hidden for g in group)))
        level = up
    return level[0] if level else None


def possible(a: Node, b: Node, percent: int) -> bool:
    """Whether a member of a and one of b could link, by sizes and by the most they could overlap.

    Tokens in both sets have their bits in both maps; beyond the common bits, at most those tokens
    of a set that have no bit of their own."""
    if 100 * a.most < percent * b.least or 100 * b.most < percent * a.least:
        return False
    overlap = (a.bits & b.bits).bit_count() + min(a.hidden, b.hidden)
    return (100 + percent) * overlap >= percent * (a.least + b.least)


def candidates(a: Node, b: Node, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Pairs of members of different components that survive the dual traversal, smaller id first."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if x is y:
            stack += [(x.below[i], x.below[j]) for i in range(len(x.below)) for j in range(i, len(x.below))]
        elif possible(x, y, percent):
            if x.member and y.member:
                if x.member[1] != y.member[1]:
                    yield min(x.member[0], y.member[0]), max(x.member[0], y.member[0])
            elif y.member or (x.below and len(x.below) >= len(y.below)):
                stack += [(z, y) for z in x.below]
            else:
                stack += [(x, z) for z in y.below]


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each (key, i, j) unit; they come sorted by unit."""
    unit: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if unit and unit[0][:3] != row[:3]:
                yield unit
                unit = []
            unit.append(row)
    if unit:
        yield unit


def _pairs_of(rows: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """Candidate pairs of one unit's rows (key, i, j, sig, comp, n, at, map).

    Sets that may link differ little in size, so their widths are equal or one step apart."""

    def by_width(rows: list[tuple]) -> dict[int, list[tuple]]:
        out: dict[int, list[tuple]] = {}
        for r in rows:
            out.setdefault(8 * len(r[7]), []).append((r[3], r[4], r[5], int.from_bytes(r[7], "little")))
        return out

    i, j = rows[0][1], rows[0][2]
    one, two = by_width([r for r in rows if r[6] == i]), by_width([r for r in rows if r[6] == j])
    for w in one:
        for v in (w // 2, w, 2 * w):
            if v not in two or (i == j and v < w):
                continue
            width = min(w, v)
            x = tree([(*m[:3], folded(m[3], w, width)) for m in one[w]], width)
            y = x if i == j and v == w else tree([(*m[:3], folded(m[3], v, width)) for m in two[v]], width)
            yield from candidates(x, y, percent)


def _members(choose):
    """The members that ``choose`` names in each (key, i, j) unit: never more rows than came in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 6
            out.clear()
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=["key", "i", "j", "sig", "comp", "at"])

        for unit in _by_unit(batches):
            named = choose(unit)
            out += [(*r[:5], r[6]) for r in unit if r[3] in named]
            if len(out) > 100_000:
                yield batch()
        yield batch()

    return run


def _searched(percent: int):
    """The members of each unit that are in a candidate pair there."""
    return _members(lambda unit: {s for pair in _pairs_of(unit, percent) for s in pair})


def _first_met(percent: int):
    """The members of each unit in a candidate pair that no earlier unit is known to compare.

    Rows end with the unit's number and the member's first units, told with their sides: two members
    meet in a unit of one block, or from different sides. A pair's first unit always keeps it."""

    def choose(unit: list[tuple]) -> set[int]:
        here = unit[0][8] >> 2
        units = {r[3]: {u >> 2: u & 3 for u in r[9] if u >> 2 < here} for r in unit}
        named: set[int] = set()
        for a, b in _pairs_of(unit, percent):
            if a in named and b in named:
                continue
            x, y = units[a], units[b]
            if not any(u in y and (side & 1 or side != y[u]) for u, side in x.items()):
                named |= {a, b}
        return named

    return _members(choose)


def _joined(percent: int):
    """Links (a, b) of rows (key, i, j, sig, comp, at, tokens), verified on the whole sets inside each unit.

    Only a link between components that no earlier link of the unit joins is handed on, so a unit of m
    members has fewer than m."""

    def links_of(unit: list[tuple]) -> Iterator[tuple[int, int]]:
        sets = {r[3]: np.frombuffer(r[6], np.uint64) for r in unit}
        comp, root = {r[3]: r[4] for r in unit}, {r[4]: r[4] for r in unit}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        sharp = lambda t: bitmap(t, SHARPER * width_for(len(t)))
        rows = [(*r[:5], len(sets[r[3]]), r[5], sharp(sets[r[3]])) for r in unit]
        for a, b in _pairs_of(rows, percent):
            x, y = find(comp[a]), find(comp[b])
            if x != y and linked(sets[a], sets[b], percent):
                root[x] = y
                yield a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _by_unit(batches):
            if links := list(links_of(unit)):
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


# --- verification and components ----------------------------------------------------------


def _sets(size: int):
    """Whole sets of documents by signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            rows = {signature(t): t.tobytes() for t in map(shingles, batch.column("text").to_pylist())}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.binary())], names=["sig", "tokens"]
            )

    return run


def both_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig")))


def whole_sets(rows: DataFrame, ids: DataFrame, sigs: DataFrame, size: int) -> DataFrame:
    """(sig, tokens) of the signatures: one document of each is read again."""
    wanted = stage(sigs.select("sig").distinct().join(ids, "sig").select("sig", F.xxhash64("first_id").alias("key")), "join-wanted")
    bits = filter_bits(wanted.count(), WANTED_BITS)  # a text let through in vain sends its whole set
    words = stage(bit_filter(wanted, "key", bits), "join-wanted-filter")
    few = with_candidate(rows.withColumn("key", F.xxhash64("doc_id")), "key", words, bits, "may").filter("may").select("text")
    found = few.mapInArrow(lean(_sets(size)), "sig long, tokens binary").join(wanted.select("sig"), "sig", "left_semi")
    return found.groupBy("sig").agg(F.first("tokens").alias("tokens"))


def _spokes(percent: int):
    """Links (a, b) of rows (hub, part, leaf, sig, tokens): in each part of a hub its own set comes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivot = None, None
        for batch in batches:
            links = []
            for hub, part, leaf, sig, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = np.frombuffer(tokens, np.uint64)
                if not leaf:
                    at, pivot = (hub, part), tokens
                elif at == (hub, part) and linked(tokens, pivot, percent):
                    links.append((sig, hub))
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of signatures and pivots whose whole sets link.

    A pivot's set is sent once for some ``SPOKES`` of its pairs, however many it has, and meets theirs there."""
    parts = pairs.groupBy(F.col("b").alias("hub")).agg(F.ceil(F.count(F.lit(1)) / SPOKES).cast("int").alias("parts"))
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    hubs = parts.select("hub", part.alias("part"), F.lit(0).alias("leaf"), F.col("hub").alias("sig"))
    leaves = pairs.withColumnsRenamed({"a": "sig", "b": "hub"}).join(parts, "hub")
    leaves = leaves.select("hub", F.pmod(F.xxhash64("sig"), "parts").cast("int").alias("part"), F.lit(1).alias("leaf"), "sig")
    rows = stage(hubs.union(leaves), "join-spokes")
    filled = salted_join(rows, sets, "sig").select("hub", "part", "leaf", "sig", "tokens")
    units = filled.repartition("hub", "part").sortWithinPartitions("hub", "part", "leaf")
    return units.mapInArrow(lean(_spokes(percent)), "a long, b long")


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over (a, b) edges; labels spread and then jump.

    Nodes with many neighbours, and labels that many nodes carry, are dealt out in slices."""
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "join-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "join-labels")
    while True:
        near = salted_join(both, labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("label").alias("near"))
        spread = labels.join(near, "node").select("node", F.least("label", "near").alias("next"), F.col("label").alias("old"))
        spread = stage(spread, "join-spread")
        jump = spread.select(F.col("node").alias("next"), F.col("next").alias("far"))
        far = F.least("next", F.coalesce("far", "next")).alias("label")
        new = stage(salted_join(spread, jump, "next", "left").select("node", far, "old"), "join-labels")
        if new.filter("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after the links (a, b) of signatures are added."""
    of = lambda name: comps.select(F.col("sig").alias(name), F.col("comp").alias(f"{name}c"))
    edges = links.join(of("a"), "a").join(of("b"), "b").filter("ac <> bc").select(F.col("ac").alias("a"), F.col("bc").alias("b"))
    edges = stage(edges.distinct(), "join-links")
    if edges.isEmpty():
        return comps
    found = smallest_reachable(edges)
    joined = comps.join(found.select(F.col("node").alias("comp"), "label"), "comp", "left")
    return stage(joined.select("sig", F.coalesce("label", "comp").alias("comp")), "join-comps")


def _several(rows: DataFrame) -> DataFrame:
    """(key, sig, comp, m) of the buckets that hold more than one component.

    Of buckets with the same members, told by their number and two 64-bit hashes, one is enough."""
    marks = [F.bit_xor(F.xxhash64("sig", F.lit(k))).alias(f"mark{k}") for k in range(2)]
    buckets = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"), *marks)
    once = buckets.filter("lo <> hi").groupBy("m", "mark0", "mark1").agg(F.min("key").alias("key"))
    return rows.join(once.select("key", "m"), "key")


def _open(members: DataFrame, comps: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The open buckets, split into bands of like set size.

    Sizes of linked sets lie in the same or in adjacent classes; a band holds two adjacent ones."""
    rows = stage(_several(members.join(comps, "sig")).drop("m"), "join-open")
    width = math.log(100 / percent) + 1e-6
    of_size = F.floor(F.log("n") / width)
    banded = rows.join(sketches.select("sig", of_size.alias("class")), "sig")
    banded = banded.withColumn("band", F.explode(F.array(F.col("class"), F.col("class") + 1)))
    return _several(banded.select(F.xxhash64("key", "band").alias("key"), "sig", "comp"))


def _stars(members: DataFrame, sketches: DataFrame, turns: int, percent: int) -> DataFrame:
    """Each representative with the pivots of a few of its buckets, one each turn.

    The pivot is the member that shares the largest part of its own keys with others: a copy with few
    changes of its own, which is close to more of the group than one picked at random. Only pairs that are likely to link, by size and by their smallest hashes, are worth verifying
    here; the full search that follows misses nothing."""
    by_sig = members.repartition("sig")  # sent once for both uses
    some = [F.min_by("key", F.xxhash64("key", F.lit(k))) for k in range(1, turns + 1)]
    each = by_sig.groupBy("sig").agg(F.array_distinct(F.array(*some)).alias("some"), F.count(F.lit(1)).alias("shared"))
    each = each.join(sketches.select("sig", "n", "keys"), "sig")
    one = each.select(F.col("sig").alias("a"), F.col("n").alias("an"), F.explode("some").alias("key"))
    part = each.select("sig", "n", (F.col("shared") / F.col("keys")).alias("part"))
    pivot = by_sig.join(part, "sig").groupBy("key").agg(F.max(F.struct("part", "sig", "n")).alias("top"))
    met = one.join(pivot.select("key", F.col("top.sig").alias("b"), F.col("top.n").alias("bn")), "key")
    size = F.least("an", "bn") * 100 >= F.greatest("an", "bn") * percent
    pairs = met.filter((F.col("a") != F.col("b")) & size).select("a", "b").distinct()
    of = lambda c: sketches.select(F.col("sig").alias(c), F.col("mini").alias(f"{c}m"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    near = F.size(F.array_intersect("am", "bm")) >= F.least(F.lit(MINI_SHARED), F.size("am"), F.size("bm"))
    return both.filter(near).select("a", "b")


def _units(rows: DataFrame, sketches: DataFrame, block: int) -> DataFrame:
    """Open buckets in blocks; each pair of blocks of a bucket is one unit of work."""
    blocks = F.ceil(F.col("m") / block).cast("int")
    placed = rows.withColumn("blocks", blocks).withColumn("at", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    meets = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = meets.select("key", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), "sig", "comp", "at")
    joined = units.join(sketches.select("sig", "n", "map"), "sig").select("key", "i", "j", "sig", "comp", "n", "at", "map")
    return joined.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _once(hot: DataFrame) -> DataFrame:
    """The members of units; of units that would compare the same members, told by their number and two
    64-bit hashes, one is enough."""
    same = [F.col("at") == F.col("i"), F.col("i") == F.col("j")]
    marks = [F.bit_xor(F.xxhash64("sig", *same, F.lit(k))).alias(f"mark{k}") for k in range(2)]
    units = hot.groupBy("key", "i", "j").agg(F.count(F.lit(1)).alias("m"), *marks)
    once = units.groupBy("m", "mark0", "mark1").agg(F.min(F.struct("key", "i", "j")).alias("unit"))
    return hot.join(once.select("unit.*"), ["key", "i", "j"])


def _first_units(hot: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The members of units, where a pair that meets in several units needs to be compared.

    A member's first units are enough to know; beyond those a pair may be compared more than once."""
    side = F.when(F.col("i") == F.col("j"), 1).otherwise(0) + F.when(F.col("at") == F.col("i"), 2).otherwise(0)
    told = hot.withColumn("unit", F.xxhash64("key", "i", "j").bitwiseAND(F.lit(-4)) + side)
    units = told.groupBy("sig").agg(F.slice(F.sort_array(F.collect_set("unit")), 1, FIRST_UNITS).alias("units"))
    rows = told.join(units, "sig").join(sketches.select("sig", "n", "map"), "sig")
    rows = rows.select("key", "i", "j", "sig", "comp", "n", "at", "map", "unit", "units")
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(lean(_first_met(percent)), HOT)


def unit_links(hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of the units' members, found on their whole sets."""
    filled = salted_join(hot, sets, "sig").select("key", "i", "j", "sig", "comp", "at", "tokens")
    units = filled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return units.mapInArrow(lean(_joined(percent)), "a long, b long")


def _one_of_each(filled: DataFrame, ids: DataFrame) -> DataFrame:
    """(sig, n, keys, mini, map), one row for each set; only rows whose set may have come more than once are sent."""
    copied = ids.filter("docs > 1").select("sig")
    bits = filter_bits(copied.count())
    words = stage(bit_filter(copied, "sig", bits), "join-copied-filter")
    of_set = ["n", "keys", "mini", "map"]
    marked = with_candidate(filled.select("sig", *of_set), "sig", words, bits, "may")
    some = marked.filter("may").groupBy("sig").agg(*[F.first(c).alias(c) for c in of_set])
    return marked.filter("NOT may").select("sig", *of_set).union(stage(some, "join-copied"))


@tidy
def components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    size: int = SHINGLE,
    star_rounds: int = STAR_ROUNDS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100: below, sets of very unlike sizes can link")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    classes = spark.sparkContext.broadcast(frequency_classes(rows.select("text"), size))
    described = rows.mapInArrow(
        lean(_described(classes, size, percent)),
        f"doc_id {kind}, n long, sig long, keys array<long>, mini array<long>, map binary",
    )
    described = stage(described, "join-docs")
    filled = described.filter("n > 0")
    ids = filled.groupBy("sig").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("docs"))
    ids = stage(ids, "join-ids")
    each = _one_of_each(filled, ids)
    postings = each.select("sig", F.explode("keys").alias("key"))
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
    shared = stage(shared, "join-keys")
    bits = filter_bits(shared.count())
    words = stage(bit_filter(shared, "key", bits), "join-filter")
    may = with_candidate(postings, "key", words, bits, "may").filter("may").select("sig", "key")
    members = stage(may.join(shared, "key"), "join-members")
    sketches = stage(each.select("sig", "n", "mini", "map", F.size("keys").alias("keys")), "join-sketches")

    comps = stage(members.select("sig").distinct().withColumn("comp", F.col("sig")), "join-comps")
    if star_rounds:
        pairs = stage(_stars(members, sketches, star_rounds, percent), "join-pairs")
        comps = _merged(comps, star_links(pairs, whole_sets(rows, ids, both_of(pairs), size), percent))
    searched = _units(_open(members, comps, sketches, percent), sketches, block).mapInArrow(lean(_searched(percent)), HOT)
    hot = stage(_once(stage(searched, "join-searched")), "join-hot")
    hot = stage(_first_units(hot, sketches, percent), "join-first")
    comps = _merged(comps, unit_links(hot, whole_sets(rows, ids, hot, size), percent))

    rooted = ids.join(comps, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    smallest = rooted.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    by_sig = rooted.join(smallest, "comp").select("sig", "component_id")
    out = described.select("doc_id", "n", F.when(F.col("n") > 0, F.col("sig")).alias("sig")).join(by_sig, "sig", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_first(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows whose id is the smallest of their component. ``found`` comes from ``components``."""
    others = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(others, id_col, "left_anti").select(*[docs[c] for c in docs.columns])
