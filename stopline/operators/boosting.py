"""Gradient boosting over binned features, one aggregated histogram table per tree level.

Every feature is binned once: at most 255 bins of known values, cut by exact cumulative counts, and
a bin of its own for missing values. Rows with equal bins always get equal scores, so they become
one weighted cell by a map-side combined count; all rounds run on cells, kept in packed blocks. At
each level of a tree every block adds up gradients, curvatures and counts by (node, feature, bin), the
tables are summed by node, and the driver sees one table of bounded size per open node. It picks the
best cut of each and whether missing values go left or right, by gain alone. Trees use logistic loss.

Ties go to the smaller feature, then the lower cut, then missing values to the right. A node
without missing rows sends later ones to its larger side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.operators import prefix
from stopline.sources import tables as tb

BINS = 255
MISSING_BIN = 255
WIDTH = 256
BLOCK_CELLS = 60_000
TASKS_PER_CORE = 2
DIRECT_BYTES = 16_000_000
LEAST_CURVATURE = 1e-3
BLOCK = "bins binary, n binary, hits binary, raw binary"


# --- bins ---------------------------------------------------------------------------------


def value_counts(rows: DataFrame, features: list[str]) -> DataFrame:
    """Rows per (feature, known value), with the rows at smaller values (``n_before``)."""
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    long = rows.select(F.inline(values)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return prefix.cumulative_counts(long, "value", prefix.score_buckets("value", bits=(-12, 0, 10, 20)), ["feature"])


def bin_edges(counts: DataFrame, bins: int = BINS) -> dict[str, list[float]]:
    """Per feature the values from which a new bin starts, halfway between neighbouring known values.

    Few distinct values get a bin each; more are cut at equal shares of the rows. The driver sees at
    most ``bins`` rows of each feature."""
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("values"))
    share = F.floor(F.col("n_before") * bins / F.col("total"))
    joined = counts.join(F.broadcast(totals), "feature")  # one row per feature
    cut = F.when(F.col("values") <= bins, F.col("value")).otherwise(share.cast("double"))
    ranges = joined.groupBy("feature", cut.alias("bin")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    found: dict[str, list[tuple[float, float]]] = {}
    for r in ranges.collect():
        found.setdefault(r["feature"], []).append((r["low"], r["high"]))
    return {
        feature: [(a + b) / 2 for (_, a), (b, _) in zip(sorted(pairs), sorted(pairs)[1:])] for feature, pairs in found.items()
    }


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin numbers of doubles; nan is the missing bin."""
    out = np.searchsorted(edges, values, side="right").astype(np.uint8)
    out[np.isnan(values)] = MISSING_BIN
    return out


def _doubles(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names]


def cells(rows: DataFrame, features: list[str], edges: dict[str, list[float]], target: Column) -> DataFrame:
    """(key, n, hits): rows with the same bins, counted with their positives."""
    cuts = [np.array(edges.get(c, ())) for c in features]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.zeros(batch.num_rows, np.int64)
            for k, (values, cut) in enumerate(zip(_doubles(batch, features), cuts)):
                key |= binned(values, cut).astype(np.int64) << (8 * k)
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("_y")], names=["key", "y"])

    doubles = rows.select(*[F.col(c).cast("double").alias(c) for c in features], target.cast("int").alias("_y"))
    keyed = doubles.mapInArrow(run, "key long, y int")
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))


def block_tasks(cells: int, block_cells: int, cores: int) -> int:
    """Tasks that hold the blocks: one for each ``block_cells``, but a few for each core at most."""
    return min(-(-cells // block_cells), TASKS_PER_CORE * max(cores, 1))


def _packed(width: int, start: float, size: int):
    """Cells of a task as blocks of packed arrays."""

    def block(parts: list[tuple]) -> pa.RecordBatch:
        key, n, hits = (np.concatenate(c) for c in zip(*parts))
        bins = np.stack([(key >> (8 * k)) & 255 for k in range(width)]).astype(np.uint8)
        values = [bins, n.astype(np.int64), hits.astype(np.int64), np.full(len(key), start)]
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], names=["bins", "n", "hits", "raw"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            parts.append(tuple(c.to_numpy() for c in batch.columns))
            held += batch.num_rows
            if held >= size:
                yield block(parts)
                parts, held = [], 0
        if held:
            yield block(parts)

    return run


# --- trees --------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in the order they were made; a leaf has feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        made = len(self.feature), len(self.feature) + 1
        self.left[node], self.right[node] = made
        for v in values:
            for column, empty in zip((self.feature, self.cut, self.missing_left, self.left, self.right, self.value), (-1, 0, False, 0, 0, v)):
                column.append(empty)
        return made

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every column of ``bins`` (features x cells)."""
        feature, cut, missing_left, left, right = map(np.array, (self.feature, self.cut, self.missing_left, self.left, self.right))
        node, every = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        open_ = np.full(len(every), feature[0] >= 0)
        while open_.any():
            at = every[open_] if not open_.all() else every
            here = node[at]
            b = bins[feature[here], at]
            go = np.where(b == MISSING_BIN, missing_left[here], b <= cut[here])
            node[at] = np.where(go, left[here], right[here])
            open_ = feature[node] >= 0
        return node

    def add_to(self, raw: np.ndarray, bins: np.ndarray) -> None:
        raw += np.array(self.value)[self.leaves(bins)]


def sigmoid(raw: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * raw))


def unpacked(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = np.frombuffer(row["n"], np.int64)
    bins = np.frombuffer(row["bins"], np.uint8).reshape(width, len(n))
    return bins, n, np.frombuffer(row["hits"], np.int64), np.frombuffer(row["raw"], np.float64).copy()


def histograms(bins: np.ndarray, n: np.ndarray, hits: np.ndarray, raw: np.ndarray, slot: np.ndarray, nodes: int) -> np.ndarray:
    """(node, feature, bin, 3): sums of gradient, curvature and rows; ``slot`` -1 is in no open node."""
    use = slice(None) if (slot >= 0).all() else slot >= 0
    p = sigmoid(raw[use])
    weights = (n[use] * p - hits[use], n[use] * p * (1 - p), n[use].astype(np.float64))
    base = slot[use] * WIDTH
    out = np.zeros((nodes, len(bins), WIDTH, 3))
    for k in range(len(bins)):
        at = base + bins[k][use]
        for w, weight in enumerate(weights):
            out[:, k, :, w] = np.bincount(at, weight, nodes * WIDTH).reshape(nodes, WIDTH)
    return out


def _level(width: int, done: list[Tree], tree: Tree, open_nodes: list[int]):
    """Summed histograms of a task's blocks, one row per open node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        slot_of = np.full(len(tree.feature), -1)
        slot_of[open_nodes] = np.arange(len(open_nodes))
        for batch in batches:
            for row in batch.to_pylist():
                bins, n, hits, raw = unpacked(row, width)
                for t in done:
                    t.add_to(raw, bins)
                table = histograms(bins, n, hits, raw, slot_of[tree.leaves(bins)], len(open_nodes))
                total = table if total is None else total + table
        if total is not None:
            columns = [pa.array(open_nodes, pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "table"])

    return run


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(t, np.float64) for t in table.column("table").to_pylist())
    return pa.table({"node": table.column("node").slice(0, 1), "table": pa.array([total.tobytes()], pa.binary())})


@dataclass
class Cut:
    gain: float
    feature: int
    cut: int
    missing_left: bool
    values: tuple[float, float]


def best_cut(table: np.ndarray, step: float, least_rows: int) -> Cut | None:
    """The cut of one node's (feature, bin, 3) table with the largest gain."""
    known, missing = table[:, :MISSING_BIN], table[:, None, MISSING_BIN]
    below = np.cumsum(known, axis=1)
    everything = table[0].sum(axis=0)
    has_missing = missing[:, :, 2] > 0
    best = None
    for missing_left in (False, True):
        left = below + missing if missing_left else below
        right = everything - left
        # counts are whole numbers in doubles; what is left of nothing may be off by rounding
        good = (left[..., 2] >= least_rows) & (right[..., 2] >= least_rows)
        good &= (left[..., 1] >= LEAST_CURVATURE) & (right[..., 1] >= LEAST_CURVATURE)
        if missing_left:
            good &= has_missing
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[..., 0] ** 2 / left[..., 1] + right[..., 0] ** 2 / right[..., 1] - everything[0] ** 2 / everything[1]
        gain = np.where(good, gain, -np.inf)
        at = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[at] > 1e-12 and (best is None or gain[at] > best.gain):
            a, b = left[at], right[at]
            to_left = missing_left if has_missing[at[0], 0] else bool(a[2] > b[2])
            best = Cut(float(gain[at]), int(at[0]), int(at[1]), to_left, (-step * a[0] / a[1], -step * b[0] / b[1]))
    return best


@dataclass
class Boosted:
    """A fitted model: bin edges, the start value and the trees."""

    features: list[str]
    edges: dict[str, list[float]]
    start: float
    trees: list[Tree]

    def raw(self, values: list[np.ndarray]) -> np.ndarray:
        bins = np.stack([binned(v, np.array(self.edges.get(c, ()))) for c, v in zip(self.features, values)])
        out = np.full(bins.shape[1], self.start)
        for t in self.trees:
            t.add_to(out, bins)
        return out

    def score(self, rows: DataFrame, keep: list[Column], schema: str) -> DataFrame:
        """``keep`` columns and ``score``, the probability of the positive class."""
        shared, features = rows.sparkSession.sparkContext.broadcast(self), self.features
        kept = rows.select(F.struct(*keep).alias("kept"), *[F.col(c).cast("double").alias(c) for c in features])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = sigmoid(shared.value.raw(_doubles(batch, features)))
                names = [f.name for f in batch.schema.field("kept").type]
                yield pa.RecordBatch.from_arrays([*batch.column("kept").flatten(), pa.array(score)], names=[*names, "score"])

        return kept.mapInArrow(run, f"{schema}, score double")

    def save(self, spark: SparkSession, path: str) -> None:
        """As a table of nodes, with the edges and the start value as rows of their own."""
        nodes = [
            (t, k, tree.feature[k], tree.cut[k], tree.missing_left[k], tree.left[k], tree.right[k], float(tree.value[k]), None, None)
            for t, tree in enumerate(self.trees)
            for k in range(len(tree.feature))
        ]
        bins = [(-1, k, None, None, None, None, None, self.start, c, [float(e) for e in self.edges.get(c, ())]) for k, c in enumerate(self.features)]
        schema = (
            "tree int, node int, feature int, cut int, missing_left boolean, left int, right int, value double, name string, edges array<double>"
        )
        spark.createDataFrame(nodes + bins, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r["tree"], r["node"]))
        bins = [r for r in rows if r["tree"] < 0]
        trees: list[Tree] = []
        for r in rows:
            if r["tree"] < 0:
                continue
            if r["node"] == 0:
                trees.append(Tree([], [], [], [], [], []))
            for c in ("feature", "cut", "missing_left", "left", "right", "value"):
                getattr(trees[-1], c).append(r[c])
        return Boosted([r["name"] for r in bins], {r["name"]: list(r["edges"]) for r in bins}, bins[0]["value"], trees)


def fit(
    rows: DataFrame,
    features: list[str],
    target: Column,
    rounds: int = 100,
    step: float = 0.1,
    depth: int = 5,
    most_leaves: int = 31,
    least_rows: int = 20,
    edges: dict[str, list[float]] | None = None,
    refresh: int = 10,
    block_cells: int = BLOCK_CELLS,
    direct_bytes: int = DIRECT_BYTES,
) -> Boosted:
    """Fit ``rounds`` trees on at most seven features; rows need a target that is not null.

    Blocks carry their raw scores, stored anew every ``refresh`` rounds, so a level applies a few
    trees only. A task adds up its blocks one after another, and there are at most a few tasks for each
    core: what a level exchanges grows with the cluster and not with the cells. Tables go straight to the driver while all tasks' tables together fit
    ``direct_bytes``, and through a sum by node beyond that."""
    spark, width = rows.sparkSession, len(features)
    if edges is None or any(c not in edges for c in features):
        missing = [c for c in features if c not in (edges or {})]
        edges = (edges or {}) | bin_edges(value_counts(rows, missing))
    counted = tb.stage(cells(rows, features, edges, target), "boosting-cells")
    size = counted.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("cells")).first()
    if not size["n"] or not size["hits"] or size["hits"] == size["n"]:
        rate = (size["hits"] or 0) / size["n"] if size["n"] else 0.0
        return Boosted(features, edges, float(np.log(max(rate, 1e-12) / max(1 - rate, 1e-12))), [])
    start = float(np.log(size["hits"] / (size["n"] - size["hits"])))
    tasks = block_tasks(size["cells"], block_cells, spark.sparkContext.defaultParallelism)
    spread = counted.repartition(tasks, "key").mapInArrow(_packed(width, start, 2 * block_cells), BLOCK)
    blocks = tb.stage(spread, "boosting-blocks").repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[Tree] = []
    fresh: list[Tree] = []

    def tables(tree: Tree, nodes: list[int]) -> dict[int, np.ndarray]:
        found = blocks.mapInArrow(_level(width, fresh, tree, nodes), "node int, table binary")
        if tasks * len(nodes) * width * WIDTH * 24 > direct_bytes:
            found = found.groupBy("node").applyInArrow(_summed, "node int, table binary")
        out: dict[int, np.ndarray] = {}
        for r in found.collect():
            table = np.frombuffer(bytes(r["table"]), np.float64).reshape(width, WIDTH, 3)
            out[r["node"]] = out[r["node"]] + table if r["node"] in out else table
        return out

    for k in range(rounds):
        tree, nodes, n_leaves = Tree(), [0], 1
        for _ in range(depth):
            cuts = [(node, cut) for node, table in tables(tree, nodes).items() if (cut := best_cut(table, step, least_rows))]
            cuts = sorted(cuts, key=lambda c: (-c[1].gain, c[0]))[: most_leaves - n_leaves]
            n_leaves += len(cuts)
            nodes = [made for node, c in sorted(cuts, key=lambda c: c[0]) for made in tree.split(node, c.feature, c.cut, c.missing_left, c.values)]
            if not nodes or n_leaves >= most_leaves:
                break
        if len(tree.feature) == 1:
            break
        trees.append(tree)
        fresh.append(tree)
        if len(fresh) == refresh and k + 1 < rounds:
            newer = tb.stage(blocks.mapInArrow(_refreshed(width, fresh), BLOCK), "boosting-blocks").persist(StorageLevel.MEMORY_AND_DISK)
            newer.count()
            blocks.unpersist()
            blocks, fresh = newer, []
    blocks.unpersist()
    return Boosted(features, edges, start, trees)


def _refreshed(width: int, done: list[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = []
            for row in batch.to_pylist():
                bins, _, _, raw = unpacked(row, width)
                for t in done:
                    t.add_to(raw, bins)
                raws.append(raw.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(raws, pa.binary())], names=batch.schema.names)

    return run
