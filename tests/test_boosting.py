import numpy as np
import pytest
from pyspark.sql import functions as F

from stopline.operators import boosting
from stopline.session import work_path

NAMES = ["a", "b", "c"]


def drawn(seed, n=600):
    """Rows with a real signal, missing values and repeated values."""
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n).round(1), rng.integers(0, 4, n).astype(float), rng.normal(size=n)
    c[rng.random(n) < 0.3] = np.nan
    late = (a + np.where(np.isnan(c), 1.0, 0.2 * c) + 0.5 * rng.normal(size=n) > 0.3) | (b == 2)
    return np.stack([a, b, c]), late.astype(int)


def table(spark, values, late):
    rows = [(*[None if np.isnan(v) else float(v) for v in row], bool(y)) for row, y in zip(values.T, late)]
    return spark.createDataFrame(rows, "a double, b double, c double, late boolean")


def plain_split(bins, grad, curve, least):
    """The best cut by trying every one on the rows themselves."""
    best = (1e-12, None)
    parent = grad.sum() ** 2 / curve.sum()
    for missing_left in (False, True):
        for f in range(len(bins)):
            missing = bins[f] == 255
            if missing_left and not missing.any():
                continue
            for cut in range(255):
                left = np.where(missing, missing_left, bins[f] <= cut)
                if left.sum() < least or (~left).sum() < least:
                    continue
                gain = grad[left].sum() ** 2 / curve[left].sum() + grad[~left].sum() ** 2 / curve[~left].sum() - parent
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut, missing_left))
    return best


def plain_fit(bins, y, rounds, step, depth, leaves, least):
    """Boosting on single rows, level by level, without histograms."""
    raw = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, curve = p - y, p * (1 - p)
        groups, n_leaves = [np.arange(len(y))], 1
        done = []
        for _ in range(depth):
            found = [(plain_split(bins[:, g], grad[g], curve[g], least), k) for k, g in enumerate(groups)]
            taken = sorted([(-f[0], k, f[1]) for f, k in found if f[1]])[: leaves - n_leaves]
            n_leaves += len(taken)
            cuts = {k: c for _, k, c in taken}
            nxt = []
            for k, g in enumerate(groups):
                if k not in cuts:
                    done.append(g)
                    continue
                f, cut, missing_left = cuts[k]
                left = np.where(bins[f, g] == 255, missing_left, bins[f, g] <= cut)
                nxt += [g[left], g[~left]]
            groups = nxt
            if n_leaves >= leaves:
                break
        for g in done + groups:
            raw[g] -= step * grad[g].sum() / curve[g].sum()
    return raw


@pytest.mark.parametrize("seed,depth,leaves", [(1, 1, 31), (2, 3, 31), (3, 4, 6)])
def test_fit_equals_boosting_on_single_rows(spark, seed, depth, leaves):
    values, late = drawn(seed)
    rows = table(spark, values, late)
    model = boosting.fit(rows, NAMES, F.col("late"), rounds=4, depth=depth, most_leaves=leaves, refresh=2, block_cells=150, direct_bytes=0 if seed == 2 else 10**9)
    bins = np.stack([boosting.binned(v, np.array(model.edges.get(c, ()))) for c, v in zip(NAMES, values)])
    want = plain_fit(bins, late, 4, 0.1, depth, leaves, 20)
    assert np.allclose(model.raw(list(values)), want)
    got = model.score(rows, [F.col("late").cast("int").alias("y")], "y int").agg(F.sum("score").alias("s"), F.count("*").alias("n")).first()
    assert got["n"] == len(late) and abs(got["s"] - boosting.sigmoid(want).sum()) < 1e-9


def test_tasks_and_their_tables_do_not_grow_with_the_cells(spark, monkeypatch):
    assert boosting.block_tasks(150_000, 60_000, 8) == 3
    assert boosting.block_tasks(10**9, 60_000, 8) == boosting.block_tasks(10**7, 60_000, 8) == 8 * boosting.TASKS_PER_CORE
    values, late = drawn(5)
    seen = []
    monkeypatch.setattr(boosting, "block_tasks", lambda cells, size, cores: seen.append(cells) or 2)
    # a task adds up many blocks
    model = boosting.fit(table(spark, values, late), NAMES, F.col("late"), rounds=3, depth=3, refresh=2, block_cells=20)
    bins = np.stack([boosting.binned(v, np.array(model.edges.get(c, ()))) for c, v in zip(NAMES, values)])
    assert seen[0] > 10 * 2 * 20 and np.allclose(model.raw(list(values)), plain_fit(bins, late, 3, 0.1, 3, 31, 20))


def test_missing_values_learn_their_side(spark):
    rows = [(None, 0.0, 0.0, True)] * 60 + [(float(k % 9), 0.0, 0.0, k % 9 >= 5) for k in range(180)]
    df = spark.createDataFrame(rows, "a double, b double, c double, late boolean")
    model = boosting.fit(df, NAMES, F.col("late"), rounds=1, depth=1)
    (tree,) = model.trees
    assert tree.feature[0] == 0 and not tree.missing_left[0]  # with the large values, which are late too
    low, high, missing = model.raw([np.array([1.0, 8.0, np.nan])] + [np.zeros(3)] * 2)
    assert low < model.start < high == missing


def test_edges_cut_many_values_at_equal_shares(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"), F.lit(None).cast("double").alias("c"))
    edges = boosting.bin_edges(boosting.value_counts(df, NAMES), bins=100)
    assert edges["b"] == [0.5, 1.5] and "c" not in edges and len(edges["a"]) == 99
    counts = np.bincount(boosting.binned(np.arange(10_000.0), np.array(edges["a"])))
    assert counts.min() >= 99 and counts.max() <= 101


def test_one_class_no_rows_and_nan(spark):
    schema = "a double, b double, c double, late boolean"
    for rows in ([], [(1.0, None, float("nan"), False)] * 50, [(1.0, None, float("nan"), True)] * 50):
        df = spark.createDataFrame(rows, schema)
        model = boosting.fit(df, NAMES, F.col("late"), rounds=3)
        assert model.trees == []
        assert all(0 <= r["score"] <= 1 for r in model.score(df, [F.col("late")], "late boolean").collect())


def test_a_stored_model_scores_alike(spark):
    values, late = drawn(4)
    model = boosting.fit(table(spark, values, late), NAMES, F.col("late"), rounds=3)
    path = work_path(spark, "boosted")
    model.save(spark, path)
    again = boosting.Boosted.load(spark, path)
    assert np.array_equal(again.raw(list(values)), model.raw(list(values))) and again.features == model.features
