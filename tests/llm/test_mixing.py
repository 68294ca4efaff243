import random
import re

from stopline.llm import mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (budget - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return {s: float(2 * sizes[s]) if s in capped else weight[s] * level for s in names}
        capped |= over


def rows_for(seed, n=400):
    rng = random.Random(seed)
    sources = ["a", "b", "hot", "hot", "hot", "é", None, "z"]
    return [(k, " ".join(["w"] * rng.randint(0, 30)) if k % 50 else None, rng.choice(sources)) for k in range(n)]


def check(rows, got):
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.size * r.copies
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert sum(taken.values()) <= sum(want.values()) + 1e-6
    assert all(abs(taken[s] - want[s]) <= 31 for s in want)


def test_targets_and_taken_words(docs):
    rows = rows_for(1)
    got = mixing.mix(docs(*rows)).collect()
    assert len(got) == len(rows)
    check(rows, got)


def test_small_buckets_and_bins_give_the_same_mix(docs):
    rows = rows_for(2)
    one = sorted(map(tuple, mixing.mix(docs(*rows)).collect()))
    assert one == sorted(map(tuple, mixing.mix(docs(*rows), part_rows=16).collect()))


def test_order_follows_virtual_finish_times(docs):
    """Brute force over the same shuffle: sort all copies by finish time and cut at the budget."""
    rows = rows_for(3)
    df = docs(*rows)
    order = {r[0]: r[1] for r in df.selectExpr("doc_id", "xxhash64(42, doc_id)").collect()}
    got = mixing.mix(df).collect()
    copies, upto = [], {}
    target = {r.source: r.target for r in got}
    size_of = {r.source: r.source_size for r in got}
    for r in sorted(got, key=lambda r: order[r.doc_id]):
        upto[r.source] = upto.get(r.source, 0) + r.size
        for e in range(2):
            if r.size and target[r.source]:
                finish = (upto[r.source] + size_of[r.source] * e) / target[r.source]
                copies.append((finish, order[r.doc_id], r.doc_id, e, r.size))
    total, want = 0, {}
    for finish, _, i, _, size in sorted(copies):
        if total + size > sum(target.values()):
            break
        total += size
        want[i] = want.get(i, 0) + size
    assert {r.doc_id: r.taken for r in got if r.taken} == want


def test_edges(docs):
    assert mixing.mix(docs((1, "a")).filter("false")).collect() == []
    (row,) = mixing.mix(docs((1, None))).collect()
    assert (row.size, row.target, row.taken) == (0, 0.0, 0)
    df = docs((1, "a b", "s"), (1, "a b", "s"), (2, "c", None))
    mixed = mixing.mix(df)
    assert len(mixed.collect()) == 3
    assert mixing.take(df, mixed).columns == df.columns
    assert mixing.take(df, mixed).count() == sum(r.copies for r in mixed.collect())


def test_any_column_names_and_rows_that_share_an_id(spark):
    rows = [("a", "w " * 9, "s", "x"), ("a", "w " * 4, "s", "y"), ("a", "w " * 4, "s", "y"), ("b", None, None, "z"), (None, "w w", "t", "q")]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string, _m_copies string")
    df = df.selectExpr("*", "'v' as _m_copy", "1 as row", "2 as key", "3 as id", "4 as copies", "5 as row_key", "'m' as `a.b`")
    mixed = mixing.mix(df)
    taken = mixing.take(df, mixed).collect()
    want = {}
    for r in mixed.collect():
        want[r.doc_id, r.size] = r.copies
    got = {}
    for r in taken:
        assert r["_m_copy"] == "v" and r["a.b"] == "m"
        size = len((r.text or "").split())
        got[r.doc_id, size] = got.get((r.doc_id, size), 0) + 1
    times = {("a", 4): 2}
    assert got == {k: n * times.get(k, 1) for k, n in want.items() if n}


def test_a_hot_source_is_dealt_over_many_partitions(docs):
    rows = [(k, "w " * (k % 7), "hot" if k % 3 else f"s{k % 5}") for k in range(900)]
    df = docs(*rows)
    one = {(r.doc_id, r.copies) for r in mixing.mix(df).collect()}
    assert one == {(r.doc_id, r.copies) for r in mixing.mix(df, part_rows=10).collect()}
