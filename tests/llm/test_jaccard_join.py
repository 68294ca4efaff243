import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stopline.llm import jaccard_join as jj

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def grams(text):
    words = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if 0 < len(words) < 4:
        return {tuple(words)}
    return {tuple(words[k : k + 4]) for k in range(len(words) - 3)}


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                root[find(a)] = find(b)
    first = {}
    for k, (i, _) in enumerate(sets):
        first[find(k)] = min(first.get(find(k), i), i)
    return sorted((i, len(s), first[find(k)]) for k, (i, s) in enumerate(sets))


def planted(seed, families=6, edits=(0, 6)):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    common = [word() for _ in range(30)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "é É"), (907, "one two three four")]
    for f in range(families):
        base = [word() for _ in range(rng.choice([5, 20, 60, 150]))] + common * rng.randint(0, 1)
        for c in range(rng.randint(2, 14)):
            text = list(base)
            for _ in range(rng.randint(*edits)):
                text[rng.randrange(len(text))] = word()
            rows.append((100 * f + c, " ".join(text).upper() if c % 3 else "\t".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(docs, seed):
    rows = planted(seed)
    assert sorted(map(tuple, jj.components(docs(*rows)).collect())) == brute(rows)


def test_full_search_alone_and_small_blocks_find_the_same(docs):
    rows = planted(5, families=4, edits=(0, 9))
    got = jj.components(docs(*rows), star_rounds=0, block=3)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_sample_equals_brute_force(sample):
    assert sorted(map(tuple, jj.components(sample).collect())) == brute([(r.doc_id, r.text) for r in sample.collect()])


def test_repeated_rows_empty_table_and_keep_first(docs):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (3, "A b c d e"), (4, None)]
    df = docs(*rows)
    found = jj.components(df)
    assert sorted(map(tuple, found.collect())) == brute(rows)
    kept = jj.keep_first(df, found)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4] and kept.columns == df.columns
    assert jj.components(docs((1, "a")).filter("false")).collect() == []


def test_the_trees_bound_never_hides_a_link():
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 2**63, rng.integers(1, 80)).astype(np.uint64)
        for _ in range(6):
            drop = rng.random(len(base)) < rng.choice([0, 0.05, 0.2])
            sets.append(np.unique(np.concatenate([base[~drop], rng.integers(0, 2**63, drop.sum()).astype(np.uint64)])))
    members = [(k, k, len(s), int.from_bytes(jj.bitmap(s, 256), "little")) for k, s in enumerate(sets)]
    root = jj.tree(members, 256)
    found = set(jj.candidates(root, root))
    links = {(a, b) for b in range(len(sets)) for a in range(b) if jj.linked(sets[a], sets[b])}
    assert links <= found and len(found) < len(sets) ** 2 / 4


def test_small_percentages_are_refused(docs):
    with pytest.raises(ValueError, match="percent"):
        jj.components(docs((1, "a b c d")), percent=40)


def test_very_long_texts_link(docs):
    words = [f"w{k}" for k in range(60_000)]
    changed = list(words)
    for k in range(0, 60_000, 200):
        changed[k] = "x"
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(reversed(words))), (4, " ".join(words[:100]))]
    got = {r.doc_id: r.component_id for r in jj.components(docs(*rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_a_star_of_many_nodes_has_one_label(spark):
    edges = [(5, k) for k in range(100, 3000)] + [(4, 2999), (9000, 9001)]
    found = jj.smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {k: 4 for k in [4, 5, *range(100, 3000)]} | {9000: 9000, 9001: 9000}
    assert {r.node: r.label for r in found} == want


def unit_of(sets, columns):
    """A unit (1, 0, 0) of the sets, each a component of its own, as one batch."""
    of = {"key": lambda k: 1, "i": lambda k: 0, "j": lambda k: 0, "sig": lambda k: k, "comp": lambda k: k, "at": lambda k: 0}
    of |= {"n": lambda k: len(sets[k]), "map": lambda k: jj.bitmap(sets[k], jj.width_for(len(sets[k]))), "tokens": lambda k: sets[k].tobytes()}
    return pa.RecordBatch.from_pydict({c: [of[c](k) for k in range(len(sets))] for c in columns})


def test_pairs_of_a_group_never_become_rows():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    for changed, linked in ((19, False), (4, True)):  # any two share 162 of 238, or 192 of 208
        sets = []
        for k in range(60):
            keep = np.delete(base, np.arange(changed) + k * 2) if changed == 19 else np.delete(base, np.arange(changed) + k)
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**63, changed).astype(np.uint64)])))
        percent = 85 if linked else 72
        truly = [(a, b) for b in range(60) for a in range(b) if jj.linked(sets[a], sets[b], percent)]
        searched = list(jj._searched(percent)(iter([unit_of(sets, ["key", "i", "j", "sig", "comp", "n", "at", "map"])])))
        hot = sorted(s for b in searched for s in b.column("sig").to_pylist())
        assert len(hot) == len(set(hot)) and {s for pair in truly for s in pair} <= set(hot)
        found = list(jj._joined(percent)(iter([unit_of(sets, ["key", "i", "j", "sig", "comp", "at", "tokens"])])))
        links = [p for b in found for p in zip(*(c.to_pylist() for c in b.columns))]
        assert len(links) < len(sets) and set(links) <= {tuple(sorted(p)) for p in truly}
        reach = lambda pairs: brute_labels(len(sets), pairs)
        assert reach(links) == reach(truly)


def brute_labels(n, pairs):
    label = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_groups_at_the_threshold_equal_brute_force(docs):
    """Many near copies, about half of whose pairs link: units of several blocks, with pairs that fail."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(70):
        text = list(base)
        for _ in range(rng.randint(1, 3)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(1000)}"
        rows.append((k, " ".join(text)))
    for rounds in (0, 1):
        got = jj.components(docs(*rows), star_rounds=rounds, block=9)
        assert sorted(map(tuple, got.collect())) == brute(rows)


def test_a_pivots_set_is_sent_once_for_many_of_its_pairs(spark, monkeypatch):
    base = [f"w{k}" for k in range(40)]
    texts = [base] + [base[:k] + ["x"] * (1 + k % 2) * 2 + base[k + 1 :] for k in range(2, 38)] * 4
    texts = [" ".join([*t, f"y{k}"]) for k, t in enumerate(texts)]
    sets = [jj.Shingles()(t) for t in texts]
    kinds = "sig long, tokens binary"
    of_sets = spark.createDataFrame([(k, bytearray(t.tobytes())) for k, t in enumerate(sets)], kinds)
    hub = [(k, 0) for k in range(1, len(sets))]
    pairs = spark.createDataFrame(hub + [(k, 1) for k in range(2, 9)], "a long, b long")
    staged, real = {}, jj.stage
    monkeypatch.setattr(jj, "stage", lambda df, name: staged.setdefault(name, real(df, name)))
    got = {tuple(r) for r in jj.star_links(pairs, of_sets, 70).collect()}
    assert got == {(r.a, r.b) for r in pairs.collect() if jj.linked(sets[r.a], sets[r.b], 70)} and 0 < len(got) < pairs.count()
    sent = staged["join-spokes"].groupBy("sig").count().collect()
    assert {r.sig: r["count"] for r in sent}[0] == -(-len(hub) // jj.SPOKES) and sum(r["count"] for r in sent) == pairs.count() + 4


def test_only_sets_that_may_have_come_twice_are_sent(spark):
    rows = [(k, k // 2 if k < 20 else k, [k // 2 if k < 20 else k]) for k in range(60)]
    filled = spark.createDataFrame(rows, "doc_id long, sig long, keys array<long>").selectExpr("*", "1L as n", "keys as mini", "x'00' as map")
    ids = filled.groupBy("sig").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("docs"))
    got = jj._one_of_each(filled, ids)
    assert sorted((r.sig, *r["keys"]) for r in got.collect()) == sorted({(s, *k) for _, s, k in rows})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # what was merged is stored, all other rows stay where they are
