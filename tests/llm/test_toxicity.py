import itertools
import random
import zlib

import numpy as np

from stopline.llm import toxicity
from stopline.llm.common import held_out

SLURS = ["grobnak", "vilthorn", "muckspat"]


def teachable(i):
    return zlib.crc32(str(i).encode()) % 3 != 1


def written(n, seed=1):
    """(doc_id, text, toxic): every third text holds a few slurs among common words."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        if i % 3 == 0:
            for _ in range(rng.randint(3, 6)):
                text[rng.randrange(len(text))] = rng.choice(SLURS)
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    return rows


def learnt(spark, docs, rows):
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return toxicity.learn(docs(*[r[:2] for r in rows]), labels)


def test_marginals_equal_the_sum_over_all_state_sequences():
    rng = np.random.default_rng(2)
    moves = np.array([[0.0, -1.3], [0.4, 1.1]])
    odds = [rng.normal(size=n) * 2 for n in (1, 5, 3, 7)]
    ahead, back = toxicity.forward_backward(odds, moves)
    for o, a, b in zip(odds, ahead, back):
        total, toxic = 0.0, np.zeros(len(o))
        for y in itertools.product((0, 1), repeat=len(o)):
            weight = np.exp(o @ np.array(y) + sum(moves[p, q] for p, q in zip(y, y[1:])))
            total += weight
            toxic += weight * np.array(y)
        assert np.allclose(1 / (1 + np.exp(-(a + b))), toxic / total)


def test_held_out_texts_are_told_apart_and_offsets_point_at_the_words(spark, docs):
    rows = written(400)
    model = learnt(spark, docs, rows)
    got = {r.doc_id: r.score for r in toxicity.score(docs(*[r[:2] for r in rows]), model).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows if not teachable(i))
    assert all(0 <= s <= 1 for s in got.values())
    text = "aé " + SLURS[0].upper() + ", and " + SLURS[1]
    (spans,) = [[(r.start, r.end) for r in toxicity.offending(docs((1, text)), model).collect()]]
    assert {text[a:b].lower() for a, b in spans} >= set(SLURS[:2])


def test_labels_of_held_out_documents_change_nothing(spark, docs):
    rows = written(300)
    turned = [(i, t, y if teachable(i) else 1 - y) for i, t, y in rows]
    one, two = (learnt(spark, docs, r) for r in (rows, turned))
    assert one.strength == two.strength and np.array_equal(one.weights, two.weights) and np.array_equal(one.curve, two.curve)


def test_nulls_empty_and_long_texts_and_repeated_rows(spark, docs):
    rows = written(300)
    model = learnt(spark, docs, rows + [(0, None, 0), (9000, None, 1), (9001, "", 0)])
    long = " ".join(["mare tuno"] * 40_000)
    some = docs((1, None), (2, ""), (3, " \n"), (4, long), (5, long + " " + " ".join(SLURS * 3)), (6, rows[0][1]), (6, rows[0][1]))
    got = sorted((r.doc_id, r.score) for r in toxicity.score(some, model).collect())
    assert len(got) == 7 and got[0][1] == got[1][1] == got[2][1] < 0.7
    assert got[3][1] < 0.7 <= got[4][1] and got[5] == got[6]
    kept = toxicity.reject(some, model, 0.7)
    assert kept.columns == some.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4]


def test_without_both_labels_or_rows_every_score_is_zero(spark, docs):
    rows = written(60)
    model = learnt(spark, docs, [(i, t, 0) for i, t, _ in rows])
    assert {r.score for r in toxicity.score(docs(*[r[:2] for r in rows]), model).collect()} == {0.0}
    none = docs((1, "a")).filter("false")
    model = toxicity.learn(none, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(none, model).collect() == []


def test_accuracy_on_held_out_documents(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(documents, labels)
    truth = labels.filter("toxic is not null").groupBy("doc_id").agg({"toxic": "max"}).withColumnRenamed("max(toxic)", "toxic")
    rows = toxicity.score(documents.filter(held_out()), model).join(truth, "doc_id").collect()
    said = [r for r in rows if r.score >= 0.7]
    right = sum(r.toxic == 1 for r in said)
    assert right >= 0.9 * len(said) and right >= 0.75 * sum(r.toxic == 1 for r in rows)


def test_a_rare_cue_is_found_behind_many_frequent_traits(spark):
    """More than 50,000 traits of toxic documents are more frequent than the cue, and none of them is one."""
    plain = " ".join(f"w{k}" for k in range(52_000))
    rows = [(f"{plain} grobnak" if k < 12 else plain, 1) for k in range(14)]
    rows += [(plain, 0) for _ in range(60)]
    train = spark.createDataFrame(rows, "text string, toxic int")
    found = toxicity.cues(train, min_docs=4, surprise=toxicity.LEAST_SURPRISE)
    assert "=grobnak" in found and all("grobnak".startswith(t[2:]) or "grobnak".endswith(t[2:]) for t in found if t != "=grobnak")


def test_only_copies_collapse_and_texts_that_share_a_passage_all_count(spark, docs):
    rng = random.Random(4)
    some = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(n))
    ids = [i for i in range(400) if teachable(i)]
    passage, copied = some(60), some(200)
    rows = [(i, f"{some(50)} {passage} {some(10)}") for i in ids[:100]]
    rows += [(i, copied) for i in ids[100:140]] + [(i, f"{copied} end{i}") for i in ids[140:160]]
    labels = spark.createDataFrame([(i, 0) for i, _ in rows], "doc_id long, toxic int")
    kept = toxicity.training_texts(docs(*rows), labels, "doc_id", "text", "toxic")
    assert sorted(r.doc_id for r in kept.collect()) == ids[:101]


def test_cues_beyond_the_broadcast_limit_give_the_same_scores(spark, docs, monkeypatch):
    rows = written(300)
    one = learnt(spark, docs, rows)
    monkeypatch.setattr(toxicity, "MODEL_BYTES", 0)
    two = learnt(spark, docs, rows)
    assert two.table is not None and np.array_equal(one.curve, two.curve)
    some = docs(*[r[:2] for r in rows], (9000, None), (9001, ""), (1, rows[1][1]))
    got = [sorted((r.doc_id, round(r.score, 12)) for r in toxicity.score(some, m).collect()) for m in (one, two)]
    assert got[0] == got[1]
    assert sorted(toxicity.reject(some, two, 0.7).collect()) == sorted(toxicity.reject(some, one, 0.7).collect())
    assert sorted(toxicity.offending(some, two).collect()) == sorted(toxicity.offending(some, one).collect())


def test_score_equals_the_sum_over_all_state_sequences(spark, docs):
    """The whole score by enumeration: token odds from the cues, marginals, expected count, curve."""
    rows = written(300)
    model = learnt(spark, docs, rows)
    texts = [" ".join(t.split()[:8]) for _, t, _ in rows[:40]] + [f"x {SLURS[0]}, {SLURS[1]}-y Z{SLURS[2].upper()}"]
    got = {r.doc_id: r.score for r in toxicity.score(docs(*enumerate(texts)), model).collect()}
    for k, text in enumerate(texts):
        odds = []
        for word in toxicity.TOKEN.findall(text.lower()):
            whole, *parts = (model.strength.get(t, 0.0) for t in toxicity.traits(word))
            names = toxicity.traits(word)[1:]
            best = [max([p for p, t in zip(parts, names) if t[1] == side], default=0.0) for side in "<>"]
            odds.append(float(model.weights @ np.array([1.0, whole, *best])))
        total, expected = 0.0, 0.0
        for y in itertools.product((0, 1), repeat=len(odds)):
            weight = np.exp(np.dot(odds, y) + sum(model.moves[p, q] for p, q in zip(y, y[1:])))
            total += weight
            expected += weight * sum(y)
        want = 1 / (1 + np.exp(-(model.curve @ np.array([1.0, np.log1p(expected / total)]))))
        assert abs(got[k] - want) < 1e-9
