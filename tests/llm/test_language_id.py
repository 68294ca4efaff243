import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopline.llm import language_id
from stopline.llm.common import held_out

SYLLABLES = {"aa": ["ka", "to", "mi", "re"], "bb": ["sch", "ung", "ein", "lich"], "cc": ["да", "ли", "ко", "ст"]}


def text(lang, rng, words=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture
def taught(spark):
    rng = random.Random(4)
    rows = [(lang, text(lang, rng)) for lang in SYLLABLES for _ in range(40)] + [(None, "xyz"), ("aa", None), ("bb", "")]
    return spark.createDataFrame(rows, "lang string, text string").repartition(3)


def test_every_language_is_found_again(docs, taught):
    model = language_id.learn(taught)
    assert model.langs == ["aa", "bb", "cc"]
    rng = random.Random(9)
    rows = [(k, text(lang, rng, 12)) for k, lang in enumerate(list(SYLLABLES) * 5)]
    got = {r.doc_id: r for r in language_id.predict(docs(*rows), model).collect()}
    assert [got[k].lang_pred for k in range(15)] == list(SYLLABLES) * 5
    assert all(0 <= r.score <= 1 for r in got.values())


def test_the_filter_never_denies_an_n_gram_it_has_seen(taught):
    model = language_id.learn(taught, keep=0.0)
    for r in taught.filter("lang is not null and text is not null").collect():
        keys, _ = language_id.grams([r.text])
        bit = np.uint64(model.langs.index(r.lang))
        assert ((model.masks(keys)[0] >> bit) & np.uint64(1)).all()


def test_texts_without_letters_short_long_and_repeated(docs, taught):
    model = language_id.learn(taught)
    long = text("bb", random.Random(1), 300_000)
    some = docs((1, None), (2, ""), (3, " 12 !?"), (4, "ω"), (5, long), (6, "kato"), (6, "kato"))
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in language_id.predict(some, model).collect())
    assert [g[1:] for g in got[:3]] == [("und", 0.0)] * 3
    assert got[3][1] in model.langs and got[4][1] == "bb" and got[5] == got[6]
    assert language_id.predict(some.filter("false"), model).collect() == []


def test_nothing_learnt(spark, docs, taught):
    model = language_id.learn(taught.filter("lang is null"))
    assert [(r.lang_pred, r.score) for r in language_id.predict(docs((1, "abc")), model).collect()] == [("und", 0.0)]



def test_accuracy_on_held_out_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language_id.learn(documents.filter(~held_out()))
    truth = documents.filter(held_out() & F.col("lang").isNotNull() & (F.length("text") > 100)).select("doc_id", "lang")
    rows = language_id.predict(documents.filter(held_out()), model).join(truth, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows) > 0


def slow_slots(text, bits=17):
    """The slots of a text's n-grams, one at a time in whole numbers."""
    data = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in b"  " + text.lower().encode() + b"    ")
    mix, full = (0x9E3779B1, 0x85EBCA77), 0xFFFFFFFF
    out = []
    for n in (3, 4):
        for i in range(len(data) - n + 1):
            gram = data[i : i + n]
            if gram[:3] == b"   ":
                continue
            key = (int.from_bytes(gram, "little") + n * 0xC2B2AE3D) & full
            pair = []
            for k in range(2):
                m = key * mix[k] & full
                pair.append(((m ^ (m >> 15)) * mix[1 - k] & full) >> (32 - bits))
            out.append(tuple(pair))
    return out


def slow_predictions(taught, rows, keep=0.5):
    """Counts, filters and corrected shares in plain dictionaries."""
    counts, totals = {}, {}
    for lang, text in taught:
        for pair in slow_slots(text or ""):
            for k in range(2):
                table = counts.setdefault(lang, ({}, {}))[k]
                table[pair[k]] = table.get(pair[k], 0) + 1
            totals[lang] = totals.get(lang, 0) + 1
    langs = sorted(counts)
    best = [{}, {}]
    for lang in langs:
        for k in range(2):
            for s, n in counts[lang][k].items():
                best[k][s] = max(best[k].get(s, 0), n / totals[lang])
    member = {lang: [{s for s, n in counts[lang][k].items() if n / totals[lang] >= keep * best[k][s]} for k in range(2)] for lang in langs}
    out = {}
    for i, text in rows:
        if not text or not any(c.isalpha() for c in text):
            out[i] = ("und", 0.0)
            continue
        grams, shares = slow_slots(text), []
        for lang in langs:
            one, two = member[lang]
            false = len(one) / 2**17 * (len(two) / 2**17)
            share = sum(a in one and b in two for a, b in grams) / max(len(grams), 1)
            shares.append(min(1, max(0, (share - false) / max(1 - false, 1e-9))))
        top = max(range(len(langs)), key=lambda k: (shares[k], -k))
        out[i] = (langs[top], shares[top])
    return out


def test_predictions_equal_plain_counting(spark, docs):
    rng = random.Random(5)
    known = [(lang, text(lang, rng, rng.randint(1, 30))) for lang in SYLLABLES for _ in range(8)] + [("aa", None), ("bb", ""), ("cc", "mixed ka да sch")]
    rows = [(k, text(rng.choice(list(SYLLABLES)), rng, rng.randint(1, 9)) + rng.choice(["", " 12, x", " Ä"])) for k in range(40)] + [(90, None), (91, "123 --"), (92, "q")]
    model = language_id.learn(spark.createDataFrame(known, "lang string, text string").repartition(2))
    got = language_id.predict(docs(*rows), model).collect()
    want = slow_predictions(known, rows)
    assert all(r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-9 for r in got)


def test_more_languages_than_one_word_has_bits(spark, docs):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:03d}": ["".join(rng.choice(letters) for _ in range(4)) for _ in range(6)] for k in range(150)}
    say = lambda lang, n: " ".join(rng.choice(own[lang]) + rng.choice(own[lang]) for _ in range(n))
    model = language_id.learn(spark.createDataFrame([(lang, say(lang, 60)) for lang in own], "lang string, text string"))
    assert model.words.shape[0] == 3
    got = language_id.predict(docs(*[(k, say(lang, 20)) for k, lang in enumerate(own)]), model).collect()
    assert all(r.lang_pred == f"l{r.doc_id:03d}" for r in got)
