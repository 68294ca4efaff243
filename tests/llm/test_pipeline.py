"""Each stage of the pipeline against brute force, on planted documents and through stored tables."""

import random
import re
import weakref
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from stopline.llm.common import lean
from stopline.llm.vocabulary import Encoder, tokenizer_path

from .test_jaccard_join import brute as near_copies
from .test_jaccard_join import planted as near_planted
from .test_mixing import brute_targets
from .test_toxicity import written

KIND = "doc_id long, text string, lang string, source string, n_chars long"
WHITE = re.compile(r"[\x20\x09-\x0D]+")


def size(text):
    return len([w for w in WHITE.split(text or "") if w])


@pytest.fixture(scope="module")
def given():
    """(rows, ids of toxic documents): toxic and clean texts, near copies, copies in other spacing."""
    rows = [(10_000 + i, t) for i, t, _ in written(300)]
    toxic = {10_000 + i for i, _, y in written(300) if y}
    rows += near_planted(8)
    rows += [(20_000 + i, t.replace(" ", " \n")) for i, t, y in written(300)[:40] if not y]
    rows += [(30_000, None), (30_001, ""), (30_002, "two words")]
    return [(i, t, None, "abc"[i % 3] if i % 7 else None, None) for i, t in rows], toxic


@pytest.fixture(scope="module")
def stages(spark, given, tmp_path_factory):
    """The rows that go into each stage and those that the last one returns."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows, toxic = given
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int(r[0] in toxic)) for r in rows]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        assert k == 4 or result.columns == docs.columns
        out.append([tuple(r) for r in docs.collect()])
        result.write.parquet(f"{folder}/stage-{k}")
        docs = spark.read.parquet(f"{folder}/stage-{k}")
    return [*out, docs.collect()], folder


def test_toxic_documents_go_and_clean_ones_stay(given, stages):
    rows, toxic = given
    assert sorted(r[0] for r in stages[0][1]) == sorted(r[0] for r in rows if r[0] not in toxic)


def test_one_of_equal_texts_stays(stages):
    before, after = stages[0][1:3]
    first = {}
    for r in before:
        key = WHITE.sub(" ", r[1] or "")
        first[key] = min(first.get(key, r[0]), r[0])
    assert sorted(r[0] for r in after) == sorted(first.values())


def test_one_of_near_copies_stays(stages):
    before, after = stages[0][2:4]
    rows = [r[:2] for r in before]
    want = sorted(i for (i, _), c in zip(rows, first_of_near_copies(rows)) if i == c)
    assert sorted(r[0] for r in after) == want and len(want) < len(before)


def test_sources_come_near_their_targets(stages):
    before, after = stages[0][3:5]
    sizes, taken, most = Counter(), Counter(), max(size(r[1]) for r in before)
    for r in before:
        sizes[r[3]] += size(r[1])
    for r in after:
        taken[r[3]] += size(r[1])
    assert all(abs(taken[s] - t) <= most for s, t in brute_targets(dict(sizes)).items())
    times = Counter(after)
    assert set(times) <= set(before) and set(times.values()) <= {1, 2}


def test_every_id_of_the_mix_is_packed_once_per_copy(stages):
    before, after = stages[0][4:6]
    encoder, text, copies = Encoder(tokenizer_path("word_bpe_49k.json")), {r[0]: r[1] for r in before}, Counter(r[0] for r in before)
    ids = {i: np.array([*encoder.ids(t or ""), 1], "<u4") for i, t in text.items()}
    packed, fill = {i: np.zeros(len(x), int) for i, x in ids.items()}, {}
    for r in sorted(after, key=lambda r: (r.sequence_id, r.offset)):
        assert r.doc_tokens == len(ids[r.doc_id]) and r.offset == fill.get(r.sequence_id, 0)
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        packed[r.doc_id][r.start : r.start + r.length] += 1
        fill[r.sequence_id] = r.offset + r.length
    assert all((packed[i] == n).all() for i, n in copies.items())
    assert all(n == 2048 or n & (n - 1) == 0 for n in fill.values())


def test_run_gives_the_same_pieces(spark, stages):
    after, folder = stages[0][5], stages[1]
    key = lambda rows: Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0)
    assert key(corpus_pipeline.run(spark, folder).collect()) == key(after)


def runs(text):
    words = [w.lower() for w in WHITE.split(text or "") if w]  # the planted texts are ASCII
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def first_of_near_copies(rows):
    """Smallest id of each row's group, for texts that share 0.8 of their runs of five words."""
    sets, group = [(i, runs(t)) for i, t in rows], list(range(len(rows)))
    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and 5 * len(x & y) >= 4 * len(x | y):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return [min(i for (i, _), h in zip(rows, group) if h == g) for g in group]


def test_near_copies_share_four_fifths_of_five_word_runs(spark, docs, tmp_path):
    rng = random.Random(12)
    rows = []
    for f, changed in enumerate([0, 1, 2, 3, 4, 5, 6, 8] * 3):
        words = [f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(140)]
        copy = list(words)
        for k in range(changed):  # each changes five runs, apart from each other
            copy[10 + 12 * k] = f"x{f}y{k}"
        rows += [(100 * f, " ".join(words)), (100 * f + 1, " ".join(copy))]
    rows += [(9000, None), (9001, ""), (9002, "two words"), (9003, "TWO words")]
    want = sorted(i for (i, _), c in zip(rows, first_of_near_copies(rows)) if i == c)
    looser = sorted(i for i, _, c in near_copies(rows) if i == c)
    assert set(want) < set(looser)
    kept = corpus_pipeline.apart(spark, docs(*rows), str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_an_empty_pipeline_gives_no_pieces(spark, docs, tmp_path):
    none = docs((1, "a")).filter("false").select("doc_id", "text", "lang", "source", "n_chars")
    none.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_each_stage_alone_takes_whole_texts_in_small_batches(spark, stages, k):
    batch, folder = "spark.sql.execution.arrow.maxRecordsPerBatch", stages[1]
    docs = spark.read.parquet(f"{folder}/documents.parquet" if k == 0 else f"{folder}/stage-{k - 1}")
    before = spark.conf.get(batch)
    try:
        spark.conf.unset(batch)
        corpus_pipeline.STAGES[k][1](spark, docs, folder)
        assert int(spark.conf.get(batch)) <= 1000
    finally:
        spark.conf.set(batch, before)


def test_a_worker_keeps_nothing_of_an_ended_task():
    class Cache(dict):
        """Refers to itself, as a cache that is filled by its owner's method does."""

    left = []

    def run(batches):
        cache = Cache()
        cache["own"] = cache
        left.append(weakref.ref(cache))
        yield from batches

    given = [pa.record_batch({"a": [1, 2]}), pa.record_batch({"a": [3]})]
    assert list(lean(run)(iter(given))) == given
    ended_early = lean(run)(iter(given))
    next(ended_early)
    ended_early.close()
    assert [r() for r in left] == [None, None]
