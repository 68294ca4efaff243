import zlib

import numpy as np
import pytest

from stopline.llm import packing, token_counts
from stopline.llm.vocabulary import Encoder, tokenizer_path

ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n\nb", "don't we'll", "x<|endoftext|>y", "<|startoftext|>",
    "İstanbul ΣΣ é 中文 \U0001f600", "tab\tand nbsp sep", "1234 5.6,7 -- ??", "\x1c\x0b\x85",
    "É è ÀÉ ß ſ ŉ Œ", "word " * 3000, "z" * 5000, "a. \nB", "'s 's's", "end space ", "½ ² ª º µ",
]


def library(name, texts):
    encoder = Encoder(tokenizer_path(name))
    return [encoder.ids(t or "") for t in texts]


@pytest.fixture
def odd(docs):
    return docs(*enumerate(ODD))


def texts_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


@pytest.mark.parametrize("table", ["odd", "sample"])
def test_counts_equal_the_librarys(request, table):
    df = request.getfixturevalue(table)
    texts = texts_of(df)
    want = dict(zip(texts, map(len, library("byte_bpe_50k.json", texts.values()))))
    got = token_counts.count_tokens(df).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert {r.doc_id: r.n_bytes for r in got} == {k: len((t or "").encode()) for k, t in texts.items()}


def test_counts_do_not_depend_on_the_table(sample):
    few = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(sample, table_entries=3).collect()}
    assert few == {r.doc_id: r.n_tokens for r in token_counts.count_tokens(sample).collect()}


@pytest.mark.parametrize("table", ["odd", "sample"])
def test_pieces_give_back_every_id_without_padding(request, table):
    df = request.getfixturevalue(table)
    texts = texts_of(df)
    want = dict(zip(texts, (i + [1] for i in library("word_bpe_49k.json", texts.values()))))
    rows = packing.pack(df).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == len(got.setdefault(r.doc_id, [])) and r.length == len(ids) > 0
        assert r.doc_tokens == len(want[r.doc_id])
        got[r.doc_id] += ids
    assert got == want
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in fill.values())


def test_repeated_rows_are_packed_each_on_its_own(docs):
    rows = packing.with_digest(packing.pack(docs((1, "a b"), (1, "a b"), (2, None)))).collect()
    assert sorted((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == [(1, 3), (1, 3), (2, 1)]
    assert all(r.ids_crc32 == zlib.crc32(np.array([1], "<u4").tobytes()) for r in rows if r.doc_id == 2)


def test_empty_tables(docs):
    none = docs((1, "a")).filter("false")
    assert token_counts.count_tokens(none).collect() == [] and packing.pack(none).collect() == []


def test_sum_of_squares_takes_the_best_level():
    rng, packer = np.random.default_rng(5), packing.SumOfSquares(20)
    for k in range(400):
        length = int(rng.integers(1, 20))
        costs = {}
        for level in range(20 - length + 1):
            if level and not packer.count[level]:
                continue
            after = packer.count.copy()
            if level:
                after[level] -= 1
            if level + length < 20:
                after[level + length] += 1
            costs[level] = int((after**2).sum())
        assert costs[packer.place(length)] == min(costs.values())
        packer.add((k, 0, b"", 0), length)
        assert packer.count[0] == packer.count[20] == 0


def replayed(lengths, window):
    """Closed windows of one task as lists of (doc, start, length), by trying every placement in plain Python."""
    count, open_, closed = {}, {}, []
    for doc, n in lengths:
        whole = n - n % window
        closed += [[(doc, s, window)] for s in range(0, whole, window)]
        rest = n - whole
        if not rest:
            continue
        costs = []
        for level in [0, *sorted(k for k, c in count.items() if c and k + rest <= window)]:
            after = dict(count)
            if level:
                after[level] -= 1
            if level + rest < window:
                after[level + rest] = after.get(level + rest, 0) + 1
            costs.append((sum(c * c for c in after.values()), -level, level, after))
        _, _, level, count = min(costs)
        pieces = open_[level].pop() if level else []
        pieces.append((doc, whole, rest))
        if level + rest == window:
            closed.append(pieces)
        else:
            open_.setdefault(level + rest, []).append(pieces)
    return closed


def test_placement_equals_a_replay_of_one_task(docs):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(rng.choice(["the", "of", "and", "a", "to", "in"], rng.integers(0, 90)))) for k in range(500)]
    df = docs(*rows).orderBy("doc_id").coalesce(1)
    order = [(r.doc_id, r.text) for r in df.collect()]
    encoder = Encoder(tokenizer_path("word_bpe_49k.json"))
    want = replayed([(i, len(encoder.ids(t)) + 1) for i, t in order], 64)
    got = {}
    for r in sorted(packing.pack(df, window=64).collect(), key=lambda r: (r.sequence_id, r.offset)):
        got.setdefault(r.sequence_id, []).append((r.doc_id, r.start, r.length))
    assert list(got.values())[: len(want)] == want and len(want) > 200
