import hashlib
import random

import pytest

from stopline.llm import suffix_dedup as sd


def brute(rows, length=200):
    """Every start of every text in a dictionary of strings."""
    seen = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, t in data:
        for k in range(len(t) - length + 1):
            seen[t[k : k + length]] = seen.get(t[k : k + length], 0) + 1
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        rest = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def noise(rng, n, letters="abcdefghij klmnop é"):
    return "".join(rng.choice(letters) for _ in range(n))


def planted(seed):
    rng = random.Random(seed)
    passages = [noise(rng, n) for n in (199, 200, 201, 230, 260, 320, 390, 500, 900)]
    rows = []
    for k in range(60):
        parts = [noise(rng, rng.randint(0, 300))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            cut = rng.randint(0, 40) if rng.random() < 0.4 else 0
            parts += [p[cut:], noise(rng, rng.randint(0, 90))]
        rows.append((k, "".join(parts)))
    for k in range(60, 75):  # near copies with a few edits
        text = list(rows[k % 7][1] + passages[-1])
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = "#"
        rows.append((k, "".join(text)))
    return rows


EDGES = [
    (1, None), (2, ""), (3, "x" * 199), (4, "y" * 200), (5, "z" * 201), (6, "z" * 200), (7, "ab" * 400), (8, "line of text\n" * 60),
    (9, "q" * 150 + "é" * 150), (10, "\0" * 300), (11, "é" * 150),
]


@pytest.mark.parametrize("rows", [planted(1), planted(2), EDGES], ids=["one", "two", "edges"])
def test_equals_brute_force(docs, rows):
    got = sd.remove_repeats(docs(*rows), keep_text=True).collect()
    assert sorted(tuple(r)[:4] for r in got) == brute(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_many_ranges_segments_and_small_blocks(docs, monkeypatch):
    rows = planted(3)
    rows.append((99, "".join(t for _, t in planted(3)[:40])))
    monkeypatch.setattr(sd, "BLOCK", 10)
    spans = sd.repeated_spans
    monkeypatch.setattr(sd, "repeated_spans", lambda r: spans(r, bits=8, entries_per_range=20))
    got = sd.remove_repeats(docs(*rows)).collect()
    assert sorted(tuple(r)[:4] for r in got) == brute(rows)
    parts = list(sd.segments([b"a" * 1000, b"b" * 199, b"c" * 200], size=300))
    assert [len(p) for s in parts for p in s[0]] == [499, 499, 400, 200] and [o for s in parts for o in s[2]] == [0, 300, 600, 0]


def test_sample_equals_brute_force(sample):
    few = sample.filter("doc_id < 80")
    assert sorted(tuple(r)[:4] for r in sd.remove_repeats(few).collect()) == brute([(r.doc_id, r.text) for r in few.collect()])


def test_repeated_rows_and_empty_table(docs):
    rows = [(1, "k" * 50 + "abc" * 80), (1, "k" * 50 + "abc" * 80), (2, "other")]
    assert sorted(tuple(r)[:4] for r in sd.remove_repeats(docs(*rows)).collect()) == brute(rows)
    assert sd.remove_repeats(docs((1, "a")).filter("false")).collect() == []


def test_loser_tree_merges_with_right_prefixes():
    rng = random.Random(4)
    runs, every = [], []
    for _ in range(7):
        strings = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(0, 40)))
        every += strings
        runs.append(sd.decoded(sd.front_coded([(s, b"", [0, 0]) for s in strings])))
    got = list(sd.merged(runs))
    assert [e[1] for _, e in got] == sorted(every)
    assert all(h == sd.common(a[1], b[1]) for (_, a), (h, b) in zip(got, got[1:]))
    assert list(sd.merged([])) == []
