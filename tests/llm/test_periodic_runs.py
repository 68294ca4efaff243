import hashlib

import numpy as np
import pytest

from stopline.llm import periodic_runs, queries


def brute(s, min_words, min_repeats):
    """Every maximal stretch of every period, smallest period only."""
    n, out = len(s), {}
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            if j + q - i >= max(min_words, min_repeats * q):
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted((a, m, q) for (a, m), q in out.items())


def as_rows(found):
    return sorted(map(tuple, found.tolist()))


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_all_runs_of_random_sequences(letters):
    rng = np.random.default_rng(letters)
    for n in [1, 2, 3, 5, 8, 13, 40, 90]:
        for _ in range(25):
            s = rng.integers(0, letters, n)
            assert as_rows(periodic_runs.runs_of(s)) == brute(s.tolist(), 2, 2)


def planted(rng):
    words = [b"w%d" % k for k in rng.integers(0, 400, int(rng.integers(0, 120)))]
    for _ in range(int(rng.integers(0, 4))):
        unit = [b"w%d" % k for k in rng.integers(0, int(rng.integers(1, 30)), int(rng.integers(1, 30)))]
        at = int(rng.integers(0, len(words) + 1))
        words[at:at] = (unit * int(rng.integers(2, 7)))[: int(rng.integers(1, 150))]
    return words


@pytest.mark.parametrize("min_words,min_repeats", [(24, 3), (10, 2), (7, 4)])
def test_stretches_hold_every_run(min_words, min_repeats):
    rng, found = np.random.default_rng(7), 0
    for _ in range(400):
        words = planted(rng)
        want = brute(words, min_words, min_repeats)
        assert as_rows(periodic_runs.word_runs(words, min_words, min_repeats)) == want
        found += len(want)
    assert found > 100


def test_extensions_agree_with_a_scan():
    rng = np.random.default_rng(1)
    s = rng.integers(1, 3, 200).tolist()
    depths, places = periodic_runs.SuffixTree(s).tour()
    extend = periodic_runs.Extension(depths, places)
    i, j = rng.integers(0, 201, 500), rng.integers(0, 201, 500)
    i, j = i[i != j], j[i != j]

    def scan(a, b):
        k = 0
        while a + k < 200 and b + k < 200 and s[a + k] == s[b + k]:
            k += 1
        return k

    assert extend(i, j).tolist() == [scan(a, b) for a, b in zip(i.tolist(), j.tolist())]
    assert np.argsort(places).tolist() == sorted(range(201), key=lambda k: [*s, 0][k:])


def expected(doc, text, change):
    words = (text or "").encode().split()
    words = change(doc, words) if change else words
    runs = brute(words, 24, 3)
    dropped = {k for a, m, q in runs for k in range(a + q, a + m)}
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    runs = sorted(runs, key=lambda r: (r[0], r[2]))
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b "), (4, "a " * 23), (5, "a " * 24), (6, "x " + "a b " * 12 + "a"), (7, "a b c d e f g h " * 3), (8, "a b c d e f g h i " * 2 + "a b c d e f g h"),
    (9, "é ü " * 40 + "tail " + "é ü " * 40), (10, "\x85a　b " * 30), (11, "long " * 20_000), (12, " ".join(f"w{k % 300}" for k in range(1000))), (None, "a " * 30), (5, "a " * 24),
]


@pytest.mark.parametrize("change", [None, queries.contract_words])
def test_documents_equal_brute_force(docs, sample, change):
    short = [r for r in ODD if len(r[1] or "") < 20_000]
    rows = short + [(r.doc_id, r.text) for r in sample.collect() if len(r.text or "") < 6000]
    got = periodic_runs.with_digests(periodic_runs.find_runs(docs(*rows), change=change)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(i, t, change) for i, t in rows), key=str)
    assert sum(r.n_runs > 0 for r in got) > 5


def test_very_long_text_names_and_empty_table(docs):
    df = docs(*ODD).selectExpr("cast(doc_id as string) as id", "text as body", "n_chars as runs", "1 as start")
    row = periodic_runs.find_runs(df, "id", "body").filter("id = '11'").first()
    assert (row.n_runs, row.start, row.length, row.period, row.collapsed) == (1, 0, 20_000, 1, "long")
    assert periodic_runs.find_runs(docs((1, "a")).filter("false")).collect() == []
