import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stopline.llm import alignment
from stopline.llm.vocabulary import tokenizer_path

ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "don't we'll", "x<|endoftext|>y", "<s>a</s>", "<0x41>", "İstanbul ΣΣ é 中文 \U0001f600",
    "a▁b", "▁", "\x00\x01", "tab\tand nbsp", "1234 5.6,7 -- ??", "\x1c\x0b\x85", "½ ² ª º µ 　 ", "z" * 5000, "word " * 3000, "a b", "a b",
    "décomposed é", "     five", "﻿bom ​zero", "日本語のテキスト。次の文", "ﬁ ligature Å",
]


def letters():
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    decode = letters()

    def tokens(text):
        """[(id, bytes)] of both, by the libraries alone; none if the bytes differ."""
        want = b" " + (text or "").encode()
        one = [(i, bytes(decode[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)] if text else []
        return (one, two) if text and all(b"".join(t[1] for t in s) == want for s in (one, two)) else ([], [])

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, b in tokens:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def brute(rows, tokens):
    seen, holders = [], Counter()
    for doc, text in rows:
        a, b = map(spans, tokens(text))
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 2000 else near(a, b)
        holders.update(set(links))
        seen.append((doc, a, b, links))
    best = defaultdict(int)
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for doc, a, b, links in seen:
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(t[0]) for t in side if start <= t[1] < cut) for side in (a, b)) if len(a) < 2000 else None)
            start = cut
        said = ";".join(groups) if None not in groups else None
        n_best = sum(holders[p] == best[p[0]] for p in links)
        out.append((doc, len(a), len(b), len(cuts), len(links), n_best, sum(holders[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if said else said))
    return out


def near(a, b):
    links, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return links


def same(got, want):
    got = sorted(map(tuple, got), key=str)
    want = sorted(want, key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])


@pytest.mark.parametrize("table", [1 << 20, 7, 0])
def test_equals_brute_force_by_the_libraries(docs, library, table):
    rows = list(enumerate(ODD)) + [(3, "a b"), (None, "a b")]  # repeated ids and rows are documents of their own
    same(alignment.align(docs(*rows), table_pairs=table).collect(), brute(rows, library))


def test_sample(sample, library):
    rows = [(r.doc_id, r.text) for r in sample.collect() if len(r.text or "") < 3000]
    small = sample.filter("length(coalesce(text, '')) < 3000")
    want = brute(rows, library)
    for table in (1 << 20, 500):
        same(alignment.align(small, table_pairs=table).collect(), want)


def test_ids_are_the_librarys(library):
    rng = np.random.default_rng(3)
    side = alignment.ByteSide(tokenizer_path("byte_bpe_50k.json"))
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    alphabet = list("aeiouthsrnl '\n\t.0123-ÄéßŁ中\U0001f600́  ") + [" the", "ing", "<|endoftext|>", "'s", "  "]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet, rng.integers(1, 40)))
        assert side.ids(text) == a.encode(" " + text, add_special_tokens=False).ids


def test_intervals_coalesce_where_both_end():
    a, b = alignment.coalesce(np.array([2, 3, 6, 9]), np.array([1, 3, 4, 5, 9]))
    assert a.tolist() == [0, 0, 1, 1] and b.tolist() == [0, 0, 1, 1, 1]
    links = list(zip(*(x.tolist() for x in alignment.overlaps(np.array([2, 3, 6, 9]), np.array([1, 3, 4, 5, 9])))))
    assert links == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3), (2, 4), (3, 4)]


def test_groups_string_names_and_empty_table(docs, spark):
    df = spark.createDataFrame([("x", "hello wörld", 1, 2)], "id string, body string, row int, pairs int")
    row = alignment.align(df, "id", "body", groups=True).first()
    assert row.id == "x" and hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.groups.count(";") + 1 == row.n_groups
    assert alignment.align(docs((1, "a")).filter("false")).collect() == []
