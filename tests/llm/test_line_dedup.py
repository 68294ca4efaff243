import string

import pytest

from stopline.llm import line_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
HOT = "a line that every document holds"


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, min_chars=10, min_documents=2):
    holders = {}
    order = lambda i: (i is None, i or 0)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = []
        for line in lines:
            ids = holders.get(key(line), set())
            if len(ids) < min_documents or i == min(ids, key=order):
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


ROWS = [
    (1, f"{HOT}\nonly here in one\n{HOT}"), (2, f"  {HOT.upper()}\t\nshort\nshort\n"), (3, None), (4, ""), (5, "\n"), (6, HOT),
    (7, "ÄÖÜ äöü ß\n\nÄÖÜ äöü ß "), (8, "äöü äöü ß "), (9, "ÄÖÜ äöü ß"), (10, "123456789\n1234567890"), (11, "1234567890\n123456789"),
    (12, "\x0b1234567890\x0c\r\n 1234567890"), (13, " 1234567890"), (14, "same in itself\nsame in itself"),
    (20, "x" * 300_000 + "\n" + HOT), (21, "x" * 300_000 + "\n" + HOT), (22, "\n".join(f"line number {k}" for k in range(20_000))),
    (23, "\n".join(f"Line number {k} " for k in range(0, 20_000, 3)) + "\nown line of this"), (24, "𝔘𝔫𝔦𝔠𝔬𝔡𝔢𝔘𝔫"), (25, "𝔘𝔫𝔦𝔠𝔬𝔡𝔢𝔘𝔫"),
    (26, "𝔘𝔫𝔦𝔠𝔬𝔡𝔢𝔘"), (27, "𝔘𝔫𝔦𝔠𝔬𝔡𝔢𝔘"),
]


@pytest.mark.parametrize("min_documents", [2, 3])
@pytest.mark.parametrize("share", [1000, 3])
def test_equals_brute_force(docs, monkeypatch, share, min_documents):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", share)  # which keys are broadcast changes no result
    got = line_dedup.drop_repeated_lines(docs(*ROWS), min_documents=min_documents).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS, min_documents=min_documents)


def test_repeated_rows_and_null_ids(docs):
    rows = [(1, HOT), (1, HOT), (1, HOT + "\nmore than that"), (None, HOT), (None, "more than that"), (None, "more than that"), (None, "null ids only\n."), (None, "null ids only")]
    got = line_dedup.drop_repeated_lines(docs(*rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_string_ids_and_names(docs):
    df = docs(*ROWS).selectExpr("cast(doc_id as string) as id", "text as body", "sig", "1 as pos", "2 as lines", "3 as drop")
    got = line_dedup.drop_repeated_lines(df, "id", "body").collect()
    assert sorted(map(tuple, got), key=str) == brute([(str(i), t) for i, t in ROWS]) and got[0].asDict().keys() == {"id", "n_lines", "n_dropped", "kept"}


def test_sample_and_empty_table(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    got = sorted(map(tuple, line_dedup.drop_repeated_lines(sample).collect()), key=str)
    assert got == brute(rows) and any(r[2] for r in got)
    assert line_dedup.drop_repeated_lines(sample.filter("false")).collect() == []
