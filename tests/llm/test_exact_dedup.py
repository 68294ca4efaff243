import hashlib
import re

from stopline.llm import exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return sorted(
        (i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest())
        for i, t in rows
    )


LONG = "x" * 100
ROWS = [
    (1, "a b"), (2, "a  b"), (3, "a\t\nb"), (4, None), (5, ""), (6, " "), (7, LONG + "p"), (8, LONG + "q"), (9, LONG + "p"),
    (10, " a b"), (11, "a b"), (12, "y" * 200_000), (13, "y" * 200_000), (14, "y" * 199_999 + "z"), (20, "é"), (21, "é"),
]


def test_marks_equal_brute_force(docs):
    got = exact_dedup.mark(docs(*ROWS), digest=True).collect()
    assert sorted(map(tuple, got)) == brute(ROWS)


def test_a_saturated_filter_changes_nothing(docs):
    got = exact_dedup.mark(docs(*ROWS), digest=True, bits=6, prefix_chars=1).collect()
    assert sorted(map(tuple, got)) == brute(ROWS)


def test_one_row_of_each_group_stays_with_all_its_columns(docs):
    df = docs(*ROWS, (1, "a b"), (11, "a b"))
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[1] for r in brute(ROWS)})


def test_null_ids_and_empty_table(docs):
    got = exact_dedup.mark(docs((None, "a"), (None, "a"), (3, "a"), (None, "b"))).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 3, 3, False), (None, 3, 3, False), (3, 3, 3, True), (None, None, 1, True)], key=str
    )
    assert exact_dedup.mark(docs((1, "a")).filter("false")).collect() == []
    assert exact_dedup.deduplicate(docs((1, "a")).filter("false")).collect() == []


def test_any_id_any_column_any_name(spark):
    rows = [("b", "x y", {"k": 1}, "kept"), ("a", "x  y", {"k": 2}, "kept"), ("a", "x  y", {"k": 3}, "kept"), (None, "z", None, None), ("c", "w" * 70, {}, "")]
    df = spark.createDataFrame(rows, "id string, text string, m map<string, int>, _x_norm string").selectExpr("*", "'r' as row", "1 as hash", "2 as maybe")
    got = {(r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark(df, "id").collect()}
    assert got == {("b", "a", 3, False), ("a", "a", 3, True), (None, None, 1, True), ("c", "c", 1, True)}
    for _ in range(2):
        kept = exact_dedup.deduplicate(df, "id").collect()
        assert kept[0].asDict().keys() == {*df.columns} and sorted(str(r.id) for r in kept) == ["None", "a", "c"]
        assert {r["_x_norm"] for r in kept} == {"kept", None, ""}
    assert [r.m for r in kept if r.id == "a"] == [r.m for r in exact_dedup.deduplicate(df.repartition(5), "id").collect() if r.id == "a"]


def test_a_large_group_is_dealt_out(docs, monkeypatch):
    rows = [(k, "same text" if k % 3 else f"own text {k}") for k in range(3000)]
    got = exact_dedup.mark(docs(*rows), digest=True).collect()
    assert sorted(map(tuple, got)) == brute(rows)
