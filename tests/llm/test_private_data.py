import math
import random
import re

import pytest

from stopline.llm import private_data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def real(kind, mention):
    digits = [int(c) for c in mention if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in mention.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return True


def brute(text):
    text = text or ""
    return [(k, *m.span()) for k, p in BASE.items() for m in re.finditer(p, text, re.ASCII) if real(k, m.group())]


@pytest.mark.parametrize("letters", ["a1.@ ", "0123456789 -", "+1() .-2", "1.2.@a+ -é\n", "25.0 "])
def test_base_spans_equal_plain_patterns(letters):
    rng = random.Random(letters)
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert private_data.base_spans(text) == brute(text), text


def test_real_documents_equal_plain_patterns(sample):
    got = {(r.doc_id, r.base, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in private_data.find(sample).collect()}
    want = set()
    for r in sample.collect():
        spans = brute(r.text)
        counts = [sum(s[0] == k for s in spans) for k in BASE]
        want.add((r.doc_id, ",".join(f"{k}:{a}:{b}" for k, a, b in spans), *counts))
    assert got == want


def planted():
    """A surname near one address in different contexts, and unrelated texts."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    rows = [(k, f"{word()} {word()} Quillabert wrote k.q@mail.example about {word()} and {word()}") for k in range(5)]
    rows += [(100 + k, f"{word()} {word()} {word()} a@b{k}.example {word()}") for k in range(30)]
    return rows + [(200, "later Quillabert left"), (201, "nothing here"), (202, None), (203, ""), (203, "")]


def test_terms_that_disclose_an_entity_are_marked_and_generalised(docs):
    df = docs(*planted())
    found = private_data.find(df)
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(planted())
    assert got[200].base == "" and got[200].spans == "term:6:16"
    assert all("term:" in got[k].spans and got[k].n_email == 1 for k in range(5))
    assert (got[201].spans, got[202].spans, got[203].spans) == ("", "", "")
    for r in got.values():
        assert r.spans.startswith(r.base)
    ids = df.filter("doc_id <> 203")
    clean = {r.doc_id: r.text for r in private_data.sanitise(ids, private_data.find(ids)).collect()}
    assert clean[200] == "later [NAME] left" and clean[201] == "nothing here" and clean[202] is None
    assert "mail.example" not in clean[0] and "Quillabert" not in clean[0]


def test_copies_of_one_context_disclose_nothing(docs):
    rows = [(k, "the same Quillabert wrote k.q@mail.example again and again") for k in range(20)] + [(99, "Quillabert")]
    assert {r.doc_id: r.spans for r in private_data.find(docs(*rows)).collect()}[99] == ""


@pytest.mark.parametrize("vary", [False, True])
def test_copies_of_disclosing_texts_do_not_hide_their_terms(docs, vary):
    """Copies as they are, and the same passages in texts that differ far from the mention."""
    rows = planted()
    far = lambda n: f" {'so ' * 200}end{n}" if vary else ""
    rows += [(1000 * (n + 1) + k, t + far(n)) for n in range(60) for k, t in rows[:5]]
    rows += [(100_000 + n, "later Quillabert left") for n in range(60)]
    got = {r.doc_id: r.spans for r in private_data.find(docs(*rows)).collect()}
    assert got[200] == got[100_007] == "term:6:16" and len(got) == len(rows) - 1
    assert all("term:" in got[k] and "term:" in got[1000 + k] for k in range(5))
    assert all("term:" not in got[100 + k] for k in range(30))


def test_empty_table_and_long_text(docs):
    assert private_data.find(docs((1, "a")).filter("false")).collect() == []
    (row,) = private_data.find(docs((1, "word " * 200_000 + "x@y.zz"))).collect()
    assert row.spans == "email:1000000:1000006" and row.n_email == 1


def brute_terms(rows, alpha=0.8, min_support=3):
    """(entity, term) by plain counting over different texts."""
    texts = {t or "" for _, t in rows}
    holds, near, terms = {}, {}, {}
    for text in texts:
        terms[text] = private_data.whole_terms(text)
        for name, context, around in private_data.contexts(text, private_data.base_spans(text)):
            holds.setdefault(name, {}).setdefault(text, set()).add(context)
            for t in around:
                near.setdefault((name, t), set()).add(context)
    found = set()
    for name, by_text in holds.items():
        if len(set().union(*by_text.values())) < min_support:
            continue
        own = -math.log2(len(by_text) / len(texts))
        for t in set().union(*(terms[x] for x in by_text)):
            with_both = [x for x in by_text if t in terms[x]]
            support = max(len({min(by_text[x]) for x in with_both}), len(near.get((name, t), ())))
            every = max(sum(t in set(private_data.TERMS.findall(x.lower())) for x in texts), len(with_both))
            mutual = math.log2(len(with_both) * len(texts) / (len(by_text) * every))
            if support >= min_support and own > 0 and mutual >= alpha * own - 1e-12:
                found.add((name, t))
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_disclosing_terms_equal_plain_counting(docs, seed):
    rng = random.Random(seed)
    common, rare = [f"w{k}" for k in range(60)], [f"r{k}" for k in range(25)]
    mails = [f"m{k}@x.example" for k in range(6)]
    rows = []
    for k in range(220):
        words = rng.choices(common, k=rng.randint(3, 80)) + rng.choices(rare, k=rng.randint(0, 2))
        if rng.random() < 0.4:
            m = rng.randrange(6)
            words += [mails[m]] * rng.randint(1, 2) + ([rare[m]] if rng.random() < 0.9 else [])
        rng.shuffle(words)
        rows += [(k, " ".join(words))] * rng.choice([1, 1, 1, 4])
    want = brute_terms(rows)
    found = private_data.disclosing_terms(docs(*rows)).collect()
    assert len(want) >= 3 and {(r.entity, r.term) for r in found} == {(e, private_data.key_of(t)) for e, t in want}


def test_a_term_far_from_every_mention_is_found(docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(4))
    some = lambda n: " ".join(word() for _ in range(n))
    rows = [(k, f"Quillabert {some(300)} wrote k.q@mail.example to {some(40)}") for k in range(5)]
    rows += [(100 + k, some(50)) for k in range(40)] + [(200, "so Quillabert left")]
    got = {r.doc_id: r.spans for r in private_data.find(docs(*rows)).collect()}
    assert got[200] == "term:3:13" and all("term:0:10" in got[k] for k in range(5))
