"""Personal data: fixed patterns, and information-theoretic sanitisation of what gives them away.

The patterns find protected entities. A term that stands in the same texts as an entity, near its
mention or far from it, discloses it if knowing the term removes most of the uncertainty about the entity:
with counts over all different texts, the term's pointwise mutual information with the entity is at least
``alpha`` times the entity's own information. Support is counted over different contexts of the
mentions, so copies of one passage say nothing; copies of a text count as one everywhere, so they
neither add to nor take from what a term tells. Such terms are marked wherever they occur; ``sanitise``
generalises or removes all marks.

A first pass finds mentions. Entities with too few different contexts can have no disclosing term; the
texts of all others are read again whole for their terms. How often a term occurs in the
corpus is counted for terms in supported pairs alone: a bit filter sized by their number tells the scan
which words may be needed, and a join settles it exactly. A second one tells which texts may have copies;
only those send their terms with the text's hash, to be counted once. Nothing that grows with the
corpus is broadcast or sent to the driver.

Defined results: a null text is empty and has no spans. Offsets are code points, end exclusive.
A mark on a term never overlaps a pattern's span. Rows that repeat an id and text get the same
spans. Whole texts are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import bit_filter, filter_bits, stage, text_of, tidy
from stopline.llm.vocabulary import Bounded

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WINDOW_TERMS = 6
REACH = 400
MIN_SUPPORT = 3
ALPHA = 0.8
ROOM = 100_000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always takes its digit run to the end, so the next one starts at the start of a run.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]{2}|[0-9][\x20-][0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
TERMS = re.compile(r"\w+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign and dotted domain, found from the at signs: the
    local part is the longest run before the sign, back to the end of the previous match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the fixed patterns, by kind as listed, then start."""
    spans = [("email", a, b) for a, b in emails(text)]
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                spans.append(("ip", *m.span()))
    if DIGITS.search(text):
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def entity(kind: str, mention: str) -> str:
    """One name for all ways to write the same entity."""
    return f"{kind}:{mention.lower() if kind in ('email', 'ip') else NOT_DIGIT.sub('', mention)}"


def key_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def contexts(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, set[str]]]:
    """For each mention: its entity, a hash of the terms around it, and those terms."""
    taken = sorted((a, b) for _, a, b in spans)
    for kind, a, b in spans:
        before = [m for m in TERMS.finditer(text, max(0, a - REACH), a)][-WINDOW_TERMS:]
        after = [m for m in TERMS.finditer(text, b, b + REACH)][:WINDOW_TERMS]
        near = [m.group().lower() for m in before + after if not _inside(m.span(), taken)]
        yield entity(kind, text[a:b]), key_of(" ".join(near)), set(near)


def _inside(span: tuple[int, int], taken: list[tuple[int, int]]) -> bool:
    return any(a < span[1] and span[0] < b for a, b in taken)


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entity, context, text and the terms around, for every mention."""
    for batch in batches:
        out = {}
        for text, key in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist()):
            for name, context, terms in contexts(text, base_spans(text)):
                out[name, context, key] = sorted(map(key_of, terms))
        names, seen, keys = zip(*out) if out else ((), (), ())
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        columns = [pa.array(c, k) for c, k in zip((names, seen, keys, list(out.values())), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["entity", "context", "key", "near"])


def whole_terms(text: str) -> set[str]:
    """All terms of a text outside its base spans."""
    parts, done = [], 0
    for a, b in sorted((a, b) for _, a, b in base_spans(text)):
        parts += [text[done : max(done, a)], " "]
        done = max(done, b)
    return {w.lower() for w in TERMS.findall("".join([*parts, text[done:]]))}


def _terms(shared, bits: int):
    """(key, term) of the texts that the bit filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value.tobytes()
        for batch in batches:
            for text, key in zip(batch.column("text"), batch.column("key").to_pylist()):
                if maybe(words, bits, key):
                    terms = [key_of(t) for t in whole_terms(text.as_py())]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(terms), pa.int64()), pa.array(terms, pa.int64())], names=["key", "term"])

    return run


def supported_pairs(texts: DataFrame, min_support: int) -> tuple[DataFrame, DataFrame] | None:
    """(entity, term, together) of pairs with enough different contexts, and (entity, mentions).

    A pair's contexts are those of mentions that the term stands near, or one for each text that holds
    both, however far apart, where equal contexts count once."""
    spark = texts.sparkSession
    seen = texts.mapInArrow(_mentions, "entity string, context long, key long, near array<long>")
    seen = stage(seen, "pii-mentions")
    entities = seen.groupBy("entity").agg(F.count_distinct("context").alias("contexts"), F.count_distinct("key").alias("mentions"))
    entities = stage(entities.filter(F.col("contexts") >= min_support).select("entity", "mentions"), "pii-entities")
    if entities.isEmpty():
        return None
    known = stage(seen.join(entities.select("entity"), "entity"), "pii-known")
    beside = known.select("entity", "context", F.explode("near").alias("term")).groupBy("entity", "term")
    beside = beside.agg(F.count_distinct("context").alias("beside"))
    held = stage(known.groupBy("entity", "key").agg(F.min("context").alias("context")), "pii-held")
    keys = held.select("key").distinct()
    bits = filter_bits(keys.count())
    may = spark.sparkContext.broadcast(filter_words(keys, "key", bits))
    terms = texts.mapInArrow(_terms(may, bits), "key long, term long").distinct()
    both = held.join(terms, "key").groupBy("entity", "term")
    both = both.agg(F.count_distinct("context").alias("far"), F.count_distinct("key").alias("together"))
    enough = F.greatest("far", F.coalesce("beside", F.lit(0))) >= min_support
    pairs = both.join(beside, ["entity", "term"], "left").filter(enough).select("entity", "term", "together")
    return stage(pairs, "pii-pairs"), entities


def filter_words(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """The bit filter as one array of 2**bits bits on the driver."""
    words = np.zeros(max(1, 1 << bits >> 6), np.int64)
    for r in bit_filter(keys, key, bits).toLocalIterator():
        words[r.word] = r.mask
    return words.view(np.uint64)


def maybe(bitmap: bytes, bits: int, key: int) -> bool:
    """Whether the key may be in a filter whose words are given as little-endian bytes."""
    slot = key & ((1 << bits) - 1)
    return bool(bitmap[slot >> 3] >> (slot & 7) & 1)


class _Wanted:
    """Keys of the words that may be in the filter, remembered per worker."""

    def __init__(self, bitmap: bytes, bits: int):
        def look(word: str) -> int | None:
            key = key_of(word)
            return key if maybe(bitmap, bits, key) else None

        self.known = Bounded(look, 150_000)

    def __call__(self, word: str) -> int | None:
        return self.known[word]


def _occurring(shared, bits: int, copied, copied_bits: int):
    """Per batch: in how many texts each wanted term occurs. A text that may have copies gives its
    terms with its ``key``, every other text counts at once and without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, copies, done = _Wanted(shared.value.tobytes(), bits), copied.value.tobytes(), set()
        for batch in batches:
            counts: dict[tuple[int, int | None], int] = {}
            for text, key in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist()):
                if key in done:
                    continue
                name = key if maybe(copies, copied_bits, key) else None
                if name is not None:
                    if len(done) >= ROOM:
                        done.clear()
                    done.add(key)
                for term in {wanted(w) for w in set(TERMS.findall(text.lower()))}:
                    if term is not None:
                        counts[term, name] = counts.get((term, name), 0) + 1
            terms, names = zip(*counts) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.int64()), pa.array(names, pa.int64()), pa.array(list(counts.values()), pa.int64())],
                names=["term", "key", "n"],
            )

    return run


def disclosing_terms(
    docs: DataFrame, text_col: str = "text", alpha: float = ALPHA, min_support: int = MIN_SUPPORT, bits: int | None = None
) -> DataFrame:
    """(entity, term, together, mentions, texts, information, mutual) of the terms that disclose an entity."""
    spark = docs.sparkSession
    texts = docs.select(text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("key"))
    found = supported_pairs(texts, min_support)
    kind = "entity string, term long, together long, mentions long, texts long, information double, mutual double"
    if found is None or found[0].isEmpty():
        return spark.createDataFrame([], kind)
    pairs, entities = found
    names = pairs.select("term").distinct()
    n = bits or filter_bits(names.count())
    wanted = spark.sparkContext.broadcast(filter_words(names, "term", n))
    different = stage(texts.groupBy("key").count(), "pii-texts")
    repeated = different.filter("count > 1").select("key")
    m = bits or filter_bits(repeated.count())
    copied = spark.sparkContext.broadcast(filter_words(repeated, "key", m))
    counted = texts.mapInArrow(_occurring(wanted, n, copied, m), "term long, key long, n long")
    # of a text that may have copies one row counts
    counted = counted.groupBy("term", "key").agg(F.when(F.col("key").isNull(), F.sum("n")).otherwise(1).alias("n"))
    frequency = counted.groupBy("term").agg(F.sum("n").alias("texts"))
    total = float(max(different.count(), 1))
    joined = pairs.join(entities, "entity").join(frequency, "term")
    # a word that lower case alters may be counted under another spelling
    joined = joined.withColumn("texts", F.greatest("texts", "together"))
    own = -F.log2(F.col("mentions") / F.lit(total))
    mutual = F.log2(F.col("together") * F.lit(total) / (F.col("mentions") * F.col("texts")))
    named = joined.withColumns({"information": own, "mutual": mutual}).select(*(c.split()[0] for c in kind.split(", ")))
    return named.filter((F.col("information") > 0) & (F.col("mutual") >= alpha * F.col("information")))


def _marked(shared, bits: int):
    """Base spans of every row, and occurrences of terms that may disclose an entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        wanted = _Wanted(words.tobytes(), bits) if words.any() else None
        span = pa.list_(pa.struct([("term", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            base, counts, terms = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                base.append(written(spans))
                counts.append([sum(k == kind for k, _, _ in spans) for kind in KINDS])
                found = []
                low = text.lower()
                hits = {w: k for w in set(TERMS.findall(low)) if (k := wanted.known[w]) is not None} if wanted else {}
                if hits:
                    taken = [(a, b) for _, a, b in spans]
                    # where lower case changes the length, words may be cut elsewhere than in the text
                    find = hits.get if len(low) == len(text) else wanted
                    for m in TERMS.finditer(text):
                        key = find(m.group().lower())
                        if key is not None and not _inside(m.span(), taken):
                            found.append({"term": key, "a": m.start(), "b": m.end()})
                terms.append(found)
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rid"), pa.array(base, pa.string()), *columns, pa.array(terms, span)],
                names=["doc_id", "rid", "base", *[f"n_{k}" for k in KINDS], "terms"],
            )

    return run


@tidy
def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    alpha: float = ALPHA,
    min_support: int = MIN_SUPPORT,
    bits: int | None = None,
) -> DataFrame:
    """One row per input row: doc_id, a count per kind, ``base`` and ``spans`` (kind:start:end, joined)."""
    spark = docs.sparkSession
    disclosing = disclosing_terms(docs, text_col, alpha, min_support, bits).select("term").distinct()
    disclosing = stage(disclosing, "pii-terms")
    bits = bits or filter_bits(disclosing.count())
    words = filter_words(disclosing, "term", bits)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), F.xxhash64(id_col, text_of(text_col)).alias("rid")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, rid long, base string, {', '.join(f'n_{k} long' for k in KINDS)}, terms array<struct<term:long,a:long,b:long>>"
    marked = rows.mapInArrow(_marked(spark.sparkContext.broadcast(words), bits), schema)
    columns = ["doc_id", *[f"n_{k}" for k in KINDS], "base"]
    if not words.any():
        return marked.select(*columns, F.col("base").alias("spans"))
    marked = stage(marked, "pii-marks")
    flat = marked.filter(F.size("terms") > 0).select("rid", F.explode("terms").alias("t")).select("rid", "t.*").distinct()
    real = flat.join(disclosing, "term").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("more"))
    text = F.array_join(F.transform("more", lambda s: F.concat(F.lit(f"{TERM}:"), s.a.cast("string"), F.lit(":"), s.b.cast("string"))), ",")
    joined = marked.join(real, "rid", "left")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.col("more").isNotNull(), text))
    return joined.select(*columns, spans.alias("spans"))


def replace(text: str | None, spans: str) -> str:
    """The text with every span generalised: a pattern to its kind, a term to what it looks like."""
    text, parts, done = text or "", [], 0
    marks = [s.split(":") for s in spans.split(",") if s]
    for start, end, kind in sorted((int(a), int(b), k) for k, a, b in marks):
        if start < done:
            continue
        mention = text[start:end]
        general = kind if kind != TERM else "number" if mention.isdigit() else "name" if mention[:1].isupper() else "term"
        parts += [text[done:start], f"[{general.upper()}]"]
        done = end
    return "".join([*parts, text[done:]])


def _replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [replace(t, s) if s else t for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def sanitise(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with all spans generalised. ``found`` comes from ``find``; ids must be unique."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = rows.join(found.select("doc_id", "spans"), "doc_id").select("doc_id", "text", "spans")
    return joined.mapInArrow(_replaced, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def information(part: float, whole: float) -> float:
    """Bits needed to know that one of ``whole`` is among ``part``."""
    return -math.log2(part / whole)
