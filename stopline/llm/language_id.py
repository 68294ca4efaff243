"""Language identification by language-bitmask n-gram filters.

Two hashed tables hold one bit per language in each slot: a bit-sliced Bloom filter
over byte n-grams. The bitwise and of an n-gram's two words gives all languages that contain it. A
document's n-grams are looked up, the bits of each language are counted, and each count is
corrected for the false positives that the filter's fill makes likely; the largest share decides.

A language contains an n-gram if its rate there is at least ``keep`` of the highest rate of any
language, so that stray words of another language do not fill a filter. The counts behind it come
from all training texts: every task adds up fixed-size tables, and blocks of them are summed.

Defined results: a null text and one without a letter give ``und`` with score 0. Texts shorter than
an n-gram are padded with spaces. Ties go to the language first by code point. With nothing to
learn from, every text with a letter gives ``und``. Repeated rows are counted and answered each on
its own. A slot has one machine word for every 64 languages. Whole texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import text_of

UNKNOWN = "und"
SLOT_BITS = 17
GRAMS = (3, 4)
KEEP = 0.5
BLOCK = 4096
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]")
# odd multipliers, one per table; n-gram lengths differ by an added constant
MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77))
STEPS = {n: np.uint32(n * 0xC2B2AE3D & 0xFFFFFFFF) for n in GRAMS}
WORD = 64

# ASCII other than letters separates words; one byte per byte, so offsets stay
FOLD = np.arange(256, dtype=np.uint8)
FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(LATIN.search(text)) or any(c.isalpha() for c in text))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts as 32-bit keys, and the index of the text each belongs to."""
    parts = [b"  " + t.lower().encode("utf-8", "replace") + b"    " for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    data = FOLD[np.frombuffer(b"".join(parts), np.uint8)].astype(np.uint32)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    keys, owners = [], []
    for n in GRAMS:
        last = len(data) - n + 1
        if last <= 0:
            continue
        key = data[:last].copy()
        for k in range(1, n):
            key |= data[k : last + k] << np.uint32(8 * k)
        # inside one text, and not three spaces: those stand between words of any language
        real = (owner[:last] == owner[n - 1 :]) & (key & np.uint32(0xFFFFFF) != np.uint32(0x202020))
        keys.append(key[real] + STEPS[n])
        owners.append(owner[:last][real])
    if not keys:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(keys), np.concatenate(owners)


def slots(keys: np.ndarray, k: int, bits: int) -> np.ndarray:
    mixed = keys * MIX[k]
    return ((mixed ^ (mixed >> np.uint32(15))) * MIX[1 - k]) >> np.uint32(32 - bits)


def _chunks(batch: pa.RecordBatch, room: int = 4_000_000) -> Iterator[tuple[int, int, list]]:
    """Runs of rows with a bounded number of characters; a longer text is a run of its own."""
    texts = batch.column("text").to_pylist()
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > room:
            yield start, k, texts[start:k]
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts), texts[start:]


def _counted(bits: int):
    """Per task: n-gram counts of each language and table, as blocks of a fixed number of slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            for a, b, texts in _chunks(batch):
                keys, owner = grams(texts)
                langs = names[a:b]
                for lang in sorted(set(langs)):
                    mine = keys[(langs == lang)[owner]] if len(keys) else keys
                    table = counts.setdefault(lang, np.zeros((2, 1 << bits), np.int64))
                    for k in range(2):
                        table[k] += np.bincount(slots(mine, k, bits), minlength=1 << bits)
        out = [
            (lang, k, s // BLOCK, table[k, s : s + BLOCK].tobytes())
            for lang, table in sorted(counts.items())
            for k in range(2)
            for s in range(0, 1 << bits, BLOCK)
            if table[k, s : s + BLOCK].any()
        ]
        lang, part, block, data = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(part, pa.int32()), pa.array(block, pa.int32()), pa.array(data, pa.binary())],
            names=["lang", "part", "block", "counts"],
        )

    return run


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
    return table.slice(0, 1).set_column(3, "counts", pa.array([total.tobytes()], pa.binary()))


@dataclass
class Filter:
    """Bit-sliced tables: ``words[i // 64][k][slot]`` has bit i % 64 if language i contains an n-gram of that slot."""

    langs: list[str]
    words: np.ndarray
    false_rate: np.ndarray
    bits: int

    def masks(self, keys: np.ndarray) -> list[np.ndarray]:
        one, two = (slots(keys, k, self.bits) for k in range(2))
        return [word[0][one] & word[1][two] for word in self.words]

    def shares(self, texts: list[str]) -> np.ndarray:
        """Corrected share of each text's n-grams that each language contains."""
        keys, owner = grams(texts)
        masks = self.masks(keys)
        n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        has = lambda i: masks[i // WORD] >> np.uint64(i % WORD) & np.uint64(1) == 1
        hits = [np.bincount(owner[has(i)], minlength=len(texts)) for i in range(len(self.langs))]
        share = np.array(hits).T / n[:, None]
        return np.clip((share - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1)


def learn(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", bits: int = SLOT_BITS, keep: float = KEEP
) -> Filter:
    """The filter of all given documents. Only fixed-size tables, one pair per language, reach the driver."""
    rows = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), text_of(text_col).alias("text"))
    kind = "lang string, part int, block int, counts binary"
    summed = rows.mapInArrow(_counted(bits), kind).groupBy("lang", "part", "block").applyInArrow(_summed, kind)
    counts: dict[str, np.ndarray] = {}
    for r in summed.toLocalIterator():
        table = counts.setdefault(r.lang, np.zeros((2, 1 << bits)))
        table[r.part, r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.counts, np.int64)
    langs = sorted(counts)
    words = np.zeros((-(-len(langs) // WORD), 2, 1 << bits), np.uint64)
    false_rate = np.zeros(len(langs))
    if langs:
        rates = np.array([counts[x] / max(counts[x][0].sum(), 1) for x in langs])
        best = rates.max(axis=0)
        for i, rate in enumerate(rates):
            member = (rate > 0) & (rate >= keep * best)
            words[i // WORD] |= member.astype(np.uint64) << np.uint64(i % WORD)
            false_rate[i] = member[0].mean() * member[1].mean()
    return Filter(langs, words, false_rate, bits)


def _predicted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            langs, scores = [], []
            for _, _, texts in _chunks(batch):
                if not known.langs:
                    langs += [UNKNOWN] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                share = known.shares(texts)
                best = share.argmax(axis=1)
                letter = [has_letter(t) for t in texts]
                langs += [known.langs[b] if ok else UNKNOWN for b, ok in zip(best, letter)]
                scores += [float(share[k, b]) if ok else 0.0 for k, (b, ok) in enumerate(zip(best, letter))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (share of n-grams the language contains)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predicted(shared), f"doc_id {kind}, lang_pred string, score double")
