"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Documents carry labels, tokens do not, so token labels are derived first. Over all labelled training
documents, words and their beginnings and endings are counted by label; those whose presence in
toxic documents is far beyond chance are cues. In a toxic document a token with a cue is labelled
toxic, every other token is not. The field's features are the strengths of a token's cues, its two
states are tied by transitions, and it is fitted on a bounded sample of labelled documents.

Forward-backward gives each token's marginal. The expected number of toxic tokens of a
document, through a logistic curve fitted on the same sample, is its score.

Copies would make any word of a copied toxic document a cue, so copies and near copies with the same
label count once. Texts are near copies if ten smallest hashes of their runs of five words agree in
one of eight bands; a text that merely shares a passage with others counts by itself.

Defined results: a null or empty text has no tokens and the score of the curve at zero. Without both
labels among the training documents every score is 0. Rows that repeat an id and text get the same
score; if labels repeat an id, one toxic label is enough. Whole texts are read. Cues are all traits
that pass the test, however rare. While they take at most ``MODEL_BYTES`` they are broadcast with the
model; beyond that each text meets its own cues by a join on traits, and scores are the same.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stopline.llm.common import bit_filter, filter_bits, held_out, lean, stage, text_of, tidy, with_candidate
from stopline.llm.jaccard_join import MULTIPLIER, Shingles, signature
from stopline.llm.vocabulary import Bounded

TOKEN = re.compile(r"\w+")
ENDS = (3, 4, 5, 6, 7)
MIN_DOCS = 4
LEAST_SURPRISE = 8.0
LEAST_ODDS = 3.0
SAMPLE_DOCS = 600
SAMPLE_CHARS = 20_000
ROOM = 2_000_000
HELD_KEYS = 2_000_000
MODEL_BYTES = 64_000_000
FEW_IDS = 2_000_000
RUN = 5
BANDS, MINIMA = 8, 10
SEEDS = np.random.default_rng(11).integers(0, 2**64, BANDS * MINIMA, np.uint64)


def traits(word: str) -> list[str]:
    """The word itself, its beginnings and its endings; each kind has its own mark."""
    parts = [f"{n}<{word[:n]}" for n in ENDS if len(word) > n] + [f"{n}>{word[-n:]}" for n in ENDS if len(word) > n]
    return [f"={word}", *parts]


def copy_keys(hashes: np.ndarray) -> tuple[int, list[int]]:
    """A signature of the text, and a 64-bit key of each band of smallest hashes of its runs of words.

    Of texts that share a part j of their runs, 1 - (1 - j**10)**8 share a key: 0.97 at j = 0.9, 0.01 at 0.5."""
    if not len(hashes):
        least = np.zeros(BANDS * MINIMA, np.uint64)
    else:
        blocks = (hashes[k : k + 256, None] for k in range(0, len(hashes), 256))
        least = np.min([((b ^ SEEDS) * MULTIPLIER).min(axis=0) for b in blocks], axis=0)
    rows = least.reshape(BANDS, MINIMA)
    return signature(least), [signature(np.append(row, np.uint64(k))) for k, row in enumerate(rows)]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles = Shingles(RUN)
    for batch in batches:
        out = [copy_keys(shingles(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([s for s, _ in out], pa.int64()), pa.array([k for _, k in out], pa.list_(pa.int64()))],
            names=["doc_id", "sig", "keys"],
        )


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(doc_id, text, toxic) of the labelled documents that may be learnt from, near copies once."""
    rows = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), F.xxhash64(id_col).alias("_k")
    )
    label = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
    label = stage(label.agg(F.max(F.col(label_col).cast("int")).alias("toxic")), "toxic-labels")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def only(ids: DataFrame) -> DataFrame:
        bits = filter_bits(ids.count())
        words = bit_filter(ids.select(F.xxhash64("doc_id").alias("_k")), "_k", bits)
        return with_candidate(rows, "_k", words, bits, "_may").filter("_may").select("doc_id", "text")

    keyed = only(label).mapInArrow(lean(_keys), f"doc_id {kind}, sig long, keys array<long>").join(label, "doc_id")
    keyed = keyed.select("toxic", "doc_id", "sig", F.explode("keys").alias("key"))
    # a text stays where no text with a smaller id shares one of its keys
    first = keyed.groupBy("key", "toxic").agg(F.min(F.struct("doc_id", "sig")).alias("first")).select("toxic", "first.*")
    chosen = first.groupBy("doc_id", "toxic", "sig").count().filter(F.col("count") == BANDS).select("doc_id", "toxic")
    chosen = stage(chosen.distinct(), "toxic-chosen")
    if chosen.count() <= FEW_IDS:  # texts stay where they are; more ids than that are met by a shuffle
        return stage(only(chosen).join(F.broadcast(chosen), "doc_id"), "toxic-train")
    return stage(only(chosen).join(chosen, "doc_id"), "toxic-train")


def trait_key(trait: str) -> int:
    return xxhash.xxh3_64_intdigest(trait) - (1 << 63)


def _presence(wanted=None, bits: int = 0):
    """Per task: in how many texts each trait key occurs; of those in the bit filter only, where given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = None if wanted is None else wanted.value

        def kept(word: str) -> bytes:
            keys = map(trait_key, traits(word))
            if may is not None:
                keys = (k for k in keys if _in(may, bits, k))
            return np.array(list(keys), np.int64).tobytes()

        keys_of = Bounded(kept, 200_000)
        held, size = [], 0

        def out() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([*held, np.zeros(0, np.int64)]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

        for batch in batches:
            for text in batch.column("text"):
                words = set(TOKEN.findall(text.as_py().lower()))
                held.append(np.unique(np.frombuffer(b"".join(map(keys_of.__getitem__, words)), np.int64)))
                size += len(held[-1])
                if size > HELD_KEYS:
                    yield out()
                    size = 0
        yield out()

    return run


def _named(wanted, bits: int):
    """The traits of a task's texts whose keys are in the bit filter, each at least once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may, seen = wanted.value, set()
        named = Bounded(lambda word: [t for t in traits(word) if _in(may, bits, trait_key(t))], 200_000)

        def out() -> pa.RecordBatch:
            names = sorted(seen)
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([trait_key(t) for t in names], pa.int64())], names=["trait", "key"])

        for batch in batches:
            for text in batch.column("text"):
                for word in set(TOKEN.findall(text.as_py().lower())):
                    seen.update(named[word])
                if len(seen) > 100_000:
                    yield out()
        yield out()

    return run


def _in(bitmap: bytes, bits: int, key: int) -> bool:
    slot = key & ((1 << bits) - 1)
    return bool(bitmap[slot >> 3] >> (slot & 7) & 1)


def _bitmap(keys: DataFrame) -> tuple:
    """A broadcast bit filter of the keys, sized by their number, and its bits."""
    bits = filter_bits(keys.count())
    words = np.zeros(1 << bits >> 6, np.int64)
    table = bit_filter(keys, "key", bits).toArrow()  # at most 2**(bits-6) rows
    words[table.column("word").to_numpy()] = table.column("mask").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(words.astype("<i8").tobytes()), bits


def cue_table(train: DataFrame, min_docs: int, surprise: float) -> DataFrame | None:
    """(trait, strength) of all cues: their log odds, where the toxic count is far beyond chance."""
    toxic, clean = train.filter("toxic = 1").select("text"), train.filter("toxic = 0").select("text")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return None
    share = n_toxic / (n_toxic + n_clean)

    def odds(c):
        return F.log((F.col("a") + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))

    def evident(c):
        """Evidence of a likelihood ratio, and present far more often in toxic documents."""
        expected = (F.col("a") + c) * share
        return (F.col("a") > expected) & (F.col("a") * F.log(F.col("a") / expected) - (F.col("a") - expected) >= surprise) & (odds(c) >= LEAST_ODDS)

    found = toxic.mapInArrow(lean(_presence()), "key long, n long").groupBy("key").agg(F.sum("n").alias("a"))
    # what would be no cue even if no clean text held it is none
    found = stage(found.filter((F.col("a") >= min_docs) & evident(F.lit(0))), "toxic-traits")
    other = clean.mapInArrow(lean(_presence(*_bitmap(found))), "key long, n long").groupBy("key").agg(F.sum("n").alias("c"))
    both = found.join(other, "key", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    kept = stage(both.filter(evident(F.col("c"))).select("key", odds(F.col("c")).alias("strength")), "toxic-cue-keys")
    names = toxic.mapInArrow(lean(_named(*_bitmap(kept))), "trait string, key long").distinct()
    return stage(names.join(kept, "key").select("trait", "strength"), "toxic-cues")


def as_strength(table: DataFrame | None) -> dict[str, float]:
    return {} if table is None else {r.trait: r.strength for r in table.orderBy("trait").toLocalIterator()}


def cues(train: DataFrame, min_docs: int, surprise: float) -> dict[str, float]:
    """All cues in a dictionary, for a table that is known to be small."""
    return as_strength(cue_table(train, min_docs, surprise))


class Lookup:
    """Strengths of a word, by kind of trait and length, without making the traits."""

    def __init__(self, strength: dict[str, float]):
        self.whole = {t[1:]: v for t, v in strength.items() if t[0] == "="}
        kinds = {k: {t[2:]: v for t, v in strength.items() if t[:2] == k} for k in (f"{n}{side}" for side in "<>" for n in ENDS)}
        self.heads = [(n, kinds[f"{n}<"]) for n in ENDS if kinds[f"{n}<"]]
        self.tails = [(n, kinds[f"{n}>"]) for n in ENDS if kinds[f"{n}>"]]

    def features(self, word: str) -> tuple[float, float, float, float]:
        """Constant, strength of the word, of its strongest beginning, of its strongest ending."""
        size, starts, ends = len(word), 0.0, 0.0
        for n, known in self.heads:
            if size > n and (v := known.get(word[:n])) is not None and v > starts:
                starts = v
        for n, known in self.tails:
            if size > n and (v := known.get(word[-n:])) is not None and v > ends:
                ends = v
        return 1.0, self.whole.get(word, 0.0), starts, ends


@dataclass
class Field:
    """Two states. ``weights`` turn a token's features into the log odds of the toxic state.

    ``strength`` holds all cues, or only those that the fit needed where ``table`` holds them all."""

    strength: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # moves[from, to], 0 -> 0 is 0
    curve: np.ndarray = field(default_factory=lambda: np.zeros(2))
    table: DataFrame | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"table": None}

    def learnt(self) -> bool:
        return bool(self.strength) or self.table is not None

    def with_cues(self, strength: dict[str, float]) -> Field:
        return Field(strength, self.weights, self.moves, self.curve)


def _soft(x: np.ndarray, y: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Log odds after a step: from state log odds ``x`` through ``move``."""
    return np.logaddexp(move[0, 1], x + move[1, 1]) - np.logaddexp(move[0, 0], x + move[1, 0]) + y


def forward_backward(odds: list[np.ndarray], moves: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per sequence the forward and backward log odds of the toxic state; together the marginal's.

    All sequences step together, longest first, so each step works on one slice."""
    order = sorted(range(len(odds)), key=lambda k: -len(odds[k]))
    longest = len(odds[order[0]]) if order else 0
    sizes = np.array([len(odds[k]) for k in order])
    table = np.zeros((longest, len(order)))
    for c, k in enumerate(order):
        table[: sizes[c], c] = odds[k]
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sequences longer than t
    ahead, back = np.zeros_like(table), np.zeros_like(table)
    for t in range(longest):
        n = active[t]
        ahead[t, :n] = table[0, :n] if t == 0 else _soft(ahead[t - 1, :n], table[t, :n], moves)
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        back[t, :n] = _soft(back[t + 1, :n] + table[t + 1, :n], np.zeros(n), moves.T)
    place = {k: c for c, k in enumerate(order)}
    return (
        [ahead[: len(o), place[k]] for k, o in enumerate(odds)],
        [back[: len(o), place[k]] for k, o in enumerate(odds)],
    )


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_field(model: Field, sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = 60, rate: float = 0.25, ridge: float = 1e-5) -> None:
    """Likelihood of labelled token sequences (features, states) by gradient steps."""
    sequences = [s for s in sequences if len(s[1])]
    if not sequences:
        return
    total = sum(len(s[1]) for s in sequences)
    seen_x = sum((s[0] * s[1][:, None]).sum(axis=0) for s in sequences)
    seen_moves = np.zeros((2, 2))
    for _, y in sequences:
        np.add.at(seen_moves, (y[:-1], y[1:]), 1)
    model.weights = np.array([-4.0, 1.0, 1.0, 1.0])
    params = np.concatenate([model.weights, np.zeros(3)])
    mean, square = np.zeros(7), np.zeros(7)
    weight = np.array([total, *[max(1.0, (s := sum((q[1] == 1).sum() for q in sequences)))] * 6], float)
    for step in range(1, steps + 1):
        model.weights, model.moves = params[:4], np.array([[0.0, params[4]], [params[5], params[6]]])
        odds = [x @ model.weights for x, _ in sequences]
        ahead, back = forward_backward(odds, model.moves)
        gradient = np.zeros(7)
        gradient[:4] = seen_x
        pairs = np.zeros((2, 2))
        for (x, _), o, a, b in zip(sequences, odds, ahead, back):
            p = _sigmoid(a + b)
            gradient[:4] -= p @ x
            # joint odds of neighbouring states
            left = np.stack([np.zeros(len(a) - 1), a[:-1]])
            right = np.stack([np.zeros(len(a) - 1), o[1:] + b[1:]])
            joint = left[:, None, :] + model.moves[:, :, None] + right[None, :, :]
            joint = np.exp(joint - joint.max(axis=(0, 1)))
            pairs += (joint / joint.sum(axis=(0, 1))).sum(axis=2)
        gradient[4:] = (seen_moves - pairs)[[0, 1, 1], [1, 0, 1]]
        gradient = gradient / weight - ridge * params
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        params = params + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    model.weights, model.moves = params[:4], np.array([[0.0, params[4]], [params[5], params[6]]])


def fit_curve(summaries: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; ``summaries`` hold a constant and log(1 + expected)."""
    beta = np.zeros(summaries.shape[1])
    for _ in range(25):
        p = _sigmoid(summaries @ beta)
        curve = (summaries * (p * (1 - p))[:, None]).T @ summaries + ridge * np.eye(len(beta))
        beta = beta + np.linalg.solve(curve, summaries.T @ (toxic - p) - ridge * beta)
    return beta


class Scorer:
    """Document scores. Token odds are looked up by white-space piece and remembered per worker."""

    def __init__(self, model: Field):
        self.model, self.lookup = model, Lookup(model.strength)
        self.weights = [float(w) for w in model.weights]
        self.plain = self.weights[0]
        self.one = struct.pack("d", self.plain)
        self.pieces = Bounded(self._piece, 200_000)
        self.alone: dict[int, np.ndarray] = {}
        self.ahead = self.behind = np.zeros(0)

    def _word(self, word: str) -> bytes:
        _, *found = self.lookup.features(word)
        if not any(found):
            return self.one
        return struct.pack("d", self.plain + sum(w * x for w, x in zip(self.weights[1:], found)))

    def _piece(self, piece: str) -> bytes:
        return self._word(piece) if piece.isalnum() else b"".join(map(self._word, TOKEN.findall(piece)))

    def odds(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, text.lower().split())))

    def _plain(self, n: int) -> np.ndarray:
        """Summary of n tokens without any cue: both passes are the same for every such text."""
        if n not in self.alone:
            if n > len(self.ahead):
                (self.ahead,), (behind,) = forward_backward([np.full(2 * n, self.plain)], self.model.moves)
                self.behind = behind[::-1]
            self.alone[n] = summary(self.ahead[:n] + self.behind[:n][::-1])
        return self.alone[n]

    def summaries(self, texts: list[str]) -> np.ndarray:
        out, rest = np.zeros((len(texts), 2)), []
        for k, text in enumerate(texts):
            odds = self.odds(text)
            if (odds == self.plain).all():
                out[k] = self._plain(len(odds))
            else:
                rest.append((k, odds))
        rest.sort(key=lambda r: len(r[1]))
        while rest:  # blocks of texts of like length, with bounded tables
            n = max(1, ROOM // len(rest[-1][1]))
            block, rest = rest[-n:], rest[:-n]
            ahead, back = forward_backward([o for _, o in block], self.model.moves)
            for (k, _), a, b in zip(block, ahead, back):
                out[k] = summary(a + b)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.summaries(texts) @ self.model.curve)

    def spans(self, text: str, least: float = 0.5) -> list[tuple[int, int, float]]:
        """Offending offsets (start, end, marginal) in code points of the text."""
        found = list(TOKEN.finditer(text))
        if not found:
            return []
        odds = np.array([self.lookup.features(m.group().lower()) for m in found]) @ self.model.weights
        (ahead,), (back,) = forward_backward([odds], self.model.moves)
        marginal = _sigmoid(ahead + back)
        return [(m.start(), m.end(), float(p)) for m, p in zip(found, marginal) if p >= least]


def summary(log_odds: np.ndarray) -> np.ndarray:
    p = _sigmoid(log_odds)
    return np.array([1.0, np.log1p(p.sum())])


@tidy
def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    min_docs: int = MIN_DOCS,
    surprise: float = LEAST_SURPRISE,
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> Field:
    """The fitted model. Cues are counted over all training documents; field and curve are fitted on
    at most ``sample_docs`` documents of each label that have at most ``sample_chars`` characters."""
    train = training_texts(docs, labels, id_col, text_col, label_col)
    table = cue_table(train, min_docs, surprise)
    if table is None or table.isEmpty():
        return Field({})
    texts, toxic = [], []
    for label in (0, 1):
        few = train.filter((F.col("toxic") == label) & (F.length("text") <= sample_chars))
        few = few.orderBy(F.xxhash64("doc_id"), "text").limit(sample_docs).select("text").collect()
        texts += [r.text for r in few]
        toxic += [label] * len(few)
    room = table.agg(F.sum(F.octet_length("trait") + 16)).first()[0]
    if room <= MODEL_BYTES:
        model = Field(as_strength(table))
    else:  # the sample's own traits are bounded as the sample is
        own = [(t,) for t in sorted({t for text in texts for w in set(TOKEN.findall(text.lower())) for t in traits(w)})]
        own = docs.sparkSession.createDataFrame(own, "trait string")
        model = Field(as_strength(table.join(own, "trait", "left_semi")), table=table)
    sequences, lookup = [], Lookup(model.strength)
    for text, label in zip(texts, toxic):
        x = np.array([lookup.features(w) for w in TOKEN.findall(text.lower())]).reshape(-1, 4)
        sequences.append((x, ((x[:, 1:].max(axis=1, initial=0.0) > 0) & (label == 1)).astype(int)))
    fit_field(model, sequences)
    model.curve = fit_curve(Scorer(model).summaries(texts), np.array(toxic, float))
    return model


def _with_own_cues(rows: DataFrame, table: DataFrame) -> DataFrame:
    """(row, text, cues): each row with the cues its text holds, met by a join on traits."""
    rows = rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h1, h2, text in zip(*batch.columns):
                names = sorted({t for w in set(TOKEN.findall(text.as_py().lower())) for t in traits(w)})
                same = lambda h: pa.repeat(h, len(names))
                yield pa.RecordBatch.from_arrays([same(h1), same(h2), pa.array(names, pa.string())], names=["h1", "h2", "trait"])

    met = rows.select("h1", "h2", "text").mapInArrow(held, "h1 long, h2 long, trait string").distinct().join(table, "trait")
    cues_of = met.groupBy("h1", "h2").agg(F.collect_list(F.struct("trait", "strength")).alias("cues"))
    return rows.join(cues_of, ["h1", "h2"], "left").select("row", "text", "cues")


def _each(docs: DataFrame, model: Field, text_col: str, row: Column, out: str, answer: Callable) -> DataFrame:
    """(row, said): ``answer(scorer, texts)`` gives one value per text."""
    spark = docs.sparkSession
    rows = docs.select(row.alias("row"), text_of(text_col).alias("text"))
    if model.table is not None:
        rows = _with_own_cues(rows, model.table)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Scorer(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if "cues" in batch.schema.names:
                own = [{c["trait"]: c["strength"] for c in cues or ()} for cues in batch.column("cues").to_pylist()]
                said = [answer(Scorer(shared.value.with_cues(c)), [t])[0] for c, t in zip(own, texts)]
            else:
                said = answer(common, texts)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(said, kind)], names=["row", "said"])

    kind = pa.float64() if out == "double" else SPANS
    schema = StructType([rows.schema["row"], *StructType.fromDDL(f"said {out}")])
    return rows.mapInArrow(lean(run), schema)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))


def _scored(docs: DataFrame, model: Field, text_col: str, row: Column) -> DataFrame:
    if not model.learnt():
        return docs.select(row.alias("row"), F.lit(0.0).alias("said"))
    return _each(docs, model, text_col, row, "double", lambda scorer, texts: scorer.scores(texts).tolist())


def score(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score."""
    said = _scored(docs, model, text_col, F.struct(F.col(id_col).alias("doc_id")))
    return said.select("row.doc_id", F.col("said").alias("score"))


def reject(docs: DataFrame, model: Field, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows whose score is below the threshold, unchanged; no shuffle while the model is broadcast."""
    return _scored(docs, model, text_col, F.struct("*")).filter(F.col("said") < threshold).select("row.*")


def offending(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, end, marginal) of every token whose marginal says toxic."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if not model.learnt():
        docs, model = docs.filter("false"), Field({})
    kind = "array<struct<start: long, end: long, marginal: double>>"
    found = _each(docs, model, "text", F.struct("doc_id"), kind, lambda scorer, texts: [[dict(zip(("start", "end", "marginal"), s)) for s in scorer.spans(t)] for t in texts])
    return found.select("row.doc_id", F.explode("said").alias("s")).select("doc_id", "s.*")
