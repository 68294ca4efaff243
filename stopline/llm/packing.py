"""Packing token sequences into windows by the sum-of-squares rule, online, one task at a time.

A document's ids and one end id are cut at the window length; whole windows stand alone. The rest
is placed into the fill level that makes the sum of squared counts of partially filled windows
smallest, where an array holds the number of open windows of each level. What is still open when a
task ends is cut anew into whole windows, and the last remainder into windows whose lengths are
powers of two, so that no window needs padding. Every task packs its own rows: nothing is shuffled
and the state is one array of ``window`` counts and the open windows' piece lists.

Defined results: a null or empty text is its end id alone. Repeated rows are packed each on its
own. Sequence ids are unique over all tasks (the task's number and a running number) and the same
when a lost task is run again. A text is never cut before it is encoded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import lean, text_of
from stopline.llm.vocabulary import WORD_PATTERN, Bounded, Encoder, tokenizer_path

WINDOW = 2048
END_ID = 1
FLUSH_BYTES = 2_000_000

# The published byte alphabet: printable bytes stand for themselves, the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Words:
    """Ids of texts as little-endian unsigned 32-bit bytes, looked up by white-space piece."""

    def __init__(self, path: str):
        import regex

        self.encoder = Encoder(path)
        self.model = self.encoder.tokenizer.model
        self.split = regex.compile(WORD_PATTERN).findall
        self.pieces = Bounded(self._piece)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece: one word, a word and its last mark, or what the pattern splits it into."""
        if piece.isalpha():
            return self._word(piece)
        if piece[:-1].isalpha() and piece[-1] in ".,":
            return self.pieces[piece[:-1]] + self.pieces[piece[-1]]
        found = self.split(piece)
        return self._word(piece) if found == [piece] else b"".join(map(self.pieces.__getitem__, found))

    def _word(self, word: str) -> bytes:
        """Ids of one word of the pattern, straight from the library's model."""
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if not self.encoder.plain(text):
            return np.array(self.encoder.ids(text), "<u4").tobytes()
        return b"".join(map(self.pieces.__getitem__, text.lower().split()))


class SumOfSquares:
    """Open windows by fill level; ``place`` gives the level a piece of this length goes to."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)  # open windows of each level; 0 and window stay 0
        self.open: dict[int, list[list]] = {}

    def place(self, length: int) -> int:
        """Smallest change of the squared counts; ties go to the fullest level, then a new window."""
        levels = np.flatnonzero(self.count[: self.window - length + 1])[::-1]  # with open windows, fullest first
        change = 2 * (self.count[levels + length] - self.count[levels]) + 2
        if len(levels) and levels[0] + length == self.window:
            change[0] = 1 - 2 * self.count[levels[0]]  # it closes
        new = 2 * self.count[length] + 1 if length < self.window else 0
        best = int(change.argmin()) if len(levels) else 0
        return int(levels[best]) if len(levels) and change[best] <= new else 0

    def add(self, piece: tuple, length: int) -> list | None:
        """Put the piece where it belongs; a window that is now full comes back."""
        level = self.place(length)
        pieces = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        pieces.append(piece)
        level += length
        if level == self.window:
            return pieces
        self.count[level] += 1
        self.open.setdefault(level, []).append(pieces)
        return None

    def rest(self) -> list[list]:
        """The windows still open, fullest first."""
        return [pieces for level in sorted(self.open, reverse=True) for pieces in self.open[level]]


def _recut(pieces: list[tuple], window: int) -> Iterator[list[tuple]]:
    """Pieces (doc, start, ids, doc_tokens) in order, cut into whole windows and then powers of two."""
    left = sum(len(p[2]) // 4 for p in pieces)
    queue = iter(pieces)
    doc, start, ids, total = next(queue, (None, 0, b"", 0))
    while left:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        left, out = left - room, []
        while room:
            if not ids:
                doc, start, ids, total = next(queue)
            n = min(room, len(ids) // 4)
            out.append((doc, start, ids[: 4 * n], total))
            start, ids, room = start + n, ids[4 * n :], room - n
        yield out


def _packed(path: str, window: int, end_id: int, names: list[str], first_id: int = 0):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, packer, end = Words(path), SumOfSquares(window), np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 40
        schema, done = None, []

        def full(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for doc, start, ids, total in pieces:
                done.append((doc, start, len(ids) // 4, ids, total, number, offset))
                offset += len(ids) // 4
            number += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * len(names)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            size = 0
            kinds = [batch.schema.field("doc_id").type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            schema = pa.schema(list(zip(names, kinds)))
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = words.ids(text.as_py()) + end
                total = len(ids) // 4
                whole = total - total % window
                for start in range(0, whole, window):
                    full([(doc, start, ids[4 * start : 4 * (start + window)], total)])
                if whole < total:
                    closed = packer.add((doc, whole, ids[4 * whole :], total), total - whole)
                    if closed:
                        full(closed)
                size += len(ids)
                if size > FLUSH_BYTES:
                    yield flush()
                    size = 0
            yield flush()
        if schema is not None:
            for pieces in _recut([p for w in packer.rest() for p in w], window):
                full(pieces)
                if len(done) > window:
                    yield flush()
            yield flush()

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "word_bpe_49k.json",
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString())
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.mapInArrow(lean(_packed(tokenizer_path(vocabulary), window, end_id, names)), schema)


def with_digest(pieces: DataFrame) -> DataFrame:
    """The ids as their crc32 instead of the bytes."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
