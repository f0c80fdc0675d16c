"""Packing of token sequences under several limits at once.

Vector bin packing with the dot-product heuristic: the open sequence takes the
example whose demand (tokens, one segment, loss-bearing tokens) has the largest
dot product with what the sequence has left, each in shares of the limit. When
no whole example fits, the best one is cut to fill the gap, so sequences end
full. A sequence that cannot be filled (its segments or loss-bearing tokens are
used up, or the task has no more examples) is trimmed to a power of two and
what was cut off is packed anew; such sequences need no padding.

The work is map-only: each task tokenizes and packs what it reads, in groups of
a bounded number of tokens. Nothing is shuffled, so no key can be hot, and a
task that is run again gives the same rows, ids included.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from poseval.llm.common import texts
from poseval.llm.wordpieces import WordTokenizer

PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Examples are packed when so many tokens have come together in a task.
GROUP_TOKENS = 1 << 19
GROUP_EXAMPLES = 1024


class Limits(NamedTuple):
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048


class Example(NamedTuple):
    """What is left of a document: its tokens from ``start`` on."""

    doc_id: object
    ids: bytes
    start: int
    end: int
    doc_tokens: int
    loss_from: int

    def loss(self, start: int, end: int) -> int:
        return max(0, end - max(start, self.loss_from))

    def upto(self, tokens: int, loss_tokens: int) -> int:
        """Tokens of the longest head within both limits."""
        free = max(0, self.loss_from - self.start)
        return min(tokens, self.end - self.start, free + loss_tokens)


class Packer:
    """Packs the examples of one task; ``drain`` yields finished sequences."""

    def __init__(self, limits: Limits):
        if min(limits) < 1:
            raise ValueError("limits must be positive")
        self.limits, self.waiting = limits, []

    def add(self, example: Example) -> None:
        self.waiting.append(example)

    def drain(self, last: bool = False) -> Iterator[list[tuple[Example, int]]]:
        """Lists of (example, tokens taken from its head), one per sequence.

        Without ``last``, packing stops when less than one sequence is left.
        """
        size = self.limits.tokens
        while self.waiting:
            left = sum(e.end - e.start for e in self.waiting)
            if left < size and not last:
                return
            yield from self._pack(size if left >= size else 1 << (left.bit_length() - 1), last)

    def _pack(self, size: int, last: bool) -> Iterator[list[tuple[Example, int]]]:
        """Fill sequences of ``size`` while the waiting examples can fill one."""
        items, limits = self.waiting, self.limits
        scale = np.array([1 / size, 1 / limits.segments, 1 / limits.loss_tokens])
        n = len(items)
        demand = np.zeros((n, 3))
        for i, e in enumerate(items):
            demand[i] = e.end - e.start, 1, e.loss(e.start, e.end)
        alive = np.ones(n, bool)
        total = int(demand[:, 0].sum())
        while total >= size:
            room = np.array([size, limits.segments, limits.loss_tokens], float)
            taken: list[tuple[int, int]] = []
            while room.min() > 0:
                score = demand @ (room * scale * scale)
                score[~alive] = -1
                whole = np.where((demand <= room).all(axis=1), score, -1)
                at = int(whole.argmax())
                if whole[at] < 0:
                    at = int(score.argmax())
                    if score[at] < 0:
                        break
                e = items[at]
                length = e.upto(int(room[0]), int(room[2]))
                taken.append((at, length))
                room -= (length, 1, e.loss(e.start, e.start + length))
                self._advance(items, demand, alive, at, length)
            used = size - int(room[0])
            keep = size if room[0] == 0 else 1 << (used.bit_length() - 1)
            out, fill = [], 0
            for at, length in taken:
                stay = min(length, keep - fill)
                start = items[at].start - sum(n for i, n in taken if i == at)
                if stay:
                    out.append((items[at]._replace(start=start), stay))
                    fill += stay
                if stay < length:
                    items[at] = items[at]._replace(start=items[at].start - (length - stay))
                    e = items[at]
                    demand[at] = e.end - e.start, 1, e.loss(e.start, e.end)
                    alive[at] = True
            total -= fill
            yield out
        self.waiting = [e for e, stay in zip(items, alive) if stay]

    @staticmethod
    def _advance(items, demand, alive, at: int, length: int) -> None:
        e = items[at] = items[at]._replace(start=items[at].start + length)
        demand[at] = e.end - e.start, 1, e.loss(e.start, e.end)
        alive[at] = e.end > e.start


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    end_id: int = 1,
    limits: Limits = Limits(),
    loss_from: str | None = None,
) -> DataFrame:
    """Pieces of documents with their place in sequences, ``ids`` as unsigned 32-bit little-endian.

    A document is its tokens and ``end_id``. ``loss_from`` names a column with
    the first token that bears loss (default: the first; null: the first).
    Every token lies in exactly one piece. A null or empty text gives the end
    token alone; a null ``doc_id`` is kept; repeated rows are packed each; an
    empty table gives no rows; other columns are ignored. A sequence id is the
    number of the task and, in the lower 32 bits, of the sequence in it.
    """
    rows = texts(docs, *([loss_from] if loss_from else []))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_file)
        end = np.array([end_id], "<u4").tobytes()
        packer, made, waiting = Packer(limits), TaskContext.get().partitionId() << 32, 0
        id_type = None

        def rows_of(sequences) -> Iterator[pa.RecordBatch]:
            nonlocal made
            out: list[tuple] = []
            for sequence in sequences:
                offset = 0
                for e, n in sequence:
                    out.append((e.doc_id, e.start, n, e.ids[4 * e.start : 4 * (e.start + n)], e.doc_tokens, made, offset))
                    offset += n
                made += 1
                if len(out) >= 4096:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

        def batch(out: list[tuple]) -> pa.RecordBatch:
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for b in batches:
            id_type = b.schema.field("doc_id").type
            starts = b.column(2).to_pylist() if loss_from else [0] * b.num_rows
            for doc_id, text, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), starts):
                ids = tokenizer.ids(text) + end
                n = len(ids) // 4
                packer.add(Example(doc_id, ids, 0, n, n, start or 0))
                waiting += n
                if waiting >= GROUP_TOKENS or len(packer.waiting) >= GROUP_EXAMPLES:
                    yield from rows_of(packer.drain())
                    waiting = sum(e.end - e.start for e in packer.waiting)
        yield from rows_of(packer.drain(last=True))
        tokenizer.forget()

    return rows.mapInArrow(run, PIECES.format(id=kind))
