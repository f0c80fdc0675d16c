"""Benchmark decontamination: rare words as seeds, then Smith-Waterman alignment.

A first pass counts in how many documents each word of the test items occurs. A
passage that scores enough matches at least that many words of its item, so an
item's commonest words may be left out, up to a few less than that: the others
are its seeds, and some of them lie in every such passage. A second pass finds
stretches with enough seeds in each document; where the longest common
subsequence with the item is long enough, too, the stretch is aligned. Nothing
that would score enough is lost. The score is the best local alignment in
shares of the item's length.

Documents are never shuffled: the items are handed to every task. Their number
is checked first, and items beyond ``ITEM_WORDS`` words are dealt into several
rounds of that size, each with its own passes over the documents.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poseval.llm.common import texts
from poseval.schema import require_columns

#: Shorter items are not searched.
LEAST_WORDS = 3
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 1.0, 0.5, 0.5
#: Words of items that one round hands to every task (up to 200 bytes each there, in four pieces).
ITEM_WORDS = 500_000
#: Longer items are matched by pieces of this many words, which begin at most ``STEP`` words apart.
PIECE, STEP = 100, 25
#: Words of a document that are searched at once.
STRETCH = 50_000
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MARKS = string.punctuation.encode()


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case, without ASCII punctuation."""
    return text.translate(_PLAIN, _MARKS).split()


def piece_starts(n: int) -> list[int]:
    """Where an item's pieces begin: evenly, and all of one length, so that no short rest decides alone."""
    steps = max(0, -(-(n - PIECE) // STEP))
    return [k * (n - PIECE) // steps for k in range(steps + 1)] if steps else [0]


class Items:
    """Pieces of test items as word numbers, and which words are whose seeds."""

    def __init__(self, items: list[tuple[object, bytes]], min_score: float = MIN_SCORE):
        self.number: dict[bytes, int] = {}
        self.ids, self.pieces = [], []
        for item_id, text in items:
            words = words_of(text)
            for k in piece_starts(len(words)):
                piece = words[k : k + PIECE]
                if len(piece) >= LEAST_WORDS:
                    self.ids.append(item_id)
                    self.pieces.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in piece], np.int64))
        sizes = np.array([len(p) for p in self.pieces], np.int64)
        #: Words that a passage has to match, and the most that it can be long.
        self.least = np.array([max(1, math.ceil(min_score * n - 1e-9)) for n in sizes.tolist()], np.int64)
        self.least_score = min_score * sizes - 1e-6
        self.reach = sizes + ((sizes - min_score * sizes) * MATCH / GAP).astype(np.int64) + 1

    def numbers(self, text: bytes) -> np.ndarray:
        get = self.number.get
        return np.array([get(w, 0) for w in words_of(text)], np.int64)

    def choose_seeds(self, documents_with: dict[int, int]) -> None:
        """Leave out each piece's commonest words, fewer than a passage has to match.

        ``needed`` of the passage's words are seeds then: a third of what it matches.
        """
        most = np.maximum(self.least // 3, 1)
        words, owners, self.needed = [], [], np.zeros(len(self.pieces), np.int64)
        for k, piece in enumerate(self.pieces):
            own, times = np.unique(piece, return_counts=True)
            spread = np.array([documents_with.get(w, 0) for w in own.tolist()])
            order = np.lexsort((own, -spread))
            left_out = np.cumsum(times[order])
            seeds = left_out > self.least[k] - most[k]
            self.needed[k] = self.least[k] - (left_out[~seeds][-1] if not seeds.all() else 0)
            words.append(own[order][seeds])
            owners.append(np.full(int(seeds.sum()), k))
        word = np.concatenate(words) if words else np.zeros(0, np.int64)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        self.owner = owner[np.argsort(word, kind="stable")]
        #: Seeds of word n are from start[n] to start[n + 1].
        self.start = np.r_[0, np.cumsum(np.bincount(word, minlength=len(self.number) + 1))]

    def stretches(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``piece, first, last``: parts of a document that hold all passages with enough seeds."""
        lo, size = self.start[numbers], self.start[numbers + 1] - self.start[numbers]
        total = int(size.sum())
        if not total:
            return
        place = np.repeat(np.arange(len(numbers)), size)
        slot = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        owner = self.owner[slot]
        order = np.argsort(owner, kind="stable")
        owner, place = owner[order], place[order]
        end = np.arange(total) + self.needed[owner] - 1
        enough = end < total
        end = np.minimum(end, total - 1)
        enough &= (owner[end] == owner) & (place[end] - place < self.reach[owner])
        at = np.flatnonzero(enough)
        if not len(at):
            return
        owner, first, last = owner[at], place[at] - self.reach[owner[at]], place[end[at]] + self.reach[owner[at]]
        cuts = np.flatnonzero((owner[1:] != owner[:-1]) | (first[1:] > last[:-1])) + 1
        for i, j in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(at)].tolist()):
            yield int(owner[i]), max(int(first[i]), 0), min(int(last[j - 1]) + 1, len(numbers))


def common_words(item: np.ndarray, passage: np.ndarray) -> int:
    """Length of the longest common subsequence: no alignment matches more words."""
    places: dict[int, int] = {}
    for k, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << k
    row = every = (1 << len(item)) - 1
    for here in map(places.get, passage.tolist()):
        if here:
            taken = row & here
            row = (row + taken | row - taken) & every
    return len(item) - row.bit_count()


def best_score(item: np.ndarray, passage: np.ndarray) -> float:
    """Score of ``smith_waterman`` without its place."""
    words, at = np.unique(item, return_inverse=True)
    steps = np.where(passage == words[:, None], MATCH, -MISMATCH)
    along = GAP * np.arange(1, len(passage) + 1)
    row, best, new = np.zeros(len(passage) + 1), 0.0, np.zeros(len(passage))
    for k in at.tolist():
        np.add(row[:-1], steps[k], out=new)
        np.maximum(new, row[1:] - GAP, out=new)
        np.maximum(new, 0.0, out=new)
        best = max(best, float(new.max()))
        new += along
        np.maximum.accumulate(new, out=new)
        np.subtract(new, along, out=row[1:])
    return best


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: score, and start and end of its part of the passage.

    A row of the table at a time: gaps along the row are a running maximum, for
    a gap costs the same per word. The start travels with each cell.
    """
    n = len(passage)
    along = GAP * np.arange(n + 1)
    row, begin = np.zeros(n + 1), np.arange(n + 1)
    best = (0.0, 0, 0)
    for word in item:
        step = np.where(passage == word, MATCH, -MISMATCH)
        diagonal, above = row[:-1] + step, row[1:] - GAP
        new, start = np.zeros(n + 1), np.arange(n + 1)
        take = diagonal >= above
        new[1:] = np.where(take, diagonal, above)
        start[1:] = np.where(take, begin[:-1], begin[1:])
        dead = new <= 0
        new[dead], start[dead] = 0.0, np.flatnonzero(dead)
        slid = new + along
        lead = np.maximum.accumulate(slid)
        source = np.maximum.accumulate(np.where(slid == lead, np.arange(n + 1), 0))
        row = lead - along
        begin = start[source]
        dead = row <= 0
        row[dead], begin[dead] = 0.0, np.flatnonzero(dead)
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (float(row[at]), int(begin[at]), at)
    return best


def matches_in(items: Items, text: bytes, min_score: float) -> Iterator[tuple[object, float, int, int]]:
    """``item_id, score, start, end`` of passages of a text that align with an item."""
    every = items.numbers(text)
    overlap = int(items.reach.max())
    for base in range(0, max(len(every) - overlap, 1), STRETCH):
        numbers = every[base : base + STRETCH + overlap]
        for piece, first, last in items.stretches(numbers):
            item, passage = items.pieces[piece], numbers[first:last]
            if common_words(item, passage) < items.least[piece]:
                continue
            if best_score(item, passage) < items.least_score[piece]:
                continue
            score, a, b = smith_waterman(item, passage)
            score /= len(item)
            if score >= min_score:
                yield items.ids[piece], score, base + first + a, base + first + b


def _rounds(docs: DataFrame, benchmark: DataFrame, min_score: float, item_words: int) -> Iterator[Broadcast]:
    """Items with their seeds, in as many bounded shares as they need, each counted over all documents."""
    require_columns(benchmark, ["item_id", "text"])
    spark = docs.sparkSession
    items = benchmark.where("text IS NOT NULL").select("item_id", F.col("text").cast("binary").alias("text"))
    # A word takes two bytes with its space, so this bounds the words.
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 2
    rounds = max(1, -(-size // item_words))
    rows = texts(docs).select(F.col("text").cast("binary").alias("text"))
    for k in range(rounds):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k).distinct().orderBy("item_id", "text")
        own = Items([(r["item_id"], bytes(r["text"])) for r in part.collect()], min_score)
        if not own.pieces:
            continue
        shared = spark.sparkContext.broadcast(own)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            total = np.zeros(len(items.number) + 1, np.int64)
            for b in batches:
                for text in b.column(0).to_pylist():
                    total[np.unique(items.numbers(text))] += 1
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["key", "n"])

        counts = rows.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        own.choose_seeds({r["key"]: r["n"] for r in counts.collect()})
        yield spark.sparkContext.broadcast(own)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, item_words: int = ITEM_WORDS) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word``: the best passage per document and item.

    Words are lower-cased and lose ASCII punctuation. Items of fewer than three
    words are not searched. Those of over 100 words match by overlapping pieces of
    100, and ``score`` is a share of the piece: with 0.5, a passage counts that
    scores 50 within some 75 words in a row of its item, however long that is. Null
    texts are empty and match nothing; a null id is kept; repeated documents or
    items give one row for each pair of ids. Empty tables give no rows; other columns are
    ignored.
    """
    rows = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, score double, start_word long, end_word long"
    found = []
    for shared in _rounds(docs, benchmark, min_score, item_words):

        def align(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for b in batches:
                ids = b.column(0)
                out = [(k, *m) for k, t in enumerate(b.column(1).to_pylist()) for m in matches_in(items, t, min_score)]
                if out:
                    row, item, score, start, end = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(row)), pa.array(item), pa.array(score), pa.array(start), pa.array(end)],
                        names=["doc_id", "item_id", "score", "start_word", "end_word"],
                    )

        found.append(rows.mapInArrow(align, schema))
    if not found:
        return rows.limit(0).selectExpr(
            "doc_id", f"CAST(NULL AS {item_kind}) AS item_id", "0D AS score", "0L AS start_word", "0L AS end_word"
        )
    best = F.max(F.struct("score", (-F.col("start_word")).alias("minus_start"), "end_word")).alias("best")
    return (
        reduce(DataFrame.union, found)
        .groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "best.score", (-F.col("best.minus_start")).alias("start_word"), "best.end_word")
    )


def _is_clean(shared: Broadcast, min_score: float) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        return pd.Series([not any(True for _ in matches_in(shared.value, t, min_score)) for t in text], dtype=bool)

    return clean


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, item_words: int = ITEM_WORDS
) -> DataFrame:
    """The rows of ``docs`` without a passage of a test item, with their columns; nothing is shuffled."""
    kept, text = docs, F.coalesce(F.col("text"), F.lit("")).cast("binary")
    for shared in _rounds(docs, benchmark, min_score, item_words):
        kept = kept.where(_is_clean(shared, min_score)(text))
    return kept
