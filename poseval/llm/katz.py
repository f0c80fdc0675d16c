"""Katz backoff language model: discounted counts, exactly normalised backoff.

Documents are turned once into blocks of word numbers, kept with their vocabulary
of 64-bit word hashes, most frequent first. For each level (words, then pairs of context
and word, ...) a block sends its distinct n-grams with its training counts to
buckets; a bucket adds up the blocks' counts and answers each block with the
counts of its n-grams and, per context, what the backoff weight needs: how many
followers occur 1 to 5 times, and the lower-order probability of those seen. A
block that has all followers of a context itself is not told them.
The answers are stored, one table per level in bucket order, and a block's
tokens are evaluated from them recursively: a seen n-gram has its discounted
count, another the context's backoff weight times the next shorter n-gram.

N-grams are summed per block before they move, in packed arrays of a few bytes
each; from the second level on a word goes by its number in its first bucket,
which takes three bytes where its hash takes eight, and pairs go to the bucket of their first word, so the contexts
in it are dense numbers. The lower-order probability goes as the two counts it is the quotient of.
All followers of a context meet in its bucket, except those of very
frequent contexts, which are divided by word, one part for so many occurrences;
the sums of the parts are added up afterwards. So parts grow with the tokens,
not with contexts times buckets.

A block has a row for every bucket that has n-grams of it, never more than its
n-grams; blocks and buckets should grow with the corpus:
the defaults suit up to some 10^11 tokens, and tasks with more memory take
larger blocks and buckets.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from poseval.llm.common import crc_of_id, staged, texts

ORDER = 2
#: Counts up to this are discounted.
CUT = 5
BLOCK_TOKENS = 1_200_000
BUCKET_NGRAMS = 1_000_000
#: A context with this share of the tokens, and so many in a bucket's n-grams, is divided.
HOT_SHARE = 1 / 20_000
HOT_IN_BUCKET = 1 / 8
#: Rows of texts, and numbers of a block, that are worked on at a time.
TEXT_ROWS, SLICE = 500, 1 << 16
#: Documents with crc32(id) mod 7 = 2 are held out of training.
FOLDS, HELD_OUT = 7, 2
END = xxhash.xxh64_intdigest(b"")
START = xxhash.xxh64_intdigest(b" ")
_EMPTY = np.uint64(0)


def _pack(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(planes)


def _unpack(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(kind)


def _pack_values(x: np.ndarray) -> bytes:
    """Numbers: the distinct ones, and the place of each among them; all as they are, after a zero, where most differ."""
    values, place = np.unique(x, return_inverse=True)
    if len(values) > 0.75 * len(x):
        return bytes(4) + _pack(x)
    first = _pack(values)
    return len(first).to_bytes(4, "little") + first + _pack(_small(place))


def _unpack_values(data: bytes) -> np.ndarray:
    n = 4 + int.from_bytes(data[:4], "little")
    if n == 4:
        return _unpack(data[4:], np.float64)
    return _unpack(data[4:n], np.float64)[_unpack(data[n:], np.uint32)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: each holds a block."""
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chain(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from those of its context and its last word."""
    with np.errstate(over="ignore"):
        return _mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


class Block(NamedTuple):
    """Tokens of some documents, each led by a start mark, as places in ``vocab``."""

    vocab: np.ndarray
    tokens: np.ndarray
    trained: np.ndarray
    document: np.ndarray

    @classmethod
    def load(cls, vocab: bytes, tokens: bytes, lengths: bytes, train: bytes) -> "Block":
        lengths = _unpack(lengths, np.int32)
        document = np.repeat(np.arange(len(lengths)), lengths)
        return cls(
            np.cumsum(_unpack(vocab, np.uint64)), _unpack(tokens, np.int32), _unpack(train, np.uint8)[document] > 0, document
        )

    @property
    def begins(self) -> np.ndarray:
        """Which tokens are start marks."""
        return np.r_[True, self.document[1:] != self.document[:-1]]


class Grams(NamedTuple):
    """Distinct n-grams of a block in order; ``at`` is each token's place among them."""

    at: np.ndarray
    hashed: np.ndarray
    context: np.ndarray  # place among the next shorter n-grams
    shorter: np.ndarray  # place of the n-gram without its first word
    word: np.ndarray  # hash of the last word
    count: np.ndarray  # in the block's training documents
    real: np.ndarray  # not a start mark


def grams(block: Block, lower: Grams | None, names: np.ndarray | None = None) -> Grams:
    """The next level; ``names`` are the words' numbers, known after the first."""
    begins = block.begins
    names = block.vocab if names is None else names
    if lower is None:
        n = len(block.vocab)
        at, first = block.tokens, np.zeros(n, np.int64)
        first[at[::-1]] = np.arange(len(at))[::-1]
        context, shorter, hashed = np.zeros(n, np.int64), np.zeros(n, np.int64), names
    else:
        before = np.arange(len(begins), dtype=np.int32) - ~begins
        _, first, at = np.unique(
            lower.at[before].astype(np.int64) * len(block.vocab) + block.tokens, return_index=True, return_inverse=True
        )
        at, context, shorter = at.astype(np.int32), lower.at[before[first]], lower.at[first]
        hashed = _chain(lower.hashed[context], names[block.tokens[first]])
    count = np.bincount(at[block.trained], minlength=len(first))
    return Grams(at, hashed, context, shorter, names[block.tokens[first]], count, ~begins[first])


class Level(NamedTuple):
    """What is known of a level once all buckets have answered."""

    discounts: np.ndarray  # of counts 1 to CUT
    hot: dict[int, np.ndarray]  # context: followers by count 1 to CUT, and their lower-order probability
    buckets: int


class Totals(NamedTuple):
    tokens: int
    documents: int
    types: int


def discounts(occurring: np.ndarray) -> np.ndarray:
    """Good-Turing discounts from the number of n-grams that occur 1 to CUT + 1 times.

    Where those numbers give none (too few n-grams, or not falling), the
    discounts subtract n1 / (n1 + 2 n2) from each count; without any n-gram
    that occurs once nothing is discounted.
    """
    n = np.asarray(occurring, float)
    r = np.arange(1, CUT + 1)
    if n[0] == 0:
        return np.ones(CUT)
    if (n > 0).all():
        tail = (CUT + 1) * n[CUT] / n[0]
        found = ((r + 1) * n[1:] / (r * n[:-1]) - tail) / (1 - tail) if tail < 1 else np.zeros(CUT)
        if ((found > 0) & (found < 1)).all():
            return found
    return (r - n[0] / (n[0] + 2 * n[1])) / r if n[1] else (r - 0.5) / r


def _discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    small = np.clip(count, 1, CUT) - 1
    return np.where(count > CUT, count, count * d[small])


def _scaled(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _split(level: int, g: Grams, lower: Grams | None, lower_count: np.ndarray | None, buckets: int, hot_from: float):
    """Order of the n-grams to ask for, by bucket, context and word, and the bucket of each."""
    real = np.flatnonzero(g.real)
    if lower is None:
        context, word = np.full(len(real), _EMPTY), g.word[real]
        bucket = _scaled(_chain(context, word), buckets)
    else:
        seen = lower_count[g.context[real]]
        real, seen = real[seen > 0], seen[seen > 0]
        context, word = lower.hashed[g.context[real]], g.word[real]
        if level == 2:
            bucket = ((context >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        else:
            bucket = _scaled(_mix(context), buckets)
        hot = np.flatnonzero(seen >= hot_from)
        parts = np.ceil(seen[hot] / hot_from).astype(np.uint64)
        bucket[hot] = _scaled(_chain(context[hot], _mix(word[hot]) % parts), buckets)
    order = np.lexsort((word, context, bucket))
    return real[order], context[order], bucket[order]


class Evaluated(NamedTuple):
    grams: Grams
    count: np.ndarray
    base: np.ndarray  # what the discounted count of an n-gram that occurs is divided by
    probability: np.ndarray


def _base_and_probability(count, of_context, left, seen, low, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By n-gram, a slice at a time; ``low`` is the lower-order probability."""
    base, probability = np.empty(len(count), np.int64), np.empty(len(count))
    for lo in range(0, len(count), SLICE):
        at = slice(lo, lo + SLICE)
        none = left[at] <= 0
        with np.errstate(divide="ignore", invalid="ignore"):
            base[at] = of_context[at] + none
            backoff = np.where(none, 1.0, left[at]) / base[at] / (1 - seen[at])
            p = np.where(count[at] > 0, _discounted(count[at], d) / base[at], backoff * low[at])
        probability[at] = np.where(of_context[at] > 0, p, low[at])
    return base, probability


def evaluate(block: Block, answers: dict[int, dict[int, tuple]], levels: list[Level], totals: Totals, hot_from: float) -> list[Evaluated]:
    """Global counts and probabilities of a block's n-grams, shortest first."""
    done: list[Evaluated] = []
    for n, level in enumerate(levels, 1):
        lower = done[-1] if done else None
        g = grams(block, lower.grams if lower else None, done[0].grams.word if done else None)
        asked, context, bucket = _split(
            n, g, lower.grams if lower else None, lower.count if lower else None, level.buckets, hot_from
        )
        low = lower.probability[g.shorter] if lower else np.ones(len(g.hashed))
        count, left, seen = np.zeros(len(g.hashed), np.int64), np.zeros(len(g.hashed)), np.zeros(len(g.hashed))
        # What discounting leaves over for each follower that occurs 1 to CUT times.
        spare = (1 - level.discounts) * np.arange(1, CUT + 1)
        names = None if lower else np.full(len(g.hashed), START, np.uint64)
        for b, (counts, whole, followers, mass, ranks) in answers.get(n, {}).items():
            lo, hi = np.searchsorted(bucket, [b, b + 1])
            at = asked[lo:hi]
            count[at] = _unpack(counts, np.uint32)
            if ranks is not None:
                names[at] = (b << 32) + np.cumsum(_unpack(ranks, np.uint32).astype(np.uint64))
            own = np.cumsum(np.r_[True, context[lo:hi][1:] != context[lo:hi][:-1]]) - 1
            known = np.unpackbits(np.frombuffer(whole, np.uint8), count=own[-1] + 1) > 0
            # Of contexts that are whole in this block, it has all followers that occur.
            here = np.flatnonzero((count[at] > 0) & known[own])
            few = here[count[at][here] <= CUT]
            often = np.bincount(own[few] * CUT + count[at][few] - 1, minlength=len(known) * CUT).reshape(-1, CUT)
            of_seen = np.bincount(own[here], weights=low[at][here], minlength=len(known)).astype(float)
            if not known.all():
                often[~known], of_seen[~known] = _unpack(followers, np.uint32).reshape(-1, CUT), _unpack_values(mass)
            left[at], seen[at] = (often @ spare)[own], of_seen[own]
        if level.hot:
            # What buckets know of a divided context is a part; the sums are complete.
            keys = np.array(sorted(level.hot), np.uint64)
            sums = np.array([level.hot[int(k)] for k in keys])
            for lo in range(0, len(context), SLICE):
                own, at = context[lo : lo + SLICE], asked[lo : lo + SLICE]
                slot = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                known = keys[slot] == own
                left[at[known]], seen[at[known]] = (sums[:, :CUT] @ spare)[slot[known]], sums[slot[known], CUT]
        del asked, context, bucket
        if lower is None:
            of_context, seen = np.full(len(count), totals.tokens), np.zeros(len(count))
        else:
            of_context = lower.count[g.context]
        base, p = _base_and_probability(count, of_context, left, seen, low, level.discounts)
        if lower is None:
            g = g._replace(hashed=names, word=names)
        # The start mark is no event; as a context it occurs once per training document.
        count[~g.real] = totals.documents
        done.append(Evaluated(g, count, base, p))
        del low, left, seen, of_context
    return done


def _blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    train = (crc_of_id() % FOLDS != HELD_OUT).cast("byte").alias("train")
    rows = texts(docs).select("doc_id", train, F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, trained, lengths, hashes = [], [], [], array("Q")
        digest = xxhash.xxh64_intdigest

        def flush() -> pa.RecordBatch:
            nonlocal number, ids, trained, lengths, hashes
            every, hashes = np.frombuffer(hashes, np.uint64), array("Q")
            vocab, tokens, often = np.unique(every, return_inverse=True, return_counts=True)
            del every
            # Frequent words have small numbers, which pack well; words equally frequent stay in order of their hash.
            order = np.argsort(-often, kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            vocab, tokens = vocab[order], place[tokens]
            sizes, train = np.array(lengths, np.int32), np.array(trained, np.uint8)
            row = [
                pa.array([number]),
                pa.array([ids], pa.list_(id_type)),
                *[pa.array([x], pa.binary()) for x in (
                    _pack(np.diff(vocab, prepend=np.uint64(0))), _pack(tokens), _pack(sizes), _pack(train),
                )],
                pa.array([int(sizes[train > 0].sum() - sum(trained))]),
                pa.array([int(sum(trained))]),
            ]
            number += 1
            ids, trained, lengths = [], [], []
            return pa.RecordBatch.from_arrays(
                row, names=["block", "ids", "vocab", "tokens", "lengths", "train", "train_tokens", "train_docs"]
            )

        id_type = None
        for b in batches:
            id_type = b.schema.field("doc_id").type
            for k in range(0, b.num_rows, TEXT_ROWS):
                for doc_id, t, text in zip(*(c.to_pylist() for c in b.slice(k, TEXT_ROWS).columns)):
                    words = text.lower().split()
                    hashes.extend([START, *map(digest, words), END])
                    ids.append(doc_id)
                    trained.append(t)
                    lengths.append(len(words) + 2)
                    if len(hashes) - 2 * len(ids) >= block_tokens:
                        yield flush()
        if ids:
            yield flush()

    return rows.mapInArrow(
        run,
        f"block long, ids array<{kind}>, vocab binary, tokens binary, lengths binary, train binary, "
        "train_tokens long, train_docs long",
    )


_ANSWER = "block long, bucket int, counts binary, whole binary, followers binary, mass binary, ranks binary, context long, sums array<double>"
_LISTED = ["level", "bucket", "counts", "whole", "followers", "mass", "ranks"]


def _answers_of(row: dict) -> dict[int, dict[int, tuple]]:
    out: dict[int, dict[int, tuple]] = {}
    for a in row["answers"] or []:
        out.setdefault(a["level"], {})[a["bucket"]] = (a["counts"], a["whole"], a["followers"], a["mass"], a["ranks"])
    return out


def _with_answers(blocks: DataFrame, answers: list[DataFrame], tasks: int) -> DataFrame:
    """Blocks with the answers to them; they are as many as a block has n-grams.

    ``tasks`` is the number of blocks: a task gets its rows in one batch, so there should be few blocks in it.
    """
    if not answers:
        kind = "array<struct<level:int,bucket:int,counts:binary,whole:binary,followers:binary,mass:binary,ranks:binary>>"
        return blocks.withColumn("answers", F.lit(None).cast(kind))
    rows = [a.where("block >= 0").withColumn("level", F.lit(n)) for n, a in enumerate(answers, 1)]
    every = reduce(DataFrame.union, rows).repartition(tasks, "block").groupBy("block")
    listed = every.agg(F.collect_list(F.struct(*_LISTED)).alias("answers"))
    return blocks.repartition(tasks, "block").join(listed, "block", "left")


def _ask(rows: DataFrame, levels: list[Level], totals: Totals | None, buckets: int, hot_from: float) -> DataFrame:
    """Each block's distinct n-grams of the next level, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One call per block, so that its arrays are gone before the next one's are made.
        for row in _rows(batches):
            yield from ask(row)

    def ask(row: dict) -> Iterator[pa.RecordBatch]:
        block = Block.load(row["vocab"], row["tokens"], row["lengths"], row["train"])
        done = evaluate(block, _answers_of(row), levels, totals, hot_from)
        lower = done[-1] if done else None
        g = grams(block, lower.grams if lower else None, done[0].grams.word if done else None)
        del block
        asked, context, bucket = _split(
            len(levels) + 1, g, lower.grams if lower else None, lower.count if lower else None, buckets, hot_from
        )
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(asked)]):
            if lo == hi:
                continue
            at, own = asked[lo:hi], context[lo:hi]
            edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            hot = lower.count[g.context[at[edge]]] >= hot_from if lower else np.ones(len(edge), bool)
            packed = [
                _pack(np.diff(own[edge], prepend=_EMPTY)),
                _pack(_small(np.diff(np.r_[edge, len(own)]) * 2 + hot)),
                _pack(g.word[at]),
                _pack(_small(lower.count[g.shorter[at]])) if lower else None,
                _pack(lower.base[g.shorter[at]].astype(np.uint64)) if lower else None,
                _pack(_small(g.count[at])),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]]), pa.array([int(bucket[lo])], pa.int32()), *[pa.array([p], pa.binary()) for p in packed]],
                names=["block", "bucket", "contexts", "runs", "words", "shorter", "base", "counts"],
            )

    return rows.mapInArrow(
        run,
        "block long, bucket int, contexts binary, runs binary, words binary, shorter binary, base binary, counts binary",
    )


def _add_up(asked: DataFrame, tasks: int, shorter: Level | None) -> DataFrame:
    """Answers to blocks, on the first level with the words' numbers; ``shorter`` is the level below. Sums of divided contexts under block -2, and of the level under -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        for b in batches:
            for row in b.to_pylist():
                held.setdefault(row["bucket"], []).append(row)
        while held:
            yield from told_by(*held.popitem())

    def told_by(bucket: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        out = list(answer(bucket, rows))
        schema = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.int64(), pa.list_(pa.float64())]
        names = ["block", "bucket", "counts", "whole", "followers", "mass", "ranks", "context", "sums"]
        for k in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 256]), schema)], names=names)

    def answer(bucket: int, rows: list[dict]) -> Iterator[tuple]:
        contexts = [np.cumsum(_unpack(r["contexts"], np.uint64)) for r in rows]
        runs = [_unpack(r["runs"], np.uint32).astype(np.int64) for r in rows]
        each = np.concatenate([np.repeat(c, n >> 1) for c, n in zip(contexts, runs)])
        word = np.concatenate([_unpack(r["words"], np.uint64) for r in rows])
        if shorter:
            # Only what is said of n-grams that occur is used.
            low = np.concatenate([
                _discounted(_unpack(r["shorter"], np.uint32), shorter.discounts) / _unpack(r["base"], np.uint64) for r in rows
            ])
        else:
            low = np.zeros(len(word))
        count = np.concatenate([_unpack(r["counts"], np.uint32) for r in rows])
        hot = np.concatenate([np.repeat(n & 1, n >> 1) for n in runs])
        order = np.lexsort((word, each))
        sorted_context, sorted_word = each[order], word[order]
        new_context = np.r_[True, sorted_context[1:] != sorted_context[:-1]]
        new = np.flatnonzero(new_context | np.r_[True, sorted_word[1:] != sorted_word[:-1]])
        names = sorted_context[new_context]
        del each, word, sorted_context, sorted_word
        total = np.add.reduceat(count[order], new, dtype=np.int64)
        del count
        sizes = np.diff(np.r_[new, len(order)])
        every, rank = np.empty(len(order), np.uint32), np.empty(len(order), np.uint32)
        every[order], rank[order] = np.repeat(_small(total), sizes), np.repeat(_small(np.arange(len(new))), sizes)
        # Per context: followers by count, and the lower-order probability of those seen.
        groups = np.cumsum(new_context[new]) - 1
        seen = np.flatnonzero(total > 0)
        small = seen[total[seen] <= CUT]
        n = int(groups[-1]) + 1
        followers = np.bincount(groups[small] * CUT + total[small] - 1, minlength=n * CUT).reshape(n, CUT)
        mass = np.bincount(groups[seen], weights=low[order[new[seen]]], minlength=n)
        of_context = np.add.reduceat(total, np.flatnonzero(new_context[new]))
        at = 0
        for r, c, m in zip(rows, contexts, runs):
            size = int((m >> 1).sum())
            place = np.searchsorted(names, c)
            # Words of the first level are asked in order, so their ranks rise.
            own = None if shorter else _pack(np.diff(rank[at : at + size], prepend=np.uint32(0)))
            whole = np.add.reduceat(every[at : at + size], np.cumsum(m >> 1) - (m >> 1), dtype=np.int64) == of_context[place]
            place = place[~whole]
            told = (_pack(_small(followers[place].ravel())), _pack_values(mass[place])) if len(place) else (None, None)
            yield r["block"], bucket, _pack(every[at : at + size]), np.packbits(whole).tobytes(), *told, own, None, None
            at += size
        divided = np.unique(groups[np.searchsorted(new, np.flatnonzero(hot[order]), "right") - 1])
        for k in divided.tolist():
            yield -2, bucket, None, None, None, None, None, int(names[k : k + 1].view(np.int64)[0]), [*followers[k].astype(float), float(mass[k])]
        often = np.bincount(np.minimum(total[seen], CUT + 2), minlength=CUT + 3)[1 : CUT + 2]
        yield -1, bucket, None, None, None, None, None, None, [*often.astype(float), float(len(seen))]

    return asked.repartition(tasks, "bucket").mapInArrow(run, _ANSWER)


def _summed(answers: DataFrame, buckets: int) -> tuple[Level, int]:
    """The level's discounts and divided contexts, and its number of distinct n-grams in training."""
    columns = [F.coalesce(F.sum(F.col("sums")[k]), F.lit(0.0)) for k in range(CUT + 2)]
    whole = answers.where("block = -1").agg(*columns).first()
    divided = answers.where("block = -2").groupBy("context").agg(F.array(*columns[: CUT + 1]).alias("sums")).collect()
    hot = {r["context"] & (1 << 64) - 1: np.array(r["sums"]) for r in divided}
    return Level(discounts(np.array(whole[: CUT + 1])), hot, buckets), int(whole[CUT + 1])


def _scores(row: dict, levels: list[Level], totals: Totals, hot_from: float) -> list[np.ndarray]:
    """Columns of a block's documents, from ``held_out`` on. What it takes in memory is gone when it returns."""
    block = Block.load(row["vocab"], row["tokens"], row["lengths"], row["train"])
    done = evaluate(block, _answers_of(row), levels, totals, hot_from)
    first, last = done[0], done[-1]
    del done
    n, real = len(row["ids"]), ~block.begins
    of = block.document[real]
    p = last.probability[last.grams.at[real]]
    del last
    count = first.count[first.grams.at[real]]
    scored = np.bincount(of, weights=np.log10(p, out=p), minlength=n)
    base = np.bincount(of, weights=np.log10((count + 1) / (totals.tokens + totals.types + 1)), minlength=n)
    return [
        _unpack(row["train"], np.uint8) == 0,
        np.bincount(of, minlength=n),
        np.bincount(of[count > 0], minlength=n),
        np.full(n, totals.tokens, np.int64),
        base,
        scored,
    ]


def score_documents(
    docs: DataFrame,
    order: int = ORDER,
    block_tokens: int = BLOCK_TOKENS,
    bucket_ngrams: int = BUCKET_NGRAMS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    Words are split at white space, with A-Z in lower case; each text ends with
    one end token. The model learns from the rows that are not held out. Words
    that training lacks are one type, which gets the words' discounted mass. A
    null text is empty; a null id is hashed as an empty one; repeated rows
    count, and are scored, each. Where training is empty every token has
    probability 1. An empty table gives no rows; other columns are ignored.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    spark = docs.sparkSession
    blocks = staged(_blocks(docs, block_tokens), "blocks")
    found = blocks.agg(
        F.coalesce(F.sum("train_tokens"), F.lit(0)), F.coalesce(F.sum("train_docs"), F.lit(0)), F.count("*")
    ).first()
    totals, tasks = Totals(found[0], found[1], 0), max(found[2], 1)
    hot_from = max(2.0, found[0] * hot_share, bucket_ngrams * HOT_IN_BUCKET)
    levels, answers = [], []
    # Blocks hold at most their tokens in distinct n-grams.
    buckets = max(-(-totals.tokens // bucket_ngrams), 1)
    for n in range(1, order + 1):
        asked = _ask(_with_answers(blocks, answers, tasks), levels, totals, buckets, hot_from)
        answers.append(staged(_add_up(asked, buckets, levels[-1] if levels else None), f"level-{n}", heavy=True))
        level, types = _summed(answers[-1], buckets)
        levels.append(level)
        if n == 1:
            totals = totals._replace(types=types)
    kind = blocks.schema["ids"].dataType.elementType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            columns = [pa.array(row["ids"], id_type), *map(pa.array, _scores(row, levels, totals, hot_from))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _with_answers(blocks, answers, tasks).mapInArrow(run, schema)
