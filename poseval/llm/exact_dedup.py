"""Exact dedup of batches against immutable snapshots, screened by binary fuse filters.

A snapshot holds the distinct texts of one batch that no earlier snapshot has.
It never changes, so its filters are static: keys (64 bits of the digest) are
divided into shards by their leading bits, and each shard has a binary fuse
filter of about 9 bits per key. A new batch is first grouped by itself, so a
text that fills a third of it is one row from then on. Its digests are screened
shard by shard: what every filter denies is new, without looking at a snapshot.
What a filter admits (its copies, and 1 in 256 others) joins the snapshot's
rows of the same shard and key.

Rows that came together by their digest are compared byte by byte: the smallest
and the largest text of a digest must be equal. That comparison merges in each
task before the shuffle, and only texts of repeated digests take part in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poseval.llm.common import SPACES, free_name, staged, tasks_for, texts

#: Keys of one shard: its filter is built and used by one task.
SHARD_KEYS = 1 << 18
TRIES = 100


def normalised(text: str = "text") -> Column:
    """The text without white space."""
    return F.regexp_replace(F.col(text), SPACES, "")


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class FuseFilter:
    """Static three-way binary fuse filter with 8-bit fingerprints.

    A key's three slots lie in consecutive segments of the table; its
    fingerprint is the XOR of the three. No key that went in is ever denied;
    another key is admitted with probability 1/256.
    """

    def __init__(self, seed: int, segment: int, slots: np.ndarray):
        self.seed, self.segment, self.slots = seed, segment, slots

    @staticmethod
    def _places(hashed: np.ndarray, segment: int, size: int) -> np.ndarray:
        """Slots of each key, as three rows."""
        high = hashed >> np.uint64(32)
        first = ((high * np.uint64(size - 2 * segment)) >> np.uint64(32)).astype(np.int64)
        mask = segment - 1
        second = (first + segment) ^ ((hashed >> np.uint64(18)).astype(np.int64) & mask)
        third = (first + 2 * segment) ^ (hashed.astype(np.int64) & mask)
        return np.stack([first, second, third])

    @staticmethod
    def _prints(hashed: np.ndarray) -> np.ndarray:
        return (hashed ^ (hashed >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> "FuseFilter":
        """Peel keys off slots that only one key uses, then fill slots in reverse order.

        All such keys are peeled at once; each round leaves fewer until none is left.
        """
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 2)
        segment = min(1 << int(np.log(n) / np.log(3.33) + 2.25), 1 << 18)
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
        segments = max(-(-int(n * factor) // segment), 1) + 2
        size = segments * segment
        for seed in range(TRIES):
            hashed = _hash(keys, seed)
            places = cls._places(hashed, segment, size)
            uses = np.bincount(places.ravel(), minlength=size)
            owner = np.zeros(size, np.int64)
            for row in places:
                np.bitwise_xor.at(owner, row, np.arange(len(keys)))
            rounds, single = [], np.flatnonzero(uses == 1)
            while len(single):
                peeled, at = np.unique(owner[single], return_index=True)
                slot = single[at]
                rounds.append((peeled, slot))
                touched = places[:, peeled]
                np.subtract.at(uses, touched.ravel(), 1)
                for row in touched:
                    np.bitwise_xor.at(owner, row, peeled)
                near = np.unique(touched)
                single = near[uses[near] == 1]
            if sum(len(p) for p, _ in rounds) == len(keys):
                slots = np.zeros(size, np.uint8)
                prints = cls._prints(hashed)
                for peeled, slot in reversed(rounds):
                    a, b, c = slots[places[:, peeled]]
                    slots[slot] = prints[peeled] ^ a ^ b ^ c ^ slots[slot]
                return cls(seed, segment, slots)
        raise RuntimeError("no seed gives a filter")

    def admits(self, keys: np.ndarray) -> np.ndarray:
        hashed = _hash(keys.astype(np.uint64), self.seed)
        a, b, c = self.slots[self._places(hashed, self.segment, len(self.slots))]
        return self._prints(hashed) == a ^ b ^ c

    def dump(self) -> bytes:
        return np.array([self.seed, self.segment], "<i8").tobytes() + self.slots.tobytes()

    @classmethod
    def load(cls, data: bytes) -> "FuseFilter":
        seed, segment = np.frombuffer(data[:16], "<i8").tolist()
        return cls(seed, segment, np.frombuffer(data[16:], np.uint8))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, sha, points, copies``: repeated rows of one id and text are counted, not kept."""
    rows = texts(docs).select(
        "doc_id", F.unhex(F.sha2(normalised().cast("binary"), 256)).alias("sha"), F.char_length("text").alias("points")
    )
    return rows.groupBy("doc_id", "sha", "points").agg(F.count(F.lit(1)).alias("copies"))


def _key() -> Column:
    """64 bits of the digest."""
    return F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("long").alias("key")


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")


def _best() -> Column:
    """The document that stays: most code points, then smallest id; a null id comes last."""
    return F.struct("points", F.col("doc_id").isNotNull().alias("named"), (-F.col("doc_id")).alias("minus_id"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest of a batch: its number of rows and the best of them."""
    return rows.groupBy("sha").agg(F.sum("copies").alias("n"), F.max(_best()).alias("best")).withColumn("key", _key())


def filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """``shard, filter``: one static filter per shard of a snapshot's keys."""

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(keys["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "filter": [made.dump()]})

    keyed = snapshot.select("key", _shard(shards))
    return keyed.groupBy("shard").applyInPandas(build, "shard long, filter binary")


def screen(batch: DataFrame, built: DataFrame, shards: int) -> DataFrame:
    """``sha, key`` of the batch's digests that a snapshot's filters admit."""

    def test(keys: pd.DataFrame, made: pd.DataFrame) -> pd.DataFrame:
        if keys.empty or made.empty:
            return keys[["sha", "key"]].head(0)
        found = FuseFilter.load(made["filter"].iloc[0]).admits(keys["key"].to_numpy().view(np.uint64))
        return keys.loc[found, ["sha", "key"]]

    keyed = batch.select("sha", "key", _shard(shards))
    return keyed.groupBy("shard").cogroup(built.groupBy("shard")).applyInPandas(test, "sha binary, key long")


def check_bytes(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``sha`` of repeated digests whose texts are all equal; any other stops the job.

    ``repeated`` has the ``doc_id`` and ``sha`` of the rows to compare.
    """
    text = texts(docs).select("doc_id", normalised().alias("norm"))
    text = text.withColumn("sha", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)))
    wanted = repeated.where("doc_id IS NOT NULL").select("doc_id", "sha").distinct()
    both = text.join(wanted, ["doc_id", "sha"]).groupBy("sha").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    differ = F.raise_error(F.lit("two texts of one digest differ")).cast("boolean")
    return both.where(F.when(F.col("low") == F.col("high"), True).otherwise(differ)).select("sha")


def exact_duplicates(docs: DataFrame, batches: int = 3, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, sha`` per row of ``docs``, which come in as ``batches``.

    Texts are equal when they are after white space is deleted. Of equal texts
    the one with most code points stays, then the smallest id; a null id only
    when no other is there. A null text is empty. Of repeated rows with the
    winning id exactly one is kept. An empty table gives no rows. Rows with a null id
    are compared by digest alone. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    if batches < 1:
        raise ValueError("batches must be at least 1")
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch")
    rows = staged(digests(docs).select("*", batch), "digests")
    snapshots, found = [], []
    for k in range(batches):
        new = staged(grouped(rows.where(F.col("batch") == k)), "batch")
        admitted = []
        for snapshot, built, shards in snapshots:
            positive = screen(new, built, shards)
            admitted.append(positive.join(snapshot.select("key", "sha"), ["key", "sha"], "left_semi").select("sha"))
        fresh = new
        if admitted:
            old = staged(reduce(DataFrame.union, admitted), "admitted")
            fresh = staged(new.join(old, "sha", "left_anti"), "snapshot")
            found.append(new.join(old, "sha", "left_semi"))
        shards = tasks_for(spark, fresh.count(), shard_keys)
        snapshots.append((fresh, staged(filters(fresh, shards), "filters"), shards))
    # A snapshot's row and the rows later batches matched to it make a group; other rows are groups as they are.
    every = reduce(DataFrame.union, [s for s, _, _ in snapshots])
    matched = [f.select("sha", "n", "best") for f in found]
    if matched:
        extra = reduce(DataFrame.union, matched).groupBy("sha").agg(F.sum("n").alias("more"), F.max("best").alias("other"))
        every = every.join(extra, "sha", "left").select(
            "sha", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), F.greatest("best", "other").alias("best")
        )
    groups = staged(every.select("sha", "n", (-F.col("best.minus_id")).alias("keep_id"), F.col("best.points").alias("most")), "groups")
    repeated = groups.where("n > 1")
    same = check_bytes(docs, rows.join(repeated.select("sha"), "sha", "left_semi"))
    unchecked = repeated.where("keep_id IS NULL").select("sha")
    known = staged(same.union(unchecked).distinct(), "compared", heavy=True)
    checked = groups.where("n = 1").union(repeated.join(known, "sha", "left_semi"))
    named = rows.join(checked, "sha").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most")) & (F.col("copy") == 1)
    return named.select("doc_id", "keep_id", F.col("n").alias("group_size"), wins.alias("kept"), "sha")


def drop_exact_duplicates(docs: DataFrame, batches: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    Ids, digests and lengths name a row; of rows alike in all three one stays.
    """
    sha, key = free_name(docs, "_sha"), free_name(docs, "_name")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("none")).alias(key)
    winners = exact_duplicates(docs, batches).where("kept").select(name, F.col("sha").alias(sha))
    text = F.coalesce(F.col("text"), F.lit(""))
    norm = F.regexp_replace(text, SPACES, "")
    rows = docs.select("*", name, F.unhex(F.sha2(norm.cast("binary"), 256)).alias(sha))
    kept = rows.join(winners, [key, sha], "left_semi")
    # One id may come with several spacings of a text: the longest is the one that won.
    longest = F.max_by(F.struct(*docs.columns), F.char_length(text)).alias("_row")
    return kept.groupBy(key, sha).agg(longest).select("_row.*")
