"""SimHash near-duplicates: candidates from shared bits, discarded by pivot distances.

Two fingerprints that differ in at most 4 bits agree wholly in 2 of 6 blocks,
so each fingerprint joins one group for each of the 15 pairs of blocks. Each
carries its row of the pivot table, its Hamming distances to fixed reference
fingerprints. By the triangle inequality two rows that differ by more than 4 in
any coordinate belong to fingerprints further apart than 4; pairs left by this
maximum test are verified bit by bit.

Only distinct fingerprints take part. A group beyond ``GROUP`` members is not
searched: its members go on to the next level, where the bits they don't share
by their group are cut in five parts, of which a linked pair shares one. Groups
are thus bounded at every level, and after a few levels so few bits are free
that no group can be larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poseval.llm.common import free_name, staged, texts
from poseval.llm.components import connected_components

SEED = 42
SHINGLE = 4
MAX_BITS = 4
PIVOTS = 32
GROUP = 4096
#: Groups up to this size are compared pair by pair, all groups of a batch at once.
SMALL = 32
_BYTE_AT = np.arange(8, dtype=np.int64) * 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the ASCII-lower-cased words; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(digest(joined, SEED), "big")
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    found = b"".join([digest(joined[i:j], SEED) for i, j in zip(starts, stops)])
    each = np.frombuffer(found, np.uint8).reshape(-1, 8) + _BYTE_AT
    counts = np.bincount(each.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(2 * counts.ravel() > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a BIGINT with the same bits."""
    rows = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, the same for every run."""
    return np.random.default_rng(64).integers(0, 1 << 64, n, dtype=np.uint64)


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fp, distances``: one byte for each reference fingerprint."""
    refs = pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = np.asarray(b.column(0)).view(np.uint64)
            table = np.bitwise_count(own[:, None] ^ refs).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), _binary(table)], names=["fp", "distances"])

    return fps.select("fp").mapInArrow(run, "fp long, distances binary")


def _binary(table: np.ndarray) -> pa.Array:
    n, width = table.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(table))])


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _parts(free: int, n: int) -> list[int]:
    """Masks that divide the free bits into ``n`` parts."""
    bits = [b for b in range(64) if free >> b & 1]
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(bits, dtype=object), n)]


def _keys(group: np.ndarray, fps: np.ndarray, free: int, first: bool) -> Iterator[tuple[np.ndarray, int]]:
    """Group keys of the next level with the bits that stay free in it."""
    if first:
        masks = [a | b for a, b in combinations(_parts(free, MAX_BITS + 2), 2)]
    else:
        masks = [m for m in _parts(free, MAX_BITS + 1)]
    for k, mask in enumerate(masks):
        yield _mix(_mix(group + np.uint64(k + 1)) ^ (fps & np.uint64(mask))), free & ~mask


def _spread(rows: DataFrame, first: bool) -> DataFrame:
    """Each fingerprint once for each group of the next level."""
    schema = "grp long, free long, fp long, distances binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.asarray(b.column("fp"))
            group = np.asarray(b.column("grp")).view(np.uint64)
            frees = np.asarray(b.column("free")).view(np.uint64)
            for free in np.unique(frees).tolist():
                at = np.flatnonzero(frees == np.uint64(free))
                dist = b.column("distances").take(pa.array(at))
                for keys, left in _keys(group[at], fps[at].view(np.uint64), free, first):
                    mask = np.full(len(at), left, np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(mask), pa.array(fps[at]), dist],
                        names=["grp", "free", "fp", "distances"],
                    )

    return rows.mapInArrow(run, schema)


def _near(fps: np.ndarray, table: np.ndarray, i, j) -> np.ndarray:
    """Which pairs are linked: pivot test first, then the bits of what it leaves."""
    left = (np.abs(table[i] - table[j]) <= MAX_BITS).all(axis=-1)
    left[left] = np.bitwise_count((fps[i] ^ fps[j])[left]) <= MAX_BITS
    return left


def _small_links(group: np.ndarray, fps: np.ndarray, table: np.ndarray, widest: int) -> Iterator[tuple]:
    """Pairs of all small groups: each row with the row d places on, while both are of one group."""
    for d in range(1, widest):
        i = np.flatnonzero(group[d:] == group[:-d])
        near = _near(fps, table, i, i + d)
        yield fps[i[near]], fps[i[near] + d]


def _walk_links(fps: np.ndarray, table: np.ndarray) -> Iterator[tuple]:
    """Links that connect a large group as all its pairs would.

    Each member is compared with those not yet reached whose first coordinate
    is close enough, so a group of near copies takes about one comparison each.
    """
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    first, waiting = table[:, 0], np.ones(len(fps), bool)
    for seed in range(len(fps)):
        reached = [seed] if waiting[seed] else []
        waiting[seed] = False
        while reached:
            at = reached.pop()
            lo, hi = np.searchsorted(first, [first[at] - MAX_BITS, first[at] + MAX_BITS + 1])
            rest = lo + np.flatnonzero(waiting[lo:hi])
            new = rest[_near(fps, table, np.full(len(rest), at), rest)]
            waiting[new] = False
            reached.extend(new.tolist())
            yield np.full(len(new), fps[at]), fps[new]


def _search(rows: DataFrame, group: int) -> DataFrame:
    """Links within groups, as ``(fp, other)``; members of oversized groups come back with no ``other``."""
    schema = "grp long, free long, fp long, distances binary, other long"

    def links(pairs) -> Iterator[pa.RecordBatch]:
        for a, b in pairs:
            if len(a):
                a, b = pa.array(a.view(np.int64)), pa.array(b.view(np.int64))
                none = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, none, a, pa.nulls(len(a), pa.binary()), b], names=["grp", "free", "fp", "distances", "other"]
                )

    def whole(t: pa.Table, group_of: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Search complete groups."""
        cuts = np.flatnonzero(np.diff(group_of)) + 1
        starts, sizes = np.r_[0, cuts], np.diff(np.r_[0, cuts, len(group_of)])
        fps = t["fp"].to_numpy().view(np.uint64)
        table = np.frombuffer(b"".join(t["distances"].to_pylist()), np.uint8).reshape(-1, PIVOTS).astype(np.int16)
        small = np.repeat(sizes <= SMALL, sizes) & np.repeat(sizes > 1, sizes)
        if small.any():
            widest = int(sizes[sizes <= SMALL].max())
            yield from links(_small_links(group_of[small], fps[small], table[small], widest))
        for k in np.flatnonzero(sizes > SMALL):
            at = slice(starts[k], starts[k] + sizes[k])
            yield from links(_walk_links(fps[at], table[at]))

    def oversized(t: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from t.append_column("other", pa.nulls(len(t), pa.int64())).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, over = None, None  # the last group so far; the group that has turned out too large
        for b in batches:
            if b.num_rows == 0:
                continue
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            keys = t["grp"].to_numpy()
            start = int(np.searchsorted(keys, over, "right")) if over is not None else 0
            if start:
                yield from oversized(t.slice(0, start))
            if start == len(t):
                rest = None
                continue
            over = None
            last = int(np.searchsorted(keys, keys[-1], "left"))
            if last > start:
                yield from whole(t.slice(start, last - start), keys[start:last])
            rest = t.slice(max(last, start)).combine_chunks()
            if len(rest) > group:
                yield from oversized(rest)
                rest, over = None, keys[-1]
        if rest is not None and len(rest) > 1:
            yield from whole(rest, rest["grp"].to_numpy())

    dealt = rows.repartition("grp").sortWithinPartitions("grp", "fp")
    return dealt.mapInArrow(run, schema)


def fingerprint_links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """``(fp, other)``: links that join the same fingerprints as all pairs within 4 bits would.

    ``group`` bounds what one search holds; 16 members is what 4 free bits can tell apart.
    """
    if group < 16:
        raise ValueError("group must be at least 16")
    table = staged(pivot_table(fps), "pivot-table")
    rows = table.select(F.lit(0).cast("long").alias("grp"), F.lit(-1).cast("long").alias("free"), "fp", "distances")
    out, first = None, True
    while True:
        found = staged(_search(_spread(rows, first), group), "simhash", heavy=True)
        links = found.where("other IS NOT NULL").select("fp", "other")
        out = links if out is None else out.union(links)
        rows, first = found.where("other IS NULL").drop("other"), False
        if rows.isEmpty():
            return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, component_id`` per document; linked within 4 bits, named by the smallest ``doc_id``.

    A null text is empty and has fingerprint 0. Documents with a null id belong
    to their component but never name it unless it has no other. Repeated rows
    are rows of one fingerprint. An empty table gives no rows; columns other than ``doc_id``
    and ``text`` are ignored.
    """
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    joined = staged(connected_components(fingerprint_links(distinct), "fp", "other"), "components")
    member = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_doc", F.coalesce("component", "fp").alias("component")
    )
    least = member.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = staged(member.join(least, "component").select("fp", "component_id"), "named-fingerprints")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id names their component, with their columns.

    An id names one text; its repeated rows stay together. Of documents without an id those
    linked to one with an id go, and of the others one of each fingerprint stays.
    """
    marked = staged(near_duplicates(docs), "near-duplicates", heavy=True)
    gone = marked.where("doc_id IS NOT NULL AND component_id != doc_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti").select(docs.columns)

    @F.pandas_udf("long")
    def fp(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in text], np.uint64).view(np.int64))

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    own = free_name(docs, "_fp")
    nameless = docs.where("doc_id IS NULL").withColumn(own, fp(text))
    alone = marked.where("doc_id IS NULL AND component_id IS NULL").select(F.col("fp").alias(own))
    nameless = nameless.join(alone, own, "left_semi").dropDuplicates([own]).select(docs.columns)
    return named.union(nameless)
