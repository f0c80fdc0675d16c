"""Removal of repeated 100-byte strings with a distributed sparse suffix array.

A suffix array over every byte would move a hundred bytes for each byte of
text. Suffixes are kept only at anchors chosen by content: of every 100-byte
window the place of its smallest 32-byte gram (by hash, then leftmost). Equal
windows have equal anchors at equal distances, so no repeat is lost.

1. Anchors are found, and those whose gram occurs once in all documents go.
2. The suffixes at the others, with the windows they stand for, are
   range-partitioned by their leading bytes; splitters come from a bounded
   sample of them and go on to document and position, so that a gram shared by
   a third of all documents is divided among many buckets. Each bucket is
   sorted by multikey quicksort; in each run of equal grams, windows equal to
   an earlier one are marked. Runs that a splitter cuts through hand on the
   windows they saw first, which are compared across buckets.
3. Marks meet their documents, and the bytes they leave are put together.

Copies of whole documents are recognised by digest beforehand: all but the
first are removed entirely and take no part in step 2.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poseval.llm.common import staged, tasks_for
from poseval.llm.numbered import numbered

WINDOW = 100
GRAM = 32
REACH = WINDOW - GRAM
#: Bytes looked at together; longer documents are cut into overlapping pieces.
CHUNK = 1 << 21
#: Anchors that one task holds before it passes them on.
HELD = 1 << 21
#: Suffixes of one bucket, and of the sample that splitters are taken from.
BUCKET = 1 << 15
SAMPLE = 50_000
_RANDOM = np.random.default_rng(7)
_BYTE = _RANDOM.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _rolling(data: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Hashes of all substrings whose length is the sum of the given powers of two."""
    width = sum(sizes)
    n = len(data) - width + 1
    h, size, found = _BYTE[data], 1, {1: None}
    with np.errstate(over="ignore"):
        for wanted in sorted(sizes):
            while size < wanted:
                h = h[:-size] * _power(size) + h[size:]
                size *= 2
            found[wanted] = h
        total, at = np.zeros(n, np.uint64), 0
        for s in sizes:
            total = total * _power(s) + found[s][at : at + n]
            at += s
        return (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def anchors(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """``gram hash, anchor, first window, last window`` of the texts ``data[start:stop]``.

    Windows of one text that have the same anchor follow each other.
    """
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none.astype(np.uint64), none, none, none
    gram = _rolling(data, [GRAM])
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    for step in (1, 2, 4, 8, 16, 32):
        least = np.minimum(least[:-step], least[step:])
    rest = REACH + 1 - 64
    least = np.minimum(least[:-rest], least[rest:])
    count = np.maximum(stops - starts - WINDOW + 1, 0)
    windows = np.repeat(starts - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
    if not len(windows):
        return none.astype(np.uint64), none, none, none
    place = (least[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.r_[True, (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)]
    at = np.flatnonzero(first)
    last = np.r_[at[1:], len(windows)] - 1
    return gram[place[at]], place[at], windows[at], windows[last]


def _pack(first: np.ndarray, left: np.ndarray, span: np.ndarray) -> np.ndarray:
    return (first << 14) | (left << 7) | span


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``data, starts, stops, seq, shift`` pieces of a batch of ``seq, text``; a long text gives several."""
    column, seqs = batch.column("text"), np.asarray(batch.column("seq"))
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    pieces: list[tuple[int, int, int]] = []
    for k in range(len(column)):
        at, stop = int(offsets[k]), int(offsets[k + 1])
        while True:
            end = min(stop, at + CHUNK)
            pieces.append((k, at, end))
            if end == stop:
                break
            at = end - WINDOW + 1
    held = 0
    group: list[tuple[int, int, int]] = []
    for p in [*pieces, None]:
        if group and (p is None or held + p[2] - p[1] > CHUNK):
            k, a, b = np.array(group).T
            data = np.concatenate([whole[i:j] for i, j in zip(a, b)])
            stops = np.cumsum(b - a)
            starts = stops - (b - a)
            yield data, starts, stops, seqs[k], a - offsets[k] - starts
            group, held = [], 0
        if p is not None:
            group.append(p)
            held += p[2] - p[1]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _found_anchors(rows: DataFrame, sample: int) -> DataFrame:
    """Anchors of all texts: one of each gram per task to be counted, others known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            gram, seq, packed, lead = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(gram, kind="stable")
            gram, seq, packed, lead = gram[order], seq[order], packed[order], lead[order]
            first = np.r_[True, gram[1:] != gram[:-1]]
            twice = ~first | np.r_[~first[1:], False]
            mixed = _mix(seq.view(np.uint64) * np.uint64(31) + packed.view(np.uint64))
            # One row per gram is counted, and is a candidate at once if the task has another.
            key = np.where(first, gram, mixed).view(np.int64)
            kind = np.where(first, np.where(twice, 2, 0), 1).astype(np.int8)
            for k in range(0, len(key), 100_000):
                s = slice(k, k + 100_000)
                columns = [pa.array(x[s]) for x in (key, seq, packed, kind)] + [pa.array(lead[s], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "seq", "packed", "kind", "lead"])

        for b in batches:
            for data, starts, stops, seqs, shift in _chunks(b):
                gram, place, first, last = anchors(data, starts, stops)
                if not len(gram):
                    continue
                owner = np.searchsorted(stops, place, "right")
                seq = seqs[owner]
                packed = _pack(first + shift[owner], place - first, last - first)
                lead = np.full(len(gram), None, object)
                chosen = _mix(seq.view(np.uint64) * np.uint64(31) + packed.view(np.uint64)) % np.uint64(sample) == 0
                for k in np.flatnonzero(chosen):
                    lead[k] = data[place[k] : place[k] + GRAM].tobytes()
                held.append((gram, seq, packed, lead))
                n += len(gram)
                if n >= HELD:
                    yield from flush()
                    held.clear()
                    n = 0
        yield from flush()

    return rows.mapInArrow(run, "key long, seq long, packed long, kind byte, lead binary")


def _repeated(found: DataFrame, tasks: int) -> DataFrame:
    """``seq, packed, lead`` of anchors whose gram occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held)
        held.clear()
        key, kind = t["key"].to_numpy(), t["kind"].to_numpy()
        counted = np.flatnonzero(kind != 1)
        order = counted[np.argsort(key[counted], kind="stable")]
        same = key[order][1:] == key[order][:-1]
        keep = kind > 0
        keep[order[1:][same]] = True
        keep[order[:-1][same]] = True
        yield from t.select(["seq", "packed", "lead"]).filter(pa.array(keep)).combine_chunks().to_batches(100_000)

    return found.repartition(tasks, "key").mapInArrow(run, "seq long, packed long, lead binary")


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of rows of big-endian words: split in three by one word, equal rows go on with the next."""
    out = np.empty(len(words), np.int64)
    todo = [(np.arange(len(words)), 0, 0)]
    while todo:
        rows, depth, at = todo.pop()
        if depth == words.shape[1] or len(rows) < 2:
            out[at : at + len(rows)] = rows
            continue
        if len(rows) <= 64:
            out[at : at + len(rows)] = rows[np.lexsort(words[rows, depth:].T[::-1])]
            continue
        key = words[rows, depth]
        middle = np.partition(key[:: max(1, len(key) // 63)], len(key[:: max(1, len(key) // 63)]) // 2)
        pivot = middle[len(middle) // 2]
        less, equal = key < pivot, key == pivot
        low, same = int(less.sum()), int(equal.sum())
        todo.append((rows[less], depth, at))
        todo.append((rows[equal], depth + 1, at + low))
        todo.append((rows[~less & ~equal], depth, at + low + same))
    return out


def _sources(data: np.ndarray, at: np.ndarray, context: np.ndarray) -> np.ndarray:
    """For each window the first equal one before it, or itself.

    ``at`` are the windows' places in ``data``, earliest first among equal
    ones. Hashes find the equal windows; bytes decide: all of them where a
    stretch of matches begins, and the one that each further window adds.
    """
    hashed = _rolling(data, [64, 32, 4])[at]
    order = np.argsort(hashed, kind="stable")
    ranked = hashed[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    source = np.empty(len(at), np.int64)
    source[order] = np.repeat(order[first], np.diff(np.r_[first, len(order)]))
    twin = source != np.arange(len(at))
    before = np.r_[False, twin[1:] & twin[:-1] & (source[1:] == source[:-1] + 1)]
    before[1:] &= (context[1:] == context[:-1]) & (context[source[1:]] == context[source[:-1]])
    before[1:] &= (at[1:] == at[:-1] + 1) & (at[source[1:]] == at[source[:-1]] + 1)
    begins, goes_on = np.flatnonzero(twin & ~before), np.flatnonzero(before)
    good = bool((data[at[goes_on] + WINDOW - 1] == data[at[source[goes_on]] + WINDOW - 1]).all())
    span = np.arange(WINDOW)
    for k in range(0, len(begins), 1 << 14):
        some = begins[k : k + (1 << 14)]
        good = good and bool((data[at[some][:, None] + span] == data[at[source[some]][:, None] + span]).all())
    if not good:  # two windows of one hash: compare by content
        seen: dict[bytes, int] = {}
        for w, i in enumerate(at.tolist()):
            source[w] = seen.setdefault(data[i : i + WINDOW].tobytes(), w)
    return source


def _compare(seq, first, left, span, texts: list[bytes], open_low: bytes | None, open_high: bytes | None) -> Iterator[tuple]:
    """Marks ``(seq, start, end, None)`` of one bucket, and windows ``(seq, start, end, digest)`` seen first in cut runs."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.r_[0, np.cumsum(span + WINDOW)[:-1]]
    words = np.ascontiguousarray(data[(begin + left)[:, None] + np.arange(GRAM)]).view(">u8").astype(np.uint64)
    order = multikey_quicksort(words)
    differs = np.r_[True, (words[order][1:] != words[order][:-1]).any(axis=1)]
    run = np.cumsum(differs) - 1
    # Within a run the earliest come first.
    order = order[np.lexsort((first[order], seq[order], run))]
    sizes = np.bincount(run)
    grams = [data[begin[k] + left[k] :][:GRAM].tobytes() for k in order[np.flatnonzero(differs)[[0, -1]]].tolist()]
    cut = np.zeros(len(sizes), bool)
    cut[0] |= grams[0] in (open_low, open_high)
    cut[-1] |= grams[1] in (open_low, open_high)
    keep = order[(sizes[run] > 1) | cut[run]]
    if not len(keep):
        return
    is_cut = cut[run[(sizes[run] > 1) | cut[run]]]
    count = span[keep] + 1
    context = np.repeat(np.arange(len(keep)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = begin[keep][context] + inside
    source = _sources(data, at, context)
    again = source != np.arange(len(at))
    edge = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (again[1:] != again[:-1])])
    stop = np.r_[edge[1:], len(at)] - 1
    marked = again[edge]
    start = first[keep][context] + inside
    for i, j in zip(edge[marked], stop[marked]):
        yield int(seq[keep[context[i]]]), int(start[i]), int(start[j]) + WINDOW, None
    for w in np.flatnonzero(~again & is_cut[context]):
        content = data[at[w] : at[w] + WINDOW].tobytes()
        s = int(start[w])
        yield int(seq[keep[context[w]]]), s, s + WINDOW, hashlib.blake2b(content, digest_size=16).digest()


def _marks(suffixes: DataFrame, splitters: list[tuple], tasks: int) -> DataFrame:
    schema = "seq long, start long, stop long, digest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        held.clear()
        buckets = t["bucket"].to_numpy()
        order = np.argsort(buckets, kind="stable")
        cuts = np.flatnonzero(np.diff(buckets[order])) + 1
        for own in np.split(order, cuts):
            k = int(buckets[own[0]])
            part = t.take(pa.array(own))
            seq, packed = part["seq"].to_numpy(), part["packed"].to_numpy()
            low = splitters[k - 1][0] if k else None
            high = splitters[k][0] if k < len(splitters) else None
            found = _compare(
                seq, packed >> 14, packed >> 7 & 127, packed & 127, part["context"].to_pylist(), low, high
            )
            rows = list(found)
            for i in range(0, len(rows), 50_000):
                seqs, start, stop, digest = zip(*rows[i : i + 50_000])
                columns = [pa.array(seqs), pa.array(start), pa.array(stop), pa.array(digest, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["seq", "start", "stop", "digest"])

    return suffixes.repartition(tasks, "bucket").mapInArrow(run, schema)


def _suffixes(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """``bucket, seq, packed, context`` from texts and the places of their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for seq, text, places in zip(*(b.column(c).to_pylist() for c in ("seq", "text", "places"))):
                places.sort()
                contexts, buckets = [], []
                for p in places:
                    first, left, span = p >> 14, p >> 7 & 127, p & 127
                    contexts.append(text[first : first + span + WINDOW])
                    lead = text[first + left : first + left + GRAM]
                    buckets.append(bisect_left(splitters, (lead, seq, p)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int32()), pa.array([seq] * len(places)), pa.array(places), pa.array(contexts, pa.binary())],
                    names=["bucket", "seq", "packed", "context"],
                )

    return rows.mapInArrow(run, "bucket int, seq long, packed long, context binary")


def _kept(rows: DataFrame) -> DataFrame:
    """What the marks leave of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for seq, text, spans in zip(*(b.column(c).to_pylist() for c in ("seq", "text", "spans"))):
                merged: list[list[int]] = []
                for s in sorted(spans, key=lambda s: s["start"]):
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["stop"])
                    else:
                        merged.append([s["start"], s["stop"]])
                parts, at = [], 0
                for i, j in merged:
                    parts.append(text[at:i])
                    at = j
                parts.append(text[at:])
                out.append((seq, merged, b"".join(parts)))
            if out:
                seqs, merged, left = zip(*out)
                spans = pa.array([[{"start": i, "stop": j} for i, j in m] for m in merged], b.schema.field("spans").type)
                yield pa.RecordBatch.from_arrays([pa.array(seqs), spans, pa.array(left, pa.binary())], names=["seq", "spans", "kept"])

    return rows.mapInArrow(run, "seq long, spans array<struct<start: long, stop: long>>, kept binary")


def repeated_strings(docs: DataFrame, bucket: int = BUCKET, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: per row the removed byte ranges and the bytes left.

    A byte goes when a 100-byte string that covers it starts earlier, too: in a
    row of smaller ``doc_id``, or earlier in its own. Strings never cross rows
    and are judged on the input. A null text is empty; texts under 100 bytes
    are never touched. A null id comes before all others; rows that share an id
    come in the order of their texts' digests, and repeated rows are copies of
    the first. ``kept`` is null where nothing goes (the text as it is) and
    ``spans`` is then empty. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    heads, rows = numbered(docs)
    size = heads.agg(F.coalesce(F.sum(F.col("n_bytes") * F.col("copies")), F.lit(0))).first()[0]
    tasks = tasks_for(spark, size // 35, 1 << 19)
    found = staged(_repeated(_found_anchors(rows, 64), tasks), "anchors", heavy=True)
    copies = heads.where("copy").select("seq")
    places = found.join(copies, "seq", "left_anti")
    # The sample grows thinner as candidates grow, by a hash of their place.
    n = found.count()
    thin = max(1, -(-n // (64 * sample)))
    chosen = found.where("lead IS NOT NULL").where(F.pmod(F.xxhash64("packed", "seq"), F.lit(thin)) == 0)
    leads = sorted((bytes(r["lead"]), r["seq"], r["packed"]) for r in chosen.collect())
    buckets = max(1, -(-n // bucket))
    splitters = sorted({leads[k * len(leads) // buckets] for k in range(1, buckets)}) if leads else []
    grouped = places.groupBy("seq").agg(F.collect_list("packed").alias("places"))
    suffixes = _suffixes(rows.join(grouped, "seq"), splitters)
    marks = staged(_marks(suffixes, splitters, tasks_for(spark, n, 1 << 18)), "marks", heavy=True)
    in_order = Window.partitionBy("digest").orderBy("seq", "start")
    across = marks.where("digest IS NOT NULL").withColumn("nth", F.row_number().over(in_order)).where("nth > 1")
    spans = marks.where("digest IS NULL").select("seq", "start", "stop").union(across.select("seq", "start", "stop"))
    spans = spans.groupBy("seq").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    left = _kept(rows.join(spans, "seq")).withColumnRenamed("seq", "_seq")
    merged = heads.join(left, heads["seq"] == F.col("_seq"), "left").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    gone = (F.col("copy") | (F.col("nth") > 1)) & (F.col("n_bytes") >= WINDOW)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    return merged.select(
        "doc_id",
        "n_bytes",
        F.when(gone, all_of_it).otherwise(F.coalesce("spans", F.array())).alias("spans"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        "sha",
    )
