"""Reduction of tables that are already sorted by key, without moving the data.

In a sorted table the rows of a key follow each other, so a task can reduce
what it reads as it comes. Only the first and the last key of a stretch (the
rows one task reads in a row from one file) may go on elsewhere; their partial
results are a border table of two rows per stretch. It is reduced on its own,
and the finished rows go back to the place where their key begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseval.functions import codec as C
from poseval.operators import ordinal as O
from poseval.schema import require_columns, to_unsigned, unsigned_order

# Border rows up to which they are sent to every task: two per stretch.
MAX_BROADCAST_BORDERS = 200_000
INNER, BORDER, FALL = 0, 1, 2
_SPLIT, _OPEN = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def one_stretch_per_task(spark: SparkSession):
    """Inside, scans that start give every task a piece of one file only.

    Opening a file is then counted as a full task's worth of bytes, so that
    Spark never packs two files into one task.
    """
    return _settings(spark, **{_OPEN: spark.conf.get(_SPLIT)})


def one_file_per_task(spark: SparkSession):
    """Inside, scans that start give every task one whole file."""
    return _settings(spark, **{_SPLIT: str(2**62), _OPEN: str(2**62)})


class _Open:
    """The last group of what was read so far: its key, rows, first place and content."""

    def __init__(self, key: int, n: int, row: int, content):
        self.key, self.n, self.row, self.content = key, n, row, content


class _LastRow:
    """Reduces a group to its last row."""

    def closed(self, values: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        return [values.column(i).take(pa.array(ends - 1)) for i in range(values.num_columns)]

    def open(self, values: pa.RecordBatch, start: int, end: int):
        return values.slice(end - 1, 1)

    def extend(self, content, values: pa.RecordBatch, end: int):
        return values.slice(end - 1, 1) if end else content

    def finish(self, content) -> list[pa.Array]:
        return content.columns


class _Entries:
    """Reduces a group to its entries, one after the other."""

    def _bytes(self, values: pa.RecordBatch, start: int, end: int) -> bytes:
        return b"".join(values.column(0).slice(start, end - start).to_pylist())

    def closed(self, values: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        # All entries have one length, so groups are slices of the column's bytes.
        data = self._bytes(values, 0, values.num_rows)
        size = C.ENTRY_BYTES
        return [pa.array([data[size * s : size * e] for s, e in zip(starts.tolist(), ends.tolist())], pa.binary())]

    def open(self, values: pa.RecordBatch, start: int, end: int) -> bytes:
        return self._bytes(values, start, min(end, start + C.MAX_ENTRIES + 1))

    def extend(self, content: bytes, values: pa.RecordBatch, end: int) -> bytes:
        # One entry over the limit is enough to tell that there are too many.
        room = C.MAX_ENTRIES + 1 - len(content) // C.ENTRY_BYTES
        return content + self._bytes(values, 0, min(end, max(room, 0)))

    def finish(self, content: bytes) -> list[pa.Array]:
        return [pa.array([content], pa.binary())]


def _reduced(rows: DataFrame, values: list[str], reduce: _LastRow | _Entries) -> DataFrame:
    """``kind, order, n, file, row`` and the reduced ``values`` of every group of every stretch.

    ``rows`` has ``order`` (rises with the key), ``file``, ``row`` and
    ``values``, in scan order. ``row`` is where the group begins. Rows of kind
    ``FALL`` name places where the key falls.
    """
    fields = [rows.schema[v] for v in values]
    schema = T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            T.StructField("order", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("file", T.StringType()),
            T.StructField("row", T.LongType()),
            *[T.StructField(f.name, f.dataType) for f in fields],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in schema.fields]
        types: list[pa.DataType] = []
        current: _Open | None = None
        file, last_row, fresh = None, -1, True

        def out(kind, order, n, row, columns) -> pa.RecordBatch:
            size = len(order)
            head = [pa.array(np.full(size, kind), pa.int32()), pa.array(order, pa.int64()), pa.array(n, pa.int64())]
            head += [pa.array([file] * size, pa.string()), pa.array(row, pa.int64())]
            return pa.RecordBatch.from_arrays([*head, *[c.cast(t) for c, t in zip(columns, types)]], names=names)

        def border() -> pa.RecordBatch:
            return out(BORDER, [current.key], [current.n], [current.row], reduce.finish(current.content))

        def stretch(key: np.ndarray, row: np.ndarray, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """Rows that continue the open stretch; ``fresh`` says that its first group is still open."""
            nonlocal current, fresh
            falls = np.flatnonzero(key[1:] < key[:-1]) + 1
            if current is not None and key[0] < current.key:
                falls = np.concatenate([[0], falls])
            if len(falls):
                yield out(FALL, key[falls], np.zeros(len(falls), np.int64), row[falls], [pa.nulls(len(falls), t) for t in types])
            starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            ends = np.append(starts[1:], len(key))
            if current is not None and key[0] == current.key:
                current.content = reduce.extend(current.content, part, int(ends[0]))
                current.n += int(ends[0])
                starts, ends = starts[1:], ends[1:]
                if not len(starts):
                    return
            if current is not None:
                kind = BORDER if fresh else INNER
                yield out(kind, [current.key], [current.n], [current.row], reduce.finish(current.content))
                fresh = False
            if len(starts) > 1 and fresh:
                # The first group of the stretch begins and ends in this batch.
                s, e = int(starts[0]), int(ends[0])
                current = _Open(int(key[s]), e - s, int(row[s]), reduce.open(part, s, e))
                yield border()
                fresh = False
                starts, ends = starts[1:], ends[1:]
            if len(starts) > 1:
                s, e = starts[:-1], ends[:-1]
                yield out(INNER, key[s], e - s, row[s], reduce.closed(part, s, e))
            s, e = int(starts[-1]), int(ends[-1])
            current = _Open(int(key[s]), e - s, int(row[s]), reduce.open(part, s, e))

        for b in batches:
            if not b.num_rows:
                continue
            types = [b.schema.field(v).type for v in values]
            place = b.column(1).dictionary_encode()
            code, row, key = place.indices.to_numpy(), b.column(2).to_numpy(), b.column(0).to_numpy()
            content = pa.RecordBatch.from_arrays(b.columns[3:], names=values)
            cuts = np.flatnonzero((code[1:] != code[:-1]) | (row[1:] <= row[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                name = place.dictionary[int(code[lo])].as_py()
                if current is not None and (name != file or row[lo] <= last_row):
                    yield border()
                    current, fresh = None, True
                file = name
                yield from stretch(key[lo:hi], row[lo:hi], content.slice(lo, hi - lo))
                last_row = int(row[hi - 1])
        if current is not None:
            yield border()

    return rows.select("order", "file", "row", *values).mapInArrow(run, schema)


def _require_rising(reduced: DataFrame) -> None:
    """Stop at a place where the key falls, inside a stretch or from one to the next."""
    ends = reduced.where(F.col("kind") == BORDER).select("file", "row", "order")
    before = F.lag("order").over(Window.orderBy("file", "row"))
    across = ends.withColumn("before", before).where("order < before").select("file", "row")
    first = reduced.where(F.col("kind") == FALL).select("file", "row").unionByName(across).limit(1).collect()
    if first:
        raise ValueError(f"input is not sorted by zobr64 (file {first[0]['file']}, row {first[0]['row']})")


def _stitched(reduced: DataFrame, whole: Column, values: list[str]) -> DataFrame:
    """One row per key from a stored ``_reduced`` table: ``order, n`` and ``values``, nothing shuffled but borders.

    ``whole`` combines the border rows of a key into a struct of ``values``.
    """
    borders = reduced.where(F.col("kind") == BORDER)
    place = F.struct("file", "row")
    ends = borders.groupBy("order").agg(F.min(place).alias("_at"), whole.alias("_whole"), F.sum("n").alias("_n"))
    if borders.count() <= MAX_BROADCAST_BORDERS:
        ends = F.broadcast(ends)
    joined = reduced.where(F.col("kind") != FALL).join(ends, "order", "left")
    border = F.col("kind") == BORDER
    kept = joined.where(~border | (place == F.col("_at")))
    pick = [F.when(border, F.col("_whole")[v]).otherwise(F.col(v)).alias(v) for v in values]
    return kept.select("order", F.when(border, F.col("_n")).otherwise(F.col("n")).alias("n"), *pick)


def _placed(df: DataFrame, values: list[str], order: list[str]) -> DataFrame:
    missing = F.raise_error(F.lit("a row has no key")).cast("bigint")
    key = F.coalesce(unsigned_order(F.col("key64")), missing)
    return df.select(key.alias("order"), F.col(order[0]).alias("file"), F.col(order[1]).cast("bigint").alias("row"), *values)


def latest_of_runs(df: DataFrame, values: list[str], put, order: tuple[str, str] = (O.FILE, O.ROW)) -> DataFrame:
    """Per key the last row of a table sorted by key: ``key64``, ``values`` and ``n``, its rows.

    ``df`` is a file scan with ``key64`` and its place in ``order``; ``put``
    stores the reduced rows (see ``session.staging``). A table that is not
    sorted stops with a ``ValueError``.
    """
    require_columns(df, ["key64", *values, *order])
    with one_stretch_per_task(df.sparkSession):
        reduced = put(_reduced(_placed(df, values, list(order)), values, _LastRow()), "runs")
    _require_rising(reduced)
    found = _stitched(reduced, F.max_by(F.struct(*values), F.struct("file", "row")), values)
    return found.select(unsigned_order(F.col("order")).alias("key64"), *values, "n")


def repeated_of_runs(df: DataFrame, put, order: tuple[str, str] = (O.FILE, O.ROW)) -> DataFrame:
    """``key64, n`` of the keys that a table sorted by key holds more than once.

    Only the key is read. What is stored are the repeated keys and two rows per
    stretch, so a table with few duplicates moves next to nothing, however large.
    """
    require_columns(df, ["key64", *order])
    with one_stretch_per_task(df.sparkSession):
        reduced = _reduced(_placed(df, [], list(order)), [], _LastRow())
        reduced = put(reduced.where((F.col("kind") != INNER) | (F.col("n") > 1)), "runs")
    _require_rising(reduced)
    found = _stitched(reduced, F.struct(F.lit(True).alias("any")), [])
    return found.where("n > 1").select(unsigned_order(F.col("order")).alias("key64"), "n")


def entries_of_runs(df: DataFrame, put, order: tuple[str, str] = (O.FILE, O.ROW)) -> DataFrame:
    """Per key all entries of a table sorted by key: ``key64, entries, n``, entries joined in arrival order.

    More than 255 entries under one key is an error, as in ``grouped_entries``.
    """
    require_columns(df, ["key64", "entry", *order])
    with one_stretch_per_task(df.sparkSession):
        reduced = put(_reduced(_placed(df, ["entry"], list(order)), ["entry"], _Entries()), "runs")
    _require_rising(reduced)
    parts = F.array_sort(F.collect_list(F.struct("file", "row", F.hex("entry").alias("entry"))))
    whole = F.unhex(F.array_join(F.transform(parts, lambda p: p["entry"]), ""))
    found = _stitched(reduced, F.struct(whole.alias("entry")), ["entry"])
    key = unsigned_order(F.col("order"))
    too_many = F.concat(F.lit("too many entries for key "), to_unsigned(key).cast("string"))
    entries = F.when(F.col("n") > C.MAX_ENTRIES, F.raise_error(too_many).cast("binary")).otherwise(F.col("entry"))
    return found.select(key.alias("key64"), entries.alias("entries"), "n")
