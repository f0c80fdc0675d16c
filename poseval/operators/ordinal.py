"""Arrival order of a stored table: files by name, then rows.

Parquet scans expose the file and the row index inside it, so "the n-th row"
needs only the row count per file, which comes from file footers. Prefixes and
slices become comparisons with at most two (file, row) boundaries; the data is
never windowed, joined or shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poseval.session import stage

FILE = "_file"
ROW = "_row_index"


def file_order(path: Column) -> Column:
    """Sort key of a file: its name, with the part number padded.

    Names with equally wide part numbers sort as plain text; padding keeps
    tables of more than 100,000 parts in order too. Plain string functions:
    the key is computed for every row.
    """
    name = F.substring_index(path, "/", -1)
    number = F.substring_index(F.substring_index(F.substr(name, F.lit(6)), "-", 1), ".", 1).try_cast("bigint")
    padded = F.concat(F.lit("part-"), F.lpad(number.cast("string"), 12, "0"), F.lit("-"), name)
    return F.when(name.startswith("part-"), F.coalesce(padded, name)).otherwise(name)


def with_location(df: DataFrame) -> DataFrame:
    """Add ``_file`` (sortable file name) and ``_row_index`` of a file scan."""
    return df.select(
        "*",
        file_order(F.col("_metadata.file_path")).alias(FILE),
        F.col("_metadata.row_index").alias(ROW),
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """``_file, n, before``: row counts per file and rows in earlier files.

    One row per file, so the ordered running sum is over file counts only.
    """
    paths = df.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    counts = paths.select(file_order(F.col("path")).alias(FILE), "n")
    earlier = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")))


# Files up to which the offsets are sent to every task, about 100 bytes each.
MAX_BROADCAST_FILES = 200_000


def with_row_ordinal(df: DataFrame, name: str = "ord") -> DataFrame:
    """Add the 0-based arrival ordinal of every row of a file scan.

    The offsets are one small row per file. Up to a checked number of files
    they are broadcast and the data stays in place; beyond it Spark sorts and
    merges, splitting large files as skewed partitions.
    """
    offsets = stage(rows_per_file(df).select(FILE, "before"), "file-offsets")
    if offsets.count() <= MAX_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    columns = [F.col(c) for c in df.columns]
    return (
        with_location(df)
        .join(offsets, FILE)
        .select(*columns, (F.col("before") + F.col(ROW)).alias(name))
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def locate(df: DataFrame, ordinals: list[Column]) -> list[tuple[str, int] | None]:
    """(file, row) of each ordinal; None past the end.

    An ordinal may be computed from ``total``, the row count. One job over the
    table of files; one row per ordinal comes back.
    """
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_file = rows_per_file(df).withColumn("total", F.sum("n").over(every))
    wanted = F.array(*[o.cast("bigint") for o in ordinals])
    spots = (
        per_file.select(FILE, "n", "before", F.posexplode(wanted).alias("nth", "target"))
        .where((F.col("target") >= F.col("before")) & (F.col("target") < F.col("before") + F.col("n")))
        .select("nth", FILE, (F.col("target") - F.col("before")).alias("row"))
        .collect()
    )
    found = {s["nth"]: (s[FILE], s["row"]) for s in spots}
    return [found.get(i) for i in range(len(ordinals))]


def _before(spot: tuple[str, int] | None) -> Column:
    """Rows that arrive before the spot; every row when it is past the end."""
    if spot is None:
        return F.lit(True)
    file, row = spot
    return (F.col(FILE) < file) | ((F.col(FILE) == file) & (F.col(ROW) < row))


def _between(located: DataFrame, start: tuple[str, int], end: tuple[str, int] | None) -> DataFrame:
    """Rows from ``start`` to before ``end``.

    The plain file bounds are implied by the row bounds. They are there because
    they touch file metadata only, so Spark drops files outside them unread.
    """
    inside = located.where(F.col(FILE) >= start[0])
    if end is not None:
        inside = inside.where(F.col(FILE) <= end[0])
    return inside.where(~_before(start) & _before(end)).drop(FILE, ROW)


def slice_rows(df: DataFrame, offset: int, length: int) -> DataFrame:
    """Rows ``offset .. offset + length - 1`` in arrival order."""
    if offset < 0 or length < 0:
        raise ValueError("offset and length must not be negative")
    start, end = locate(df, [F.lit(offset), F.lit(offset + length)])
    located = with_location(df)
    if start is None:
        return located.where(F.lit(False)).drop(FILE, ROW)
    return _between(located, start, end)


def head_percent(df: DataFrame, percent: float) -> DataFrame:
    """The first ``ceil(rows * percent / 100)`` rows of a file scan, at least one."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in (0, 100]")
    wanted = F.ceil(F.col("total") * F.lit(percent / 100.0))
    first, end = locate(df, [F.lit(0), F.least(F.greatest(wanted, F.lit(1)), F.col("total"))])
    if first is None:
        raise ValueError("input holds no rows")
    return _between(with_location(df), first, end)


def decile_of(df: DataFrame) -> Column:
    """Expression on ``with_location`` columns: the first of 10, 20, .. 100 whose prefix holds the row.

    The prefix at p holds ``ceil(rows * p / 100)`` rows; nine boundaries
    decide, so the scan needs no join.
    """
    percents = list(range(10, 100, 10))
    spots = locate(df, [F.ceil(F.col("total") * p / 100) for p in percents])
    label = F.lit(100)
    for percent, spot in reversed(list(zip(percents, spots))):
        label = F.when(_before(spot), percent).otherwise(label)
    return label


def with_decile(df: DataFrame) -> DataFrame:
    """Add ``percent`` as in ``decile_of`` to a file scan."""
    return with_location(df).withColumn("percent", decile_of(df)).drop(FILE, ROW)
