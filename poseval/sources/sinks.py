"""Parquet sinks with size control, and the output guard."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poseval.operators.quality import global_sort
from poseval.operators.runs import one_file_per_task, one_stretch_per_task
from poseval.schema import require_columns
from poseval.session import delete_folder, new_folder
from poseval.sources.readers import PARQUET_GLOB, has_files, list_files, read_table

# Default part size and compression.
TARGET_MB = 100
ZSTD_LEVEL = 3
SAMPLE_ROWS = 250_000
MIN_ROWS_PER_PART = 10_000
# Rows that one task sorts and one part holds at most: some 200 MB in memory, however well they compress.
MAX_ROWS_PER_PART = 1_000_000
MB = 1024 * 1024


def check_output(spark: SparkSession, src: str | None, dst: str, overwrite: bool, empty: bool = False) -> str:
    """Write mode for ``dst``; refuses the input folder and existing output.

    ``empty`` asks for a folder without any file, else only Parquet counts.
    """
    if src is not None and src.rstrip("/") == dst.rstrip("/"):
        raise ValueError("input and output must be different")
    if overwrite:
        return "overwrite"
    if has_files(spark, dst, "*" if empty else PARQUET_GLOB):
        raise FileExistsError(f"output already holds data: {dst}; pass overwrite=True")
    return "append"


def _check_sizes(target_mb: int, zstd_level: int) -> None:
    if target_mb <= 0:
        raise ValueError("target_mb must be > 0")
    if not 1 <= zstd_level <= 22:
        raise ValueError("zstd_level must be in 1..22")


def _writer(df: DataFrame, mode: str, zstd_level: int):
    return (
        df.write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", zstd_level)
    )


def folder_bytes(spark: SparkSession, folder: str) -> int:
    return list_files(spark, folder, PARQUET_GLOB).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()["b"]


def parts_for(size: int, target_mb: int = TARGET_MB, rows: int = 0) -> int:
    """Parts of about ``target_mb`` that ``size`` bytes fill, more where ``rows`` would exceed a part's."""
    return max(math.ceil(size / (target_mb * MB)), math.ceil(rows / MAX_ROWS_PER_PART), 1)


def rows_per_part(df: DataFrame, target_mb: int = TARGET_MB, zstd_level: int = ZSTD_LEVEL) -> int:
    """Rows that fill one part, from the size of a written sample of the table.

    One task reads the first partitions until it has 250,000 rows and writes
    them to the shared folder, so nothing is shuffled for the sample and the
    rest of the table is not touched. Meant for tables that come straight from
    a scan; stored tables are sized by their files.
    """
    _check_sizes(target_mb, zstd_level)
    spark = df.sparkSession
    folder = new_folder(spark, "part-size")
    try:
        _writer(df.coalesce(1).limit(SAMPLE_ROWS), "errorifexists", zstd_level).parquet(folder)
        rows = spark.read.schema(df.schema).parquet(folder).count()
        if rows == 0:
            return MIN_ROWS_PER_PART
        per_row = max(folder_bytes(spark, folder) / rows, 1.0)
    finally:
        delete_folder(spark, folder)
    return max(int(target_mb * MB / per_row), MIN_ROWS_PER_PART)


def write_parts(
    df: DataFrame,
    dst: str,
    target_mb: int = TARGET_MB,
    zstd_level: int = ZSTD_LEVEL,
    overwrite: bool = False,
    src: str | None = None,
    max_rows: int | None = None,
) -> None:
    """Write Parquet parts of about ``target_mb``, keeping partitions and order.

    A partition rolls over to a new file after ``max_rows`` rows (default: the
    estimate of ``rows_per_part``).
    """
    _check_sizes(target_mb, zstd_level)
    mode = check_output(df.sparkSession, src, dst, overwrite)
    limit = max_rows or rows_per_part(df, target_mb, zstd_level)
    _writer(df, mode, zstd_level).option("maxRecordsPerFile", limit).parquet(dst)


def write_sorted(
    df: DataFrame,
    dst: str,
    column: str,
    size: int,
    spread: list[str],
    drop: list[str] | None = None,
    target_mb: int = TARGET_MB,
    zstd_level: int = ZSTD_LEVEL,
    overwrite: bool = False,
    src: str | None = None,
    rows: int = 0,
) -> None:
    """Globally sorted parts: one range partition per part of the wanted size.

    ``size`` is the table's stored size in bytes and ``rows`` how many it has.
    Rows of equal ``column`` are ordered and divided by ``spread``; columns in
    ``drop`` only serve the order and are not written.
    """
    _check_sizes(target_mb, zstd_level)
    mode = check_output(df.sparkSession, src, dst, overwrite)
    require_columns(df, [column, *spread])
    keep = [c for c in df.columns if c not in (drop or [])]
    ordered = global_sort(df, column, parts_for(size, target_mb, rows), spread)
    _writer(ordered.select(keep), mode, zstd_level).parquet(dst)


def _write_by_key(df: DataFrame, key: str, dst: str, target_mb: int, zstd_level: int, mode: str) -> None:
    """Parts of about ``target_mb`` in ``key`` order.

    The rows are stored once, so they are computed once and their size is
    known; range sampling and the sort then read the stored table.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "by-key")
    try:
        _writer(df, "errorifexists", zstd_level).parquet(folder)
        stored = spark.read.schema(df.schema).parquet(folder)
        parts = parts_for(folder_bytes(spark, folder), target_mb, stored.count())
        _writer(stored.repartitionByRange(parts, key).sortWithinPartitions(key), mode, zstd_level).parquet(dst)
    finally:
        delete_folder(spark, folder)


def write_kv(
    kv: DataFrame,
    dst: str,
    target_mb: int = TARGET_MB,
    zstd_level: int = ZSTD_LEVEL,
    overwrite: bool = False,
    src: str | None = None,
) -> None:
    """Key/value table, sorted by key; keys are unique, so ranges stay even."""
    require_columns(kv, ["k", "v"])
    _check_sizes(target_mb, zstd_level)
    mode = check_output(kv.sparkSession, src, dst, overwrite, empty=True)
    _write_by_key(kv, "k", dst, target_mb, zstd_level, mode)


def write_latest_table(
    latest: DataFrame,
    dst: str,
    target_mb: int = TARGET_MB,
    zstd_level: int = ZSTD_LEVEL,
    overwrite: bool = False,
    src: str | None = None,
) -> None:
    """Table with one row per key, in key order so that lookups prune files.

    Its key is unique by construction: it comes from a grouping by key.
    """
    _check_sizes(target_mb, zstd_level)
    mode = check_output(latest.sparkSession, src, dst, overwrite, empty=True)
    _write_by_key(latest, "zobr64", dst, target_mb, zstd_level, mode)


def name_by_order(spark: SparkSession, folder: str, order: Column) -> None:
    """Rename the files of a folder so that their names rise with their smallest ``order``.

    For tables whose files hold disjoint ranges. Reads the columns of ``order``;
    the data stays where it is. A new name keeps the number the file was written
    with, so names never clash, and a second call, or one after a stop halfway,
    ends in the same order.
    """
    table = spark.read.parquet(folder)
    files = table.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min(order).alias("first")).orderBy("first")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, row in enumerate(files.toLocalIterator()):
        old = hadoop(unquote(row["path"]))  # scan metadata writes paths as URLs
        written, rest = re.fullmatch(r"part-(?:\d+-t)?(\d+)(.*)", old.getName()).groups()
        new = hadoop(old.getParent(), f"part-{i:05d}-t{written}{rest}")
        if new.getName() != old.getName() and not system.rename(old, new):
            raise OSError(f"could not rename {old}")


def write_runs(df: DataFrame, dst: str, order: Column, mode: str, zstd_level: int = ZSTD_LEVEL) -> None:
    """Write the result of ``operators.runs`` in ``order``: every task's rows are one range of keys."""
    with one_stretch_per_task(df.sparkSession):
        _writer(df.sortWithinPartitions(order), mode, zstd_level).parquet(dst)
    name_by_order(df.sparkSession, dst, order)


def write_per_file(
    spark: SparkSession,
    src: str,
    dst: str,
    make: Callable[[DataFrame], DataFrame],
    zstd_level: int = ZSTD_LEVEL,
    overwrite: bool = True,
) -> None:
    """One output file per input file, of the same name and row count.

    ``make`` turns the table into the one to write, row by row. Each task reads
    one whole file, so the number in an output file's name tells which one it
    came from; after Spark has committed the files they take over the names.
    Retried tasks leave nothing behind, as in any write. An input file without
    rows gets an output file without rows. A ``make`` that changes the number of
    rows of a file stops before anything is renamed.
    """
    mode = check_output(spark, src, dst, overwrite)
    path = F.col("_metadata.file_path")
    with one_file_per_task(spark):
        table = read_table(spark, src)
        tasks = {r["task"]: r["path"] for r in table.select(F.spark_partition_id().alias("task"), path.alias("path")).distinct().collect()}
        made = make(table)
        _writer(made, mode, zstd_level).parquet(dst)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(dst).getFileSystem(spark._jsc.hadoopConfiguration())
    name = lambda p: hadoop(p).getName()
    rows = lambda folder: {
        name(unquote(r["path"])): r["n"]  # scan metadata writes paths as URLs
        for r in read_table(spark, folder).groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    read, written = rows(src), rows(dst)
    source = {n: name(unquote(tasks[int(n.split("-")[1])])) for n in written}
    changed = [n for n, old in source.items() if written[n] != read.get(old)]
    if changed or len(set(source.values())) != len(source) or len(source) != len(read):
        raise ValueError(f"rows were added or dropped: {', '.join(sorted(source.get(n, n) for n in changed)) or dst}")
    for new, old in source.items():
        if not system.rename(hadoop(dst, new), hadoop(dst, old)):
            raise OSError(f"could not rename {new} to {old}")
    # Files without rows, and what Spark writes for a table without any.
    for r in list_files(spark, dst, PARQUET_GLOB).select("path").collect():
        if name(r["path"]) not in read:
            system.delete(hadoop(r["path"]), False)
    for r in list_files(spark, src, PARQUET_GLOB).select("path").collect():
        if name(r["path"]) not in read:
            folder = new_folder(spark, "empty")
            _writer(spark.createDataFrame([], made.schema).coalesce(1), "errorifexists", zstd_level).parquet(folder)
            one = list_files(spark, folder, PARQUET_GLOB).first()["path"]
            if not system.rename(hadoop(one), hadoop(dst, name(r["path"]))):
                raise OSError(f"could not write {name(r['path'])}")
            delete_folder(spark, folder)


def save_latest_table(latest: DataFrame, name: str, buckets: int, path: str | None = None, overwrite: bool = False) -> DataFrame:
    """The latest rows as a table of the session's catalog, in sorted buckets of the key.

    Joins and groupings by key between such tables of equal ``buckets`` need no
    shuffle. Keys are unique, so buckets are even. ``path`` makes it an external
    table.
    """
    require_columns(latest, ["zobr64"])
    if buckets < 1:
        raise ValueError("buckets must be positive")
    writer = latest.repartition(buckets, "zobr64").write.format("parquet").option("compression", "zstd")
    if path is not None:
        writer = writer.option("path", path)
    writer.mode("overwrite" if overwrite else "errorifexists").bucketBy(buckets, "zobr64").sortBy("zobr64").saveAsTable(name)
    return latest.sparkSession.table(name)
