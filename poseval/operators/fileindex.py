"""Key ranges of a table's files: batch look-ups and updates that open few of them.

The index is a small table in a hidden folder beside the data: one row per file
with its key range. It is read to the driver, some 100 bytes a file, as Spark's
own file listing is.
"""

from __future__ import annotations

from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poseval.schema import key64_column, require_columns, unsigned_order
from poseval.session import delete_folder

INDEX = "_ranges"
# Keys up to which a look-up sends them to every task, 8 bytes each.
MAX_BROADCAST_KEYS = 1_000_000


def key_order(df: DataFrame, key: str) -> Column:
    """A BIGINT that rises with the key: of ``k``, 8 big-endian bytes, or of an unsigned key column."""
    if df.schema[key].dataType.simpleString() == "binary":
        # Two halves, since 16 hex digits may exceed a BIGINT.
        half = lambda start: F.conv(F.hex(F.substring(key, start, 4)), 16, 10).cast("bigint")
        return F.shiftleft(half(1).bitwiseXOR(F.lit(2**31)), 32).bitwiseOR(half(5))
    return unsigned_order(key64_column(df, key))


def build_index(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Store and return ``path, low, high, rows`` of every file; reads the key column only."""
    table = spark.read.parquet(folder)
    require_columns(table, [key])
    keyed = table.select(F.col("_metadata.file_path").alias("path"), key_order(table, key).alias("order"))
    ranges = keyed.groupBy("path").agg(F.min("order").alias("low"), F.max("order").alias("high"), F.count(F.lit(1)).alias("rows"))
    ranges.write.mode("overwrite").parquet(f"{folder}/{INDEX}")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{INDEX}")


class Files:
    """The index on the driver, files by their smallest key."""

    def __init__(self, index: DataFrame):
        rows = sorted(index.select("low", "high", "path").collect())
        self.low = np.array([r["low"] for r in rows], np.int64)
        self.high = np.array([r["high"] for r in rows], np.int64)
        self.path = [unquote(r["path"]) for r in rows]  # scan metadata writes paths as URLs

    def disjoint(self) -> bool:
        return bool((self.high[:-1] < self.low[1:]).all())

    def number(self, order: Column, among: list[int] | None = None) -> Column:
        """The only file that may hold a key: the last one that begins at or before it, else the first.

        ``among``, rising numbers of files, counts in that list; the key's file must be in it.
        """
        low = self.low if among is None else self.low[among]

        @F.arrow_udf("int")
        def find(order: pa.Array) -> pa.Array:
            at = np.searchsorted(low, order.to_numpy(zero_copy_only=False), "right") - 1
            return pa.array(np.maximum(at, 0).astype(np.int32))

        return find(order)


def lookup_keys(spark: SparkSession, folder: str, keys: DataFrame, key: str = "k", index: DataFrame | None = None) -> DataFrame:
    """Rows of the table whose key is among ``keys``; only files that may hold one are opened.

    ``keys`` has the column ``key`` in the table's type, or any accepted key type.
    Copies and keys that the table lacks are fine; null keys find nothing.
    """
    files = Files(index if index is not None else read_index(spark, folder))
    table = spark.read.parquet(folder)
    wanted = keys.where(F.col(key).isNotNull()).select(key_order(keys, key).alias("_order")).distinct()
    count = wanted.count()
    if not files.path or not count:
        return table.where("false")
    if files.disjoint():
        numbers = [r[0] for r in wanted.select(files.number(F.col("_order")).alias("f")).distinct().collect()]
        bounds = wanted.select(F.min("_order"), F.max("_order")).first()
        paths = [files.path[i] for i in numbers if files.high[i] >= bounds[0] and files.low[i] <= bounds[1]]
    else:
        paths = files.path
    if not paths:
        return table.where("false")
    found = spark.read.schema(table.schema).parquet(*paths)
    found = found.withColumn("_order", key_order(found, key))
    small = F.broadcast(wanted) if count <= MAX_BROADCAST_KEYS else wanted
    return found.join(small, "_order", "left_semi").drop("_order")


def replace_files(spark: SparkSession, folder: str, made: str, numbers: list[int], files: Files, key: str) -> None:
    """Put the files of ``made`` in the places of ``files`` by ``numbers``, and renew the index.

    New files come first, then the old ones go, so that a stop in between
    leaves rows twice but never loses one; calling the update again mends it.
    A new file takes over the old one's number in the order of names.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    rows = spark.read.parquet(made)
    lows = rows.select(F.col("_metadata.file_path").alias("path"), key_order(rows, key).alias("order"))
    for row in lows.groupBy("path").agg(F.min("order").alias("low")).toLocalIterator():
        at = max(int(np.searchsorted(files.low, row["low"], "right")) - 1, 0)
        place = hadoop(files.path[at]).getName().split("-")[1] if files.path else "00000"
        old = unquote(row["path"])
        new = hadoop(folder, f"part-{place}-u{hadoop(old).getName().removeprefix('part-')}")
        if not system.rename(hadoop(old), new):
            raise OSError(f"could not put {new} in place")
    for i in numbers:
        system.delete(hadoop(files.path[i]), False)
    delete_folder(spark, made)
    build_index(spark, folder, key)
