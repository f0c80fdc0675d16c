"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poseval.schema import require_columns
from poseval.session import stage

#: The characters that separate words: space, and \t \n \v \f \r.
SPACES = r"[\x20\x09-\x0D]"


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, text`` and the columns named in ``more``; a null text is empty."""
    require_columns(docs, ["doc_id", "text", *more])
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_of_id(column: str = "doc_id") -> Column:
    """CRC-32 of the id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of finished steps.

    Spark's cleaner removes them when the driver's garbage collector finds
    their owners unreachable; a driver with a quiet heap may not get there for
    half an hour while executors' disks fill. The first round lets go of what
    Python held, the second finds it gone.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def staged(df: DataFrame, name: str, heavy: bool = False) -> DataFrame:
    """Written to the shared folder and read back; ``heavy`` drops the shuffles that led to it."""
    out = stage(df, name)
    if heavy:
        release(df.sparkSession)
    return out


def tasks_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Shuffle partitions for ``rows``: the session's number, or more so that none exceeds ``per_task``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task), 1)
