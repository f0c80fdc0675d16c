"""Session settings the jobs are written for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Plain Spark settings; pass overrides for the cluster at hand.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "poseval", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a fresh temporary
    folder, remembered in the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = spark.conf.get("poseval.local.folder", None) or tempfile.mkdtemp(prefix="poseval-")
    spark.conf.set("poseval.local.folder", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A name in the shared folder that nothing has yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _store(df: DataFrame, folder: str, codec: str | None = None) -> DataFrame:
    df.write.parquet(folder, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a table in the shared folder; it survives executors.

    For results that are still to be read: the table stays there, and whoever
    owns the shared folder clears it.
    """
    return _store(df, new_folder(df.sparkSession, name))


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder by the file system it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``stage`` for tables that only the enclosed block reads; they go at its end. ``codec`` is Parquet's, the session's by default."""
    folders: list[str] = []

    def put(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        folders.append(new_folder(spark, name))
        return _store(df, folders[-1], codec)

    try:
        yield put
    finally:
        for folder in folders:
            delete_folder(spark, folder)
