"""Files of the same name, and the catalog table in buckets."""

import pathlib

import pytest
from pyspark.sql import functions as F

from checks import tables as T
from poseval.plans import jobs as J
from poseval.sources import readers as R
from poseval.sources import sinks as S

FENS = [f for i, f in enumerate(T.CORPUS) if i < 33]


def parts(folder):
    return sorted(p.name for p in pathlib.Path(folder).glob("[!.]*.[pP]*"))


def test_files_keep_names_and_rows(spark, tmp_path):
    """Files of any size, an empty one and one with a name in capitals, each whole in one task."""
    src = tmp_path / "src"
    src.mkdir()
    for i, n in enumerate([1, 40, 0, 7, 900]):
        rows = spark.createDataFrame([(i, j, FENS[j % 33]) for j in range(n)], "file int, row int, fen string")
        rows.coalesce(1).write.parquet(str(tmp_path / f"one-{i}"))
        (file,) = (tmp_path / f"one-{i}").glob("*.parquet")
        file.rename(src / (f"Data {i}.PARQUET" if i == 3 else f"z-{9 - i}.parquet"))
    dst = str(tmp_path / "dst")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        counts = J.add_position_key(spark, str(src), dst, keep_files=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert counts == {"output_rows": 948} and parts(dst) == parts(src)
    rows = lambda p: [(r.file, r.row, r.fen) for r in spark.read.parquet(str(p)).collect()]
    for name in parts(src):
        assert rows(f"{dst}/{name}") == rows(src / name)
    assert spark.read.parquet(dst).where("zobr64 IS NULL").isEmpty()
    # A second run replaces them.
    J.add_position_key(spark, str(src), dst, keep_files=True)
    assert parts(dst) == parts(src)


def test_dropped_rows_stop_the_rename(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "src"))
    with pytest.raises(ValueError, match="added or dropped"):
        S.write_per_file(spark, str(tmp_path / "src"), str(tmp_path / "dst"), lambda t: t.where("id <> 5"))


def test_catalog_table_needs_no_exchange(spark, tmp_path):
    rows = spark.range(5000).select(F.xxhash64("id").alias("zobr64"), F.col("id").cast("int").alias("depth"))
    saved = S.save_latest_table(rows, "latest_rows", 6, str(tmp_path / "latest"))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = spark.table("latest_rows").select("zobr64", F.col("depth").alias("again"))
        joined = saved.join(other, "zobr64")
        grouped = saved.groupBy("zobr64").agg(F.max("depth").alias("depth"))
        plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
        assert joined.where("depth = again").count() == 5000 == grouped.count()
        assert "Exchange" not in plan(joined) and "Exchange" not in plan(grouped)
        with pytest.raises(Exception, match="already exists"):
            S.save_latest_table(rows, "latest_rows", 6, str(tmp_path / "latest"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        spark.sql("DROP TABLE latest_rows")
    assert len(parts(tmp_path / "latest")) == 6
