"""Equal-width ranges of the key: even parts, hot keys in several, order across parts."""

import pytest
from pyspark.sql import functions as F

from poseval.operators.quality import global_sort
from poseval.operators.ranges import uniform_parts
from poseval.schema import key64_column, to_unsigned, unsigned_order

ROWS = 60_000


def table(spark, key):
    """``zobr64, ord`` with keys by an expression of the row number ``id``."""
    rows = spark.range(ROWS).select(F.expr(key).alias("key"), F.col("id").alias("ord")).repartition(6)
    return rows.select(to_unsigned(F.col("key")).alias("zobr64"), "ord")


def sizes(df):
    """Rows per partition, and whether keys and places rise along the partitions."""
    rows = df.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"), "zobr64", "ord").collect()
    rows.sort(key=lambda r: r.m)
    keys = [(-1 if r.zobr64 is None else int(r.zobr64), r.ord) for r in rows]
    count = {}
    for r in rows:
        count[r.p] = count.get(r.p, 0) + 1
    return count, keys == sorted(keys) and len(rows) == ROWS


def uses_sampling(df):
    return "rangepartitioning" in df._jdf.queryExecution().executedPlan().toString()


def test_even_parts(spark):
    df = global_sort(table(spark, "xxhash64(id)"), "zobr64", 20, ["ord"])
    count, rising = sizes(df)
    assert rising and not uses_sampling(df)
    assert len(count) == 20 and max(count.values()) < 1.3 * ROWS / 20 and min(count.values()) > 0.7 * ROWS / 20


@pytest.mark.parametrize("hot", ["CAST(-5 AS BIGINT)", "CAST(9 AS BIGINT)", "-9223372036854775808", "9223372036854775807", "NULL"])
def test_hot_key_is_divided(spark, hot):
    """A third of all rows has one key; two more keys hold a twentieth each."""
    key = f"CASE WHEN id % 3 = 0 THEN {hot} WHEN id % 20 = 1 THEN 77L WHEN id % 20 = 2 THEN -77L ELSE xxhash64(id) END"
    df = global_sort(table(spark, key), "zobr64", 20, ["ord"])
    count, rising = sizes(df)
    assert rising and not uses_sampling(df)
    assert max(count.values()) < 1.3 * ROWS / 20 and len(count) < 33


@pytest.mark.parametrize("key", ["id", "id % 7", "CAST(1 AS BIGINT)", "xxhash64(id % 40)"])
def test_other_keys_sort_right(spark, key):
    """Keys that are not spread evenly are hot ones, or are cut by a sample."""
    _, rising = sizes(global_sort(table(spark, key), "zobr64", 9, ["ord"]))
    assert rising


def test_counting_reads_the_key_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, "xxhash64(id)").withColumn("text", F.lit("long")).write.parquet(path)
    stored = spark.read.parquet(path)
    parts = uniform_parts(stored, unsigned_order(key64_column(stored)), 8, F.col("ord"))
    assert parts.count == 8 and parts.hot == []
    assert global_sort(stored.where("false"), "zobr64", 4, ["ord"]).count() == 0
