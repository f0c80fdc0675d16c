"""Connected components of a table of links, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poseval.llm.common import staged


def _mark(links: DataFrame) -> tuple:
    """Number and order-free digest of links, to see whether a round changed any."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every linked node; the smallest node names a component.

    Alternating stars: each node hands the smallest neighbour it knows first to
    its larger neighbours, then to its smaller ones, until links no longer
    change; every component is then a star around its smallest node. The rounds
    grow with the logarithm of the longest path. Minima merge in each task
    before the shuffle; a node with very many links is a skewed join, which
    Spark divides. Links to oneself or to null are ignored; no links, no rows.
    """
    found = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    found = staged(found.distinct(), "links")
    seen = None
    while seen != (mark := _mark(found)):
        seen = mark
        both = found.union(found.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "links-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        found = staged(small.where("u != v").distinct(), "links-small")
    alone = found.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).union(alone)
