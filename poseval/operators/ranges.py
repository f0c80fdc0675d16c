"""Range partitions by a key whose bits are spread evenly.

Position keys are XORs of random constants, so equal widths of the key space
hold equal numbers of rows and no sample of the table is needed to cut it. What
is not even is a key with many rows. One pass over the key column alone counts
coarse buckets; only those that stand out are looked at again, key by key. A hot
key gets parts of its own, divided along the columns that order its rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the counting pass, a power of two.
BUCKET_BITS = 12
#: A bucket stands out above so many times the mean, or three of its deviations more.
STANDS_OUT = 2.0
#: A key is hot from this share of a part; more hot keys than this are no exception.
HOT_SHARE, MAX_HOT = 0.25, 200


class Hot(NamedTuple):
    """A key with many rows: ``order`` (None for null), its rows and the range of ``spread`` in them."""

    order: int | None
    rows: int
    low: int
    high: int


class Parts(NamedTuple):
    """Number of parts, the part of each row as an expression, and the hot keys."""

    count: int
    part: Column
    hot: list[Hot]


def _within(hot: Hot, pieces: int, spread: Column) -> Column:
    """Piece of a hot key's rows, by equal widths of ``spread``."""
    width = (hot.high - hot.low) // pieces + 1
    return F.floor((spread.cast("bigint") - hot.low) / width).cast("int")


def uniform_parts(df: DataFrame, order: Column, parts: int, spread: Column) -> Parts | None:
    """Cut ``df`` into about ``parts`` ranges of ``order``; None where its values are not spread evenly.

    ``order`` is a BIGINT that rises with the key and fills its 64 bits evenly;
    nulls come first and are one more key. ``spread``, a whole number, orders
    and divides the rows of a hot key. Neighbouring parts never overlap in
    ``(order, spread)``. At most 4,096 counts and 200 hot keys reach the driver.
    """
    keys = df.select(order.alias("order"), spread.cast("bigint").alias("spread"))
    # Flip the sign bit, so that the top bits rise with the order.
    bucket = F.shiftrightunsigned(F.col("order").bitwiseXOR(F.lit(-(2**63))), 64 - BUCKET_BITS)
    counts = keys.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    nulls = sum(r["n"] for r in counts if r["bucket"] is None)
    n = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in counts:
        if r["bucket"] is not None:
            n[r["bucket"]] = r["n"]
    target = max(math.ceil((nulls + n.sum()) / parts), 1)
    least = max(int(HOT_SHARE * target), 1)

    def outstanding(of: np.ndarray) -> np.ndarray:
        # The median is what even buckets hold, whatever the hot ones do.
        usual = float(np.median(of))
        return np.flatnonzero((of > STANDS_OUT * usual + 3 * math.sqrt(usual) + 8))

    hot: list[Hot] = []
    suspects = [int(b) for b in outstanding(n) if n[b] > least]
    if len(suspects) > MAX_HOT:
        return None
    if suspects or nulls > least:
        inside = keys.where(bucket.isin(suspects) | (F.col("order").isNull() if nulls > least else F.lit(False)))
        found = inside.groupBy("order").agg(F.count(F.lit(1)).alias("n"), F.min("spread").alias("low"), F.max("spread").alias("high"))
        found = found.where(F.col("n") > least).limit(MAX_HOT + 1).collect()
        if len(found) > MAX_HOT:
            return None
        hot = sorted((Hot(*r) for r in found), key=lambda h: (h.order is not None, h.order or 0))
    for h in hot:
        if h.order is not None:
            n[(h.order + 2**63) >> (64 - BUCKET_BITS)] -= h.rows
    rest = int(n.sum())
    if len(outstanding(n)) > 0.01 * len(n) or n.max() > target + least:
        return None
    width = max(round(rest / target), 1)
    # Numbers of equal ranges: the top 32 bits, scaled. Each hot key adds its pieces and one more range after it.
    top = F.shiftrightunsigned(F.col("_order").bitwiseXOR(F.lit(-(2**63))), 32)
    even = F.coalesce(F.floor(top * width / 2**32).cast("int"), F.lit(0))
    part, added = even, 0
    for h in hot:
        pieces = max(math.ceil(h.rows / target), 1)
        if h.order is None:
            here = F.when(F.col("_order").isNull(), _within(h, pieces, F.col("_spread")))
            part, added = here.otherwise(even + pieces), pieces
            continue
        base = (((h.order + 2**63) >> 32) * width >> 32) + added + 1
        part = F.when(F.col("_order") == h.order, _within(h, pieces, F.col("_spread")) + base).when(
            F.col("_order") > h.order, even + added + pieces + 1
        ).otherwise(part)
        added += pieces + 1
    return Parts(width + added, part, hot)


def range_partitioned(df: DataFrame, order: Column, parts: int, spread: Column) -> DataFrame | None:
    """``df`` in the partitions of ``uniform_parts``, with ``_order``; None where it has none."""
    cut = uniform_parts(df, order, parts, spread)
    if cut is None:
        return None
    placed = df.withColumns({"_order": order, "_spread": spread.cast("bigint")})
    return placed.repartitionById(cut.count, cut.part).drop("_spread")
