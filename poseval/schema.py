"""Fixed schemas and the unsigned-key boundary.

The position key is an unsigned 64-bit number. Parquet ``UINT64`` reaches Spark
as ``DECIMAL(20,0)``; operators group and join on ``key64``, a ``BIGINT`` with
the same 64 bits, because a long stays in fixed-width row slots and a
20-digit decimal does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nested input layout, one JSON object per position.
PV_TYPE = T.StructType(
    [
        T.StructField("cp", T.LongType()),
        T.StructField("mate", T.LongType()),
        T.StructField("line", T.StringType()),
    ]
)
EVAL_TYPE = T.StructType(
    [
        T.StructField("knodes", T.LongType()),
        T.StructField("depth", T.LongType()),
        T.StructField("pvs", T.ArrayType(PV_TYPE)),
    ]
)
EVAL_SCHEMA = T.StructType(
    [T.StructField("fen", T.StringType()), T.StructField("evals", T.ArrayType(EVAL_TYPE))]
)

# The part of EVAL_SCHEMA that the deepest-per-key build needs.
SCORE_SCHEMA = T.StructType(
    [
        T.StructField("fen", T.StringType()),
        T.StructField(
            "evals",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("depth", T.IntegerType()),
                        T.StructField(
                            "pvs",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("cp", T.IntegerType()),
                                        T.StructField("mate", T.IntegerType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)

SIMPLIFIED_COLUMNS = ["zobr64", "eval", "mate", "depth", "fen", "first_move"]

UNSIGNED = T.DecimalType(20, 0)


def _two_64() -> Column:
    return F.lit("18446744073709551616").cast(UNSIGNED)


def to_key64(unsigned: Column) -> Column:
    """Unsigned DECIMAL(20,0) to the BIGINT holding the same 64 bits."""
    wraps = unsigned > F.lit(2**63 - 1)
    return F.when(wraps, (unsigned - _two_64()).cast("bigint")).otherwise(unsigned.cast("bigint"))


def to_unsigned(key64: Column) -> Column:
    """BIGINT bit pattern to its unsigned DECIMAL(20,0) value."""
    value = key64.cast(UNSIGNED)
    return F.when(key64 < 0, (value + _two_64()).cast(UNSIGNED)).otherwise(value)


def unsigned_order(key64: Column) -> Column:
    """A BIGINT whose signed order is the unsigned order of ``key64``."""
    return key64.bitwiseXOR(F.lit(-(2**63)))


def key_bytes(key64: Column) -> Column:
    """Eight big-endian bytes; byte order equals unsigned order."""
    return F.unhex(F.lpad(F.hex(key64), 16, "0"))


# Column metadata of a BIGINT key that holds the bits of the unsigned number.
# Parquet files written by Spark keep it.
BITS = {"key": "bits"}


def holds_bits(df: DataFrame, name: str = "zobr64") -> bool:
    """Whether a key column holds bit patterns, as the latest table's does."""
    field = df.schema[name]
    return isinstance(field.dataType, T.LongType) and field.metadata.get("key") == BITS["key"]


def key64_column(df: DataFrame, name: str = "zobr64") -> Column:
    """``key64`` from any accepted key type.

    A BIGINT key column holds plain non-negative numbers unless its metadata
    says that it holds bits; a negative plain number is an error, as is a
    decimal below 0 or from 2^64 on. Decimals with a scale are refused.
    """
    dtype = df.schema[name].dataType
    key = F.col(name)
    message = F.concat(F.lit("key does not fit an unsigned 64-bit number: "), key.cast("string"))
    if isinstance(dtype, T.DecimalType) and dtype.scale == 0:
        wrong = (key < 0) | (key > F.lit("18446744073709551615").cast(UNSIGNED))
        return F.when(wrong, F.raise_error(message).cast("bigint")).otherwise(to_key64(key.cast(UNSIGNED)))
    if holds_bits(df, name):
        return key
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.when(key < 0, F.raise_error(message)).otherwise(key.cast("bigint"))
    raise TypeError(f"column {name} must be an unsigned or non-negative 64-bit key, got {dtype}")


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"input is missing required columns: {', '.join(missing)}")


def read_simplified(df: DataFrame) -> DataFrame:
    """Accept any table with simplified columns and return the exact schema.

    Integers narrow to INT with an overflow check (ANSI cast); the move column
    may be ``move`` or ``first_move`` or absent. Other columns are kept.
    """
    require_columns(df, ["zobr64", "eval", "mate", "depth", "fen"])
    move = next((c for c in ("move", "first_move") if c in df.columns), None)
    core = [
        to_unsigned(key64_column(df)).alias("zobr64"),
        F.col("eval").cast("int").alias("eval"),
        F.col("mate").cast("int").alias("mate"),
        F.col("depth").cast("int").alias("depth"),
        F.col("fen").cast("string").alias("fen"),
        (F.col(move) if move else F.lit(None)).cast("string").alias("first_move"),
    ]
    rest = [F.col(c) for c in df.columns if c not in SIMPLIFIED_COLUMNS + ["move"]]
    return df.select(*core, *rest)


def compute_once(df: DataFrame, columns: list[str | Column], value: Column, name: str) -> DataFrame:
    """Select ``columns`` and a costly ``value`` that later filters test.

    A filter over a projection moves below it and takes a copy of the tested
    expression along, which would then be evaluated twice per row. A generator
    of one element keeps the filter above.
    """
    return df.select(*columns, F.explode(F.array(value)).alias(name))
