"""Checks and counters over whole tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseval.functions import evals as E
from poseval.functions import position as P
from poseval.operators import ordinal as O
from poseval.operators.kv import with_encode_error
from poseval.operators.positions import with_board
from poseval.operators.ranges import range_partitioned
from poseval.schema import UNSIGNED, compute_once, holds_bits, key64_column, require_columns, unsigned_order
from poseval.session import stage


def assert_required(df: DataFrame, on_error: str = "fail") -> DataFrame:
    """Enforce the non-null fields of the nested layout.

    ``"fail"`` stops at the first bad row; ``"split"`` adds ``missing_field``.
    """
    require_columns(df, ["fen", "evals"])
    missing = E.has_missing_field(F.col("fen"), F.col("evals"))
    if on_error == "split":
        return df.withColumn("missing_field", missing)
    message = F.concat(F.lit("required field missing in row with fen "), F.coalesce(F.col("fen"), F.lit("NULL")))
    checked = F.when(missing, F.raise_error(message).cast("string")).otherwise(F.col("fen"))
    return df.withColumn("fen", checked)


def letter_distribution(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per ``bad_letter``, by letter; the row ``-, 0`` when there is none.

    ``weight`` names a column with the number of rows each row stands for. Only
    the counts, one per letter, come together in the last step.
    """
    counts = (
        rows.where(F.col("bad_letter").isNotNull())
        .groupBy(F.col("bad_letter").alias("letter"))
        .agg(F.sum(weight or F.lit(1)).alias("rows"))
    )
    table = counts.agg(F.sort_array(F.collect_list(F.struct("letter", "rows"))).alias("letters"))
    none = F.array(F.struct(F.lit("-").alias("letter"), F.lit(0).cast("bigint").alias("rows")))
    return table.select(F.inline(F.when(F.size("letters") == 0, none).otherwise(F.col("letters"))))


def castling_letter_distribution(df: DataFrame) -> DataFrame:
    """First invalid castling letters of the rows that fail to encode."""
    return letter_distribution(with_encode_error(df))


def castling_distribution_by_decile(df: DataFrame) -> DataFrame:
    """The same distribution over the first 10%, 20%, .. of a file scan."""
    return letter_snapshots(with_encode_error(O.with_decile(df)))


def letter_snapshots(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Running distributions from rows with ``percent`` and ``bad_letter``.

    The rows are aggregated to at most ten per letter first; the join that
    fills in percents without any works on that table only.
    """
    counts = (
        rows.where(F.col("bad_letter").isNotNull())
        .groupBy("percent", F.col("bad_letter").alias("letter"))
        .agg(F.sum(weight or F.lit(1)).alias("n"))
    )
    shown = counts.select(
        "letter", "n", F.explode(F.sequence(F.col("percent"), F.lit(100), F.lit(10))).alias("percent")
    )
    totals = shown.groupBy("percent", "letter").agg(F.sum("n").alias("rows"))
    every = rows.sparkSession.range(10, 101, 10).select(F.col("id").cast("int").alias("percent"))
    filled = every.join(totals, "percent", "left")
    return filled.select(
        "percent", F.coalesce("letter", F.lit("-")).alias("letter"), F.coalesce("rows", F.lit(0)).alias("rows")
    )


def bad_castling_scan(df: DataFrame) -> DataFrame:
    """Rows whose first failing check is castling; other failures are ignored.

    Compose with ``ordinal.head_percent`` to scan only the head of a table.
    """
    require_columns(df, ["fen"])
    letter = P.bad_castling_letter(F.col("fen_error"), F.col("castling"))
    fen_error = P.fen_error(*[F.col(c) for c in ("n_fields", "board_ok", "side", "castling", "ep")])
    checked = with_board(df).withColumn("fen_error", fen_error)
    return compute_once(checked, df.columns, letter, "bad_letter").where("bad_letter IS NOT NULL")


def _stretches(rows: DataFrame) -> DataFrame:
    """Falls inside each stretch of a scan, and each stretch's two ends.

    A stretch is what one task reads in a row from one file. Falls have
    ``before``; ends have the ``last`` value. Row order is the scan's, so no
    sort is needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_end = None  # file, first row, first value, last row, last value of the stretch so far

        def out(file, row, before, value, last) -> pa.RecordBatch:
            columns = [pa.array(file, pa.string()), *(pa.array(c, pa.int64()) for c in (row, before, value, last))]
            return pa.RecordBatch.from_arrays(columns, names=["file", "row", "before", "value", "last"])

        def end(e) -> pa.RecordBatch:
            return out([e[0]], [e[1]], [None], [e[2]], [e[4]])

        for b in batches:
            if b.num_rows == 0:
                continue
            file = b.column(0).dictionary_encode()
            code, row, value = file.indices.to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()
            # Rows may be filtered out before the check, so a stretch only has to rise.
            new = np.flatnonzero((code[1:] != code[:-1]) | (row[1:] <= row[:-1])) + 1
            falls = np.flatnonzero((value[1:] < value[:-1]) & (code[1:] == code[:-1]) & (row[1:] > row[:-1])) + 1
            if len(falls):
                none = np.full(len(falls), None)
                yield out(b.column(0).take(pa.array(falls)).to_pylist(), row[falls], value[falls - 1], value[falls], none)
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(row)]):
                name = b.column(0)[lo].as_py()
                if open_end and (open_end[0] != name or row[lo] <= open_end[3]):
                    yield end(open_end)
                    open_end = None
                if open_end is None:
                    open_end = [name, row[lo], value[lo], row[hi - 1], value[hi - 1]]
                else:
                    if value[lo] < open_end[4]:
                        yield out([name], [row[lo]], [open_end[4]], [value[lo]], [None])
                    open_end[3:] = row[hi - 1], value[hi - 1]
        if open_end:
            yield end(open_end)

    return rows.mapInArrow(run, "file string, row long, before long, value long, last long")


def sortedness_violations(df: DataFrame, key: str = "zobr64", file: str = O.FILE, row: str = O.ROW) -> DataFrame:
    """Rows whose key is below the key before them in (file, row) order.

    ``df`` is a file scan (filters and added columns are fine), so each task
    sees its rows in order and one vectorised pass compares neighbours; the
    data is not shuffled. Keys across splits and files are compared on a table
    of one row per split.
    """
    value = unsigned_order(key64_column(df, key))
    rows = df.select(
        F.col(file).alias("file"), F.col(row).cast("bigint").alias("row"), value.alias("value")
    ).where("value IS NOT NULL")
    found = stage(_stretches(rows), "sortedness")
    ends = found.where("last IS NOT NULL")
    across = ends.withColumn("before", F.lag("last").over(Window.orderBy("file", "row"))).where("value < before")
    falls = found.where("before IS NOT NULL").unionByName(across)
    plain = lambda c: unsigned_order(F.col(c))
    return falls.select("file", "row", plain("before").alias("previous_key64"), plain("value").alias("key64"))


def is_sorted_head(df: DataFrame, column: str, order: list[str], n: int = 20) -> DataFrame:
    """Whether the first ``n`` values in ``order`` ascend; works on n rows."""
    head = df.select(column, *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    by = [f"_o{i}" for i in range(len(order))]
    first = head.orderBy(*by).limit(n)
    lagged = first.withColumn("before", F.lag(column).over(Window.orderBy(*by)))
    return lagged.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(F.col("before") > F.col(column)) == 0).alias("is_sorted"),
    )


def global_sort(df: DataFrame, column: str, partitions: int, spread: list[str] | None = None) -> DataFrame:
    """Sort the whole table by ``column``, ascending, nulls first.

    A range exchange and a sort inside each partition. ``spread`` extends the
    range key so that a value held by a large share of the rows is divided
    among several partitions; rows of equal ``column`` have no set order. The
    default spread is a hash of the row; give a row index for tables with many
    whole-row copies.

    A position key with a whole-number ``spread`` is cut into equal widths (see
    ``ranges``), about ``partitions`` of them, and no sample of the table is
    read. Other columns, and keys that turn out uneven, are cut by Spark's.
    """
    require_columns(df, [column])
    if partitions < 1:
        raise ValueError("partitions must be positive")
    kind = df.schema[column].dataType
    if spread and (kind == UNSIGNED or holds_bits(df, column)) and isinstance(df.schema[spread[0]].dataType, T.IntegralType):
        order = unsigned_order(key64_column(df, column))
        ranges = range_partitioned(df, order, partitions, F.col(spread[0]))
        if ranges is not None:
            by_key = [F.col("_order").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in spread]]
            return ranges.sortWithinPartitions(*by_key).drop("_order")
    by: list[Column] = [F.col(column).asc_nulls_first()]
    if spread:
        by += [F.col(c).asc_nulls_first() for c in spread]
        return df.repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    hashed = df.withColumn("_spread", F.xxhash64(*df.columns))
    by.append(F.col("_spread").asc())
    return hashed.repartitionByRange(partitions, *by).sortWithinPartitions(*by).drop("_spread")


def job_metrics(df: DataFrame) -> DataFrame:
    """Counters of the reduce step over its input, in one pass."""
    usable = lambda best: F.coalesce(best["usable"], F.lit(False))
    rows = df.select(
        usable(E.best_eval_first(F.col("evals"))).alias("first"), usable(E.best_eval_last(F.col("evals"))).alias("last")
    )
    return rows.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~F.col("first")).alias("skipped_without_eval"),
        F.count_if(F.col("first")).alias("rows_with_eval"),
        F.count_if(~F.col("last")).alias("missing_eval_last"),
    )


def load_metrics(df: DataFrame) -> DataFrame:
    """Counters of the key/value load: rows read, skipped and keys written.

    Counted per key first, so no list of distinct keys meets in one task.
    """
    rows = with_encode_error(df.withColumn("_key64", key64_column(df)))
    per_key = rows.groupBy("_key64").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("encode_error").isNotNull()).alias("bad")
    )
    return per_key.agg(
        F.sum("n").alias("input_rows"),
        F.sum("bad").alias("skipped_rows"),
        F.count_if(F.col("n") > F.col("bad")).alias("written_keys"),
    )
