"""One deepest evaluation per distinct position, and per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poseval.functions import evals as E
from poseval.functions import position as P
from poseval.schema import BITS, compute_once, key64_column, key_bytes, require_columns, to_unsigned


def best_eval(df: DataFrame, policy: str = "first") -> DataFrame:
    """Replace ``evals`` by its best entry; rows without a usable one are dropped."""
    require_columns(df, ["fen", "evals"])
    choose = {"first": E.best_eval_first, "last": E.best_eval_last}[policy]
    rest = [c for c in df.columns if c != "evals"]
    chosen = compute_once(df, rest, choose(F.col("evals")), "_best").where("_best.usable")
    moves = [P.first_token(F.col("_best.line")).alias("first_move")] if policy == "first" else []
    return chosen.select(*rest, "_best.eval", "_best.mate", "_best.depth", *moves)


def _best_row(values: list[str], depth: str, order: list[str]) -> Column:
    """Deepest row; equal depths go to the first in ``order``, then to the smallest values.

    The order is total, so the answer does not depend on how rows are split.
    ``min_by`` merges partial results, so each map task sends one row per
    group however many rows a hot key has.
    """
    rank = F.struct((-F.col(depth).cast("bigint")).alias("rank"), *order, *sorted(values))
    return F.min_by(F.struct(*values), rank).alias("_row")


def simplify_positions(df: DataFrame, order: list[str] | None = None, count: str | None = None) -> DataFrame:
    """Per key, keep the deepest row of positions that differ only in castling.

    ``order`` names the columns of arrival order that break ties in depth;
    without them the smaller ``fen`` wins. ``count`` names a column for the
    number of rows with an evaluation that went into the kept one.
    """
    require_columns(df, ["zobr64", "fen", "evals"])
    order = order or ["fen"]
    rows = best_eval(
        df.select(
            key64_column(df).alias("key64"), "fen", "evals", *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]
        )
    )
    parts = rows.withColumn("_parts", P.tokens(F.col("fen")))
    keyed = parts.withColumn("dedupe_key", P.dedupe_key(F.col("fen"), F.col("_parts"))).drop("_parts")
    kept = keyed.groupBy("key64", "dedupe_key").agg(
        _best_row(["eval", "mate", "depth", "fen", "first_move"], "depth", [f"_o{i}" for i in range(len(order))]),
        F.count(F.lit(1)).alias("_n"),
    )
    return kept.select(
        to_unsigned(F.col("key64")).alias("zobr64"),
        "_row.eval",
        "_row.mate",
        "_row.depth",
        "_row.fen",
        "_row.first_move",
        *([F.col("_n").alias(count)] if count else []),
    )


def latest_per_key(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Per key, the last row in ``order`` (default ``fen``), plus copies dropped.

    The key comes out as the BIGINT with the same bits, marked as such in the
    column's metadata. Rows equal in ``order`` are told apart by their values.
    """
    values = ["eval", "mate", "depth", "fen", "first_move"]
    require_columns(df, ["zobr64", *values])
    last = F.max_by(F.struct(*values), F.struct(*(order or ["fen"]), *sorted(values))).alias("_row")
    return (
        df.groupBy(key64_column(df).alias("_key64"))
        .agg(last, (F.count(F.lit(1)) - 1).alias("skipped"))
        .select(F.col("_key64").alias("zobr64", metadata=BITS), "_row.*", "skipped")
    )


def scored_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """``key64, fen, eval, mate, depth`` and ``order`` of every row; depth is null without an evaluation.

    The best entry of a row is its last deepest one.
    """
    require_columns(df, ["zobr64", "fen", "evals", *order])
    keyed = df.select(key64_column(df).alias("key64"), "fen", "evals", *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    kept = ["key64", "fen", *[f"_o{i}" for i in range(len(order))]]
    rows = compute_once(keyed, kept, E.best_eval_last(F.col("evals")), "_best")
    known = lambda c: F.when(F.col("_best.usable"), F.col(f"_best.{c}")).alias(c)
    return rows.select(*kept, known("eval"), known("mate"), known("depth"))


def deepest_of(scored: DataFrame) -> DataFrame:
    """``k, v`` per key of ``scored_rows``: the deepest row as a JSON value."""
    order = [c for c in scored.columns if c.startswith("_o")]
    values = ["eval", "mate", "depth", "fen"]
    kept = scored.where("depth IS NOT NULL").groupBy("key64").agg(_best_row(values, "depth", order))
    value = F.to_json(F.col("_row"), {"ignoreNullFields": "false"})
    return kept.select(key_bytes(F.col("key64")).alias("k"), value.alias("v"))


def deepest_per_key(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Per key over all its positions, the deepest row as a JSON value.

    Among rows of equal depth the first in ``order`` stays (default: the
    smaller ``fen``). ``k`` is the key as 8 big-endian bytes.
    """
    return deepest_of(scored_rows(df, order or ["fen"]))


def longest_depth_per_fen(df: DataFrame, n: int | None = None) -> DataFrame:
    """Greatest depth per position text, deepest first; ``n`` keeps the top."""
    require_columns(df, ["fen", "evals"])
    found = (
        df.select("fen", E.row_longest_depth(F.col("evals")).alias("row_longest_depth"))
        .groupBy("fen")
        .agg(F.max("row_longest_depth").alias("longest_depth"))
        .orderBy(F.desc_nulls_last("longest_depth"), "fen")
    )
    return found if n is None else found.limit(n)


def upsert_metrics(df: DataFrame, ord: str | list[str]) -> DataFrame:
    """Counters of a row-by-row "store if deeper" load in ``ord`` order."""
    return upsert_counts(scored_rows(df, [ord] if isinstance(ord, str) else ord))


def upsert_counts(scored: DataFrame) -> DataFrame:
    """The same from ``scored_rows``.

    A row is stored when it is deeper than every earlier row of its key. Only
    the first row of each depth can be, and it is when no greater depth came
    earlier. So rows reduce to one per (key, depth) before any ordering.
    """
    order = F.struct(*[c for c in scored.columns if c.startswith("_o")])
    first_seen = scored.groupBy("key64", "depth").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    deeper = Window.partitionBy("key64").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("depth").isNotNull()
    marked = first_seen.withColumn("deeper_first", F.min(F.when(known, F.col("first"))).over(deeper))
    stored = known & (F.col("deeper_first").isNull() | (F.col("first") < F.col("deeper_first")))
    with_eval = F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0))
    return marked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
        with_eval.alias("rows_with_eval"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("rows_missing_eval"),
        F.count_if(stored).alias("updated_keys"),
        (with_eval - F.count_if(stored)).alias("kept_existing_keys"),
    )
