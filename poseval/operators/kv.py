"""Compact key/value tables: encode, group per key, decode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poseval.functions import codec as C
from poseval.functions import position as P
from poseval.operators.positions import with_board
from poseval.schema import compute_once, key64_column, key_bytes, require_columns, to_unsigned


def _checked(df: DataFrame) -> DataFrame:
    """Add the parsed position and ``encode_error``."""
    require_columns(df, ["eval", "mate", "fen", "first_move"])
    fen_error = P.fen_error(*[F.col(c) for c in ("n_fields", "board_ok", "side", "castling", "ep")])
    error = (
        F.when(F.col("eval").isNull() & F.col("mate").isNull(), "score")
        .when(C.move_error(F.col("first_move")), "move")
        .otherwise(fen_error)
    )
    return with_board(df).withColumn("encode_error", error)


def with_encode_error(df: DataFrame) -> DataFrame:
    """Add ``encode_error`` (first failing check, or NULL) and ``bad_letter``.

    Checks run in a fixed order: score, move, fields, board, side, castling,
    ep; an earlier failure hides a later one.
    """
    letter = P.bad_castling_letter(F.col("encode_error"), F.col("castling"))
    found = F.struct("encode_error", letter.alias("bad_letter"))
    return compute_once(_checked(df), df.columns, found, "_found").select(*df.columns, "_found.*")


def _entry() -> Column:
    return C.encode_entry(
        C.score_of(F.col("eval"), F.col("mate")),
        F.col("depth"),
        C.pack_move(F.col("first_move"), C.score_kind(F.col("mate"))),
        C.board34_hex(*[F.col(c) for c in ("expanded", "side", "castling", "ep")]),
    )


def with_entry(df: DataFrame) -> DataFrame:
    """Add the 39-byte ``entry``; rows that cannot be encoded are left out."""
    require_columns(df, ["depth"])
    valid = F.when(F.col("encode_error").isNull(), _entry())
    return compute_once(_checked(df), df.columns, valid, "entry").where("entry IS NOT NULL")


def encoded_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """``key64, entry, encode_error, bad_letter`` and ``order`` of every row, failures included."""
    require_columns(df, ["depth", *order])
    letter = P.bad_castling_letter(F.col("encode_error"), F.col("castling"))
    entry = F.when(F.col("encode_error").isNull(), _entry())
    found = F.struct(entry.alias("entry"), "encode_error", letter.alias("bad_letter"))
    keyed = df.withColumn("key64", key64_column(df))
    return compute_once(_checked(keyed), ["key64", *order], found, "_found").select("key64", *order, "_found.*")


def kv_all_entries(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``(k, v)`` per key: count byte, then every entry in ``order`` (default fen).

    More than 255 entries under one key is an error. The rank limit of 256 is
    applied by each map task before the shuffle, so a key that holds a large
    share of the table fails fast instead of filling one task; a key that is
    allowed never reaches the limit.
    """
    order = order or ["fen"]
    columns = list(dict.fromkeys(["zobr64", "eval", "mate", "depth", "fen", "first_move", *order]))
    rows = with_entry(df.select(*columns))
    return grouped_entries(rows.select(key64_column(df).alias("key64"), "entry", *order), order)


def grouped_entries(rows: DataFrame, order: list[str]) -> DataFrame:
    """The same from rows with ``key64`` and ``entry``; rows equal in ``order`` follow by entry."""
    rank = F.row_number().over(Window.partitionBy("key64").orderBy(*order, "entry"))
    ranked = (
        rows.withColumn("nth", rank)
        .where(F.col("nth") <= C.MAX_ENTRIES + 1)
        .select("key64", "nth", "entry")
    )
    too_many = F.concat(F.lit("too many entries for key "), to_unsigned(F.col("key64")).cast("string"))
    entry = F.when(F.col("nth") > C.MAX_ENTRIES, F.raise_error(too_many).cast("binary")).otherwise(F.col("entry"))
    grouped = ranked.groupBy("key64").agg(
        F.array_sort(F.collect_list(F.struct("nth", F.hex(entry).alias("entry")))).alias("entries")
    )
    count = F.lpad(F.hex(F.size("entries")), 2, "0")
    body = F.array_join(F.transform("entries", lambda e: e["entry"]), "")
    return grouped.select(key_bytes(F.col("key64")).alias("k"), F.unhex(F.concat(count, body)).alias("v"))


def packed_entries(groups: DataFrame) -> DataFrame:
    """``(k, v)`` of ``runs.entries_of_runs``: count byte, then the entries."""
    count = F.unhex(F.lpad(F.hex("n"), 2, "0"))
    return groups.select(key_bytes(F.col("key64")).alias("k"), F.concat(count, "entries").alias("v"))


def decode_kv(kv: DataFrame) -> DataFrame:
    """One row per stored entry: key, position in the value and all fields.

    A value is a count from 1 to 255 and as many entries of 39 bytes; any other
    stops the job.
    """
    count = F.conv(F.hex(F.substring("v", 1, 1)), 16, 10).cast("int")
    wrong = F.concat(F.lit("value is not a count and its entries: key "), F.hex("k"))
    fits = (count > 0) & (F.octet_length("v") == 1 + C.ENTRY_BYTES * count)
    n = F.when(F.coalesce(fits, F.lit(False)), count).otherwise(F.raise_error(wrong).cast("int"))
    key = F.conv(F.hex("k"), 16, 10).cast("decimal(20,0)")
    entries = kv.select(key.alias("zobr64"), "v", F.explode_outer(F.sequence(F.lit(0), n - 1)).alias("nth"))
    text = entries.select("zobr64", "nth", F.hex(C.entry_bytes(F.col("v"), F.col("nth"))).alias("text"))
    numbers = text.select("zobr64", "nth", *[c.alias(n) for n, c in C.entry_numbers(F.col("text")).items()])
    return numbers.select("zobr64", "nth", *[c.alias(n) for n, c in C.entry_fields().items()])
