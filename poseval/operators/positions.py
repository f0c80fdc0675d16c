"""Position columns added to a table; all narrow, no shuffle."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poseval.functions import bitboard as B
from poseval.functions import hashing as H
from poseval.functions import position as P
from poseval.schema import compute_once, key_bytes, require_columns, to_unsigned


def with_fen_fields(df: DataFrame, fen: str = "fen") -> DataFrame:
    """Add ``n_fields, board, side, castling, ep, clocks``; absent castling and ep are ``-``."""
    require_columns(df, [fen])
    split = df.withColumn("_parts", P.tokens(F.col(fen)))
    part = lambda i: F.get("_parts", F.lit(i))
    return split.withColumns(
        {
            "n_fields": F.size("_parts"),
            "board": F.coalesce(part(0), F.lit("")),
            "side": F.coalesce(part(1), F.lit("")),
            "castling": F.coalesce(part(2), F.lit("-")),
            "ep": F.coalesce(part(3), F.lit("-")),
            "clocks": F.when(
                F.size("_parts") > 4,
                F.concat_ws(" ", F.slice("_parts", F.lit(5), F.greatest(F.size("_parts") - 4, F.lit(0)))),
            ).otherwise(""),
        }
    ).drop("_parts")


FIELD_COLUMNS = ["n_fields", "board_ok", "side", "castling", "ep", "clocks"]


def with_board(df: DataFrame) -> DataFrame:
    """Add the FEN fields, the ``expanded`` board and ``board_ok``."""
    fields = with_fen_fields(df).withColumn("expanded", P.expand_digits(F.col("board")))
    return fields.withColumn("board_ok", P.board_ok(F.col("board"), F.col("expanded")))


def with_board64(df: DataFrame) -> DataFrame:
    """Add the FEN fields, ``board64`` and ``fen_error``."""
    return (
        with_board(df)
        .withColumns(
            {
                "board64": F.when(F.col("board_ok"), P.board64(F.col("expanded"))),
                "fen_error": P.fen_error(*[F.col(c) for c in FIELD_COLUMNS[:5]]),
            }
        )
        .drop("expanded", "board_ok")
    )


def _parsed(df: DataFrame) -> DataFrame:
    """FEN fields, ``syntax``, and the two inputs of the board pass: ``_board`` and ``_state``.

    All of it is one value that is computed once per row, whatever filters and
    Python stages above it use.
    """
    fields = with_board(df).withColumn("side", F.when(F.col("n_fields") < 2, "w").otherwise(F.col("side")))
    values = {
        **{c: F.col(c) for c in ("board", *FIELD_COLUMNS)},
        "syntax": P.syntax_error(*[F.col(c) for c in FIELD_COLUMNS]),
        "_board": F.when(F.col("board_ok"), F.col("expanded")).otherwise(B.EMPTY_TEXT),
        "_state": H.state_number(F.col("side"), F.col("castling"), F.col("ep")),
    }
    found = F.struct(*[c.alias(n) for n, c in values.items()])
    return compute_once(fields, df.columns, found, "_parsed").select(*df.columns, "_parsed.*")


def has(fact: int) -> Column:
    """Whether ``facts`` has a bit of ``bitboard``."""
    return F.col("facts").bitwiseAND(F.lit(fact)) != 0


def _position_error() -> Column:
    bad = F.when(has(B.KINGS), "kings").when(has(B.PAWNS), "pawns").when(has(B.OPPOSITE), "opposite check")
    return F.when(F.col("syntax").isNotNull(), F.concat(F.lit("syntax: "), F.col("syntax"))).otherwise(
        F.concat(F.lit("position: "), bad)
    )


def with_legality(df: DataFrame) -> DataFrame:
    """Add FEN fields, ``facts``, ``syntax`` and ``position_error``.

    ``facts`` are the board's bits of ``bitboard.facts`` (those of an empty board
    where the text is bad). ``position_error`` is ``syntax: ...`` or ``position:
    ...`` where no tolerated rule can make a position of the text, else NULL.
    The rules run once per row, in one pass over Arrow batches; filters on their
    results stay above it.
    """
    boards = _parsed(df)
    found = boards.withColumn("facts", H.board_facts(F.col("_board"), F.col("_state"))).drop("_board", "_state")
    return found.withColumn("position_error", _position_error())


def with_position_key(
    df: DataFrame,
    constants: list[tuple[int, int]] | None = None,
    on_error: str = "fail",
    engine: str = "arrow",
) -> DataFrame:
    """Append ``zobr64`` DECIMAL(20,0) and ``zobr128`` (16 bytes, big-endian).

    ``on_error="fail"`` stops the job at a text that is no position;
    ``"null"`` leaves both keys NULL and adds ``position_error``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    pairs = constants or H.generated_constants()
    columns = df.columns
    parsed = _parsed(df.select(F.struct("*").alias("_row"), "fen"))
    board, state = F.col("_board"), F.col("_state")
    if engine == "arrow":
        found = parsed.withColumn("_key", H.facts_and_key(board, state, pairs))
    else:
        known = parsed.withColumn("_facts", H.board_facts(board, state))
        found = known.withColumn("_key", H.key_by_expression(board, state, F.col("_facts"), pairs))
    keyed = found.select("_row", "fen", "syntax", "_key.*").withColumn("position_error", _position_error())
    good = F.col("position_error").isNull()
    hi = F.when(good, F.col("hi"))
    if on_error == "fail":
        problem = F.concat_ws(" ", F.col("position_error"), F.lit("in"), F.col("fen"))
        hi = F.when(good, F.col("hi")).otherwise(F.raise_error(problem).cast("bigint"))
    out = [F.col(f"_row.{c}").alias(c) for c in columns] + [
        to_unsigned(F.col("_hi")).alias("zobr64"),
        F.concat(key_bytes(F.col("_hi")), key_bytes(F.col("lo"))).alias("zobr128"),
    ]
    if on_error == "null":
        out.append(F.col("position_error"))
    return keyed.withColumn("_hi", hi).select(*out)


def castling_possible() -> Column:
    """Over ``with_legality``: every castling letter is one of KQkq and has king and rook at home."""
    castling = F.col("castling")
    kept = [~castling.contains(r) | has(B.HOME << i) for i, r in enumerate(B.RIGHTS)]
    return reduce(and_, kept, castling.rlike(r"^[KQkq]+\z"))


# Problem labels, in report order.
PROBLEMS = {
    "start": "impossible side to move for standard starting board",
    "syntax": "invalid fen syntax",
    "castling": "invalid castling rights",
    "ep": "invalid en-passant square",
    "check": "impossible check state",
    "material": "too much material",
    "no_castling": "castling not possible from this position",
    "no_ep": "en-passant not possible from this position",
    "position": "unrecoverable position error",
}


def position_problems(df: DataFrame) -> DataFrame:
    """Add ``problems`` (all findings) and ``reported`` (tolerance-chain view).

    The chain removes castling, en-passant, check and material errors in this
    order and reports only the one whose removal made the position valid, that
    is the last of those present; the two "not possible" findings follow.
    """
    columns = df.columns
    base = with_legality(df.select(F.struct("*").alias("_row"), "fen"))
    castling, ep, built = F.col("castling"), F.col("ep"), F.col("position_error").isNull()
    named = castling != "-"
    home = {right: has(B.HOME << i) for i, right in enumerate(B.RIGHTS)}
    lost = {r: ~home[r] & (castling.contains(r) | castling.contains(f)) for r, f in H.RIGHT_LETTERS}
    invalid = reduce(or_, lost.values(), castling.rlike("[B-Gb-g]"))
    flags = base.withColumns(
        {
            "start": (F.col("board") == P.START_BOARD) & (F.col("side") == "b"),
            "e_syntax": F.col("syntax").isNotNull(),
            "e_position": F.coalesce(F.col("position_error").startswith("position"), F.lit(False)),
            "e_castling": built & named & invalid,
            "e_ep": built & (ep != "-") & ~has(B.EP_VALID),
            "e_check": built & has(B.CHECK),
            "e_material": built & has(B.MATERIAL),
            "x_castling": built & named & ~castling_possible(),
            "x_ep": built & (ep != "-") & ~has(B.EP_LEGAL),
        }
    )
    label = lambda on, key: F.when(on, PROBLEMS[key])
    c = F.col
    last = (
        F.when(c("e_material"), PROBLEMS["material"])
        .when(c("e_check"), PROBLEMS["check"])
        .when(c("e_ep"), PROBLEMS["ep"])
        .when(c("e_castling"), PROBLEMS["castling"])
    )
    masked = c("e_castling") & ~c("e_ep") & ~c("e_check") & ~c("e_material")
    every = F.array_compact(
        F.array(
            label(c("start"), "start"),
            label(c("e_syntax"), "syntax"),
            label(c("e_castling"), "castling"),
            label(c("e_ep"), "ep"),
            label(c("e_check"), "check"),
            label(c("e_material"), "material"),
            label(c("x_castling") & ~c("e_castling"), "no_castling"),
            label(c("x_ep"), "no_ep"),
            label(c("e_position"), "position"),
        )
    )
    shown = F.array_compact(
        F.array(
            label(c("start"), "start"),
            label(c("e_syntax"), "syntax"),
            last,
            label(c("x_castling") & ~masked, "no_castling"),
            label(c("x_ep"), "no_ep"),
            label(c("e_position"), "position"),
        )
    )
    ok = lambda a: F.when(F.size(a) == 0, F.array(F.lit("OK"))).otherwise(a)
    return flags.select(
        *[F.col(f"_row.{n}").alias(n) for n in columns], ok(every).alias("problems"), ok(shown).alias("reported")
    )
