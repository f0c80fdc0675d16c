"""Position text (FEN) as column expressions.

``board64`` is a board as 64 characters, index 0 = a1, ``.`` for an empty
square. What the rules of the board need is in ``bitboard``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The position text format.
PIECES = "PNBRQKpnbrqk"
START_BOARD = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR"
BOARD_TEXT = r"^[PNBRQKpnbrqk1-8]+(/[PNBRQKpnbrqk1-8]+){7}\z"
BOARD_FULL = r"^[PNBRQKpnbrqk.]{8}(/[PNBRQKpnbrqk.]{8}){7}\z"
SQUARE = r"^[a-h][1-8]\z"


def tokens(text: Column) -> Column:
    """Whitespace-separated tokens; Unicode whitespace counts."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0))


def first_token(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?U)\S+", 0), F.lit(""))


def dedupe_key(fen: Column, parts: Column) -> Column:
    """Everything but castling rights; short texts only equal themselves."""
    return F.when(
        F.size(parts) >= 4, F.concat_ws(" ", *[F.get(parts, F.lit(i)) for i in (0, 1, 3)])
    ).otherwise(F.concat(F.lit("raw:"), fen))


def expand_digits(board: Column) -> Column:
    for n in range(1, 9):
        board = F.replace(board, F.lit(str(n)), F.lit("." * n))
    return board


def contract_dots(board: Column) -> Column:
    for n in range(8, 0, -1):
        board = F.replace(board, F.lit("." * n), F.lit(str(n)))
    return board


def board_ok(board: Column, expanded: Column) -> Column:
    """Eight ranks of eight squares; ``expanded`` is ``expand_digits(board)``."""
    return board.rlike(BOARD_TEXT) & expanded.rlike(BOARD_FULL)


def board64(expanded: Column) -> Column:
    """64 characters of a valid expanded board, a1 first."""
    return F.concat(*[F.substring(expanded, 64 - 9 * r, 8) for r in range(8)])


def board_from_board64(squares: Column) -> Column:
    ranks = [F.substring(squares, 1 + 8 * r, 8) for r in range(7, -1, -1)]
    return contract_dots(F.concat_ws("/", *ranks))


def fen_error(n_fields: Column, valid_board: Column, side: Column, castling: Column, ep: Column) -> Column:
    """Name of the first failing check of the compact encoding, or NULL."""
    return (
        F.when(n_fields < 4, "fields")
        .when(~valid_board, "board")
        .when(~side.isin("w", "b"), "side")
        .when((castling != "-") & castling.rlike("[^KQkq]"), "castling")
        .when((ep != "-") & ~ep.rlike(SQUARE), "ep")
    )


def bad_castling_letter(error: Column, castling: Column) -> Column:
    """First letter outside KQkq where castling is the first failing check."""
    return F.when(error == "castling", F.regexp_extract(castling, "[^KQkq]", 0))


def square_index(square: Column) -> Column:
    """0..63, a1 = 0, of a two-character square name."""
    return (F.ascii(F.substring(square, 2, 1)) - 49) * 8 + (F.ascii(square) - 97)


def syntax_error(
    n_fields: Column, valid_board: Column, side: Column, castling: Column, ep: Column, clocks: Column
) -> Column:
    """Text that is no position at all; missing trailing fields have defaults."""
    return (
        F.when((n_fields < 1) | (n_fields > 6) | ~clocks.rlike(r"^[0-9 ]*\z"), "fields")
        .when(~valid_board, "board")
        .when(~side.isin("w", "b"), "side")
        .when(~castling.rlike(r"^(-|[KQkqA-Ha-h]+)\z"), "castling")
        .when((ep != "-") & ~ep.rlike(SQUARE), "ep")
    )
