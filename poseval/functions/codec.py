"""Compact 39-byte entry: score i16, depth u8, move u16, board 34 bytes.

Bytes are assembled as hex text and turned into binary once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poseval.functions import position as P

# The entry layout. Nibble n of a square is the n-th character.
NIBBLE_PIECES = ".PNBRQKpnbrqk"
NIBBLE_HEX = "0123456789ABC"
MOVE_TEXT = r"^[a-h][1-8][a-h][1-8][nbrqNBRQ]?\z"
PROMOTIONS = ".nbrq"
ENTRY_BYTES = 39
MAX_ENTRIES = 255
NO_SQUARE = 255
STATE_BITS = {"K": 2, "Q": 4, "k": 8, "q": 16}


def score_of(eval_: Column, mate: Column) -> Column:
    """Mate wins over eval; clamped to 16 bits; NULL when both are absent."""
    raw = F.coalesce(mate, eval_)
    return F.when(raw.isNotNull(), F.greatest(F.lit(-32768), F.least(F.lit(32767), raw)))


def score_kind(mate: Column) -> Column:
    return F.when(mate.isNotNull(), 1).otherwise(0)


def clamp_depth(depth: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(255), depth))


def move_error(move: Column) -> Column:
    return F.coalesce((move != "0000") & ~move.rlike(MOVE_TEXT), F.lit(False))


def pack_move(move: Column, kind: Column) -> Column:
    """``from | to << 6 | promotion << 12 | kind << 15``; NULL on a bad move."""
    kind_bit = F.shiftleft(kind, 15)
    squares = (
        P.square_index(F.substring(move, 1, 2))
        .bitwiseOR(F.shiftleft(P.square_index(F.substring(move, 3, 2)), 6))
        .bitwiseOR(
            F.shiftleft(
                F.when(
                    F.length(move) == 5,
                    F.instr(F.lit(PROMOTIONS), F.lower(F.substring(move, 5, 1))) - 1,
                ).otherwise(0),
                12,
            )
        )
    )
    return (
        F.when(move.isNull() | (move == "0000"), kind_bit)
        .when(move.rlike(MOVE_TEXT), squares.bitwiseOR(kind_bit))
        .cast("int")
    )


def _hex_byte(value: Column) -> Column:
    return F.lpad(F.hex(value), 2, "0")


def _hex_le16(value: Column) -> Column:
    low = value.bitwiseAND(F.lit(255))
    high = F.shiftrightunsigned(value, 8).bitwiseAND(F.lit(255))
    return F.concat(_hex_byte(low), _hex_byte(high))


def board34_hex(expanded: Column, side: Column, castling: Column, ep: Column) -> Column:
    """68 hex digits: two squares per byte, low nibble first, then two state bytes."""
    nibbles = F.translate(P.board64(expanded), NIBBLE_PIECES, NIBBLE_HEX)
    state = F.when(side == "b", 1).otherwise(0)
    for letter, bit in STATE_BITS.items():
        state = state + F.when(castling.contains(letter), bit).otherwise(0)
    square = F.when(ep == "-", NO_SQUARE).otherwise(P.square_index(ep))
    return F.concat(_swap_pairs(nibbles), _hex_byte(state), _hex_byte(square))


def _swap_pairs(digits: Column) -> Column:
    """Exchange the two digits of every byte."""
    return F.regexp_replace(digits, "(.)(.)(.)(.)(.)(.)(.)(.)", "$2$1$4$3$6$5$8$7")


def encode_entry(score: Column, depth: Column, move_meta: Column, board34: Column) -> Column:
    return F.unhex(F.concat(_hex_le16(score), _hex_byte(clamp_depth(depth)), _hex_le16(move_meta), board34))


def entry_bytes(value: Column, nth: Column) -> Column:
    """The ``nth`` (0-based) entry of a stored value."""
    return F.substr(value, nth * ENTRY_BYTES + 2, F.lit(ENTRY_BYTES))


def entry_numbers(text: Column) -> dict[str, Column]:
    """Stored numbers of one entry from its 78 hex digits."""

    def byte(n: int) -> Column:
        return F.conv(F.substring(text, 2 * n + 1, 2), 16, 10).cast("int")

    return {
        "raw_score": byte(0) + byte(1) * 256,
        "depth": byte(2),
        "meta": byte(3) + byte(4) * 256,
        "squares": F.translate(_swap_pairs(F.substring(text, 11, 64)), NIBBLE_HEX, NIBBLE_PIECES),
        "state": byte(37),
        "ep_square": byte(38),
    }


def entry_fields() -> dict[str, Column]:
    """Fields of one entry from the columns of ``entry_numbers``."""
    raw, meta, state, square = (F.col(c) for c in ("raw_score", "meta", "state", "ep_square"))
    letters = F.concat(
        *[F.when(state.bitwiseAND(F.lit(bit)) != 0, letter).otherwise("") for letter, bit in STATE_BITS.items()]
    )
    side = F.when(state.bitwiseAND(F.lit(1)) == 1, "b").otherwise("w")
    castling = F.when(state.bitwiseAND(F.lit(30)) == 0, "-").otherwise(letters)
    ep = F.when(square == NO_SQUARE, "-").otherwise(_square_name(square))
    return {
        "score": F.when(raw >= 32768, raw - 65536).otherwise(raw),
        "kind": F.shiftright(meta, 15),
        "depth": F.col("depth"),
        "from_square": meta.bitwiseAND(F.lit(63)),
        "to_square": F.shiftright(meta, 6).bitwiseAND(F.lit(63)),
        "promotion": F.shiftright(meta, 12).bitwiseAND(F.lit(7)),
        "fen": F.concat_ws(" ", P.board_from_board64(F.col("squares")), side, castling, ep),
    }


def _square_name(index: Column) -> Column:
    return F.concat(F.char(index % 8 + 97), F.char(F.floor(index / 8) + 49))
