"""Position keys and the facts of the board, found in one pass over Arrow batches.

A position goes in as its expanded board text and one small number with the side
to move, the castling letters and the en-passant square. The key is the XOR of
one constant per feature. The constants are data: 781 pairs ``(hi, lo)`` in slot
order. ``zobr64`` uses ``hi``; ``zobr128`` is ``hi`` followed by ``lo``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poseval.functions import bitboard as B
from poseval.functions import position as P

# Slot layout. 64 slots per kind, then castling, ep file, side.
KINDS = "pPnNbBrRqQkK"
CASTLING_SLOTS = {"K": 768, "Q": 769, "k": 770, "q": 771}
EP_SLOT = 772
WHITE_SLOT = 780
SLOTS = 781

def generated_constants() -> list[tuple[int, int]]:
    """Default constants: the two halves of the MD5 of the slot number."""
    pairs = []
    for slot in range(SLOTS):
        digest = hashlib.md5(f"slot:{slot}".encode()).digest()
        pairs.append(
            (int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True))
        )
    return pairs


def constants_from_table(table: DataFrame) -> list[tuple[int, int]]:
    """Constants from a ``(slot, hi, lo)`` table, which must have 781 rows."""
    rows = table.select("slot", F.col("hi").cast("long"), F.col("lo").cast("long")).limit(SLOTS + 1).collect()
    by_slot = {r[0]: (r[1], r[2]) for r in rows}
    if len(rows) != SLOTS or sorted(by_slot) != list(range(SLOTS)):
        raise ValueError(f"the constants table must hold slots 0..{SLOTS - 1} exactly once")
    return [by_slot[s] for s in range(SLOTS)]


class _Lookup:
    """Constants by [place in the text, code of the square], by rights, ep file and side."""

    def __init__(self, constants: list[tuple[int, int]]):
        slots = np.array(constants, dtype=np.int64)
        self.men = np.zeros((64, 16, 2), np.int64)
        for place in range(64):
            square = (7 - place // 8) * 8 + place % 8
            for kind, piece in enumerate(KINDS):
                self.men[place, B.KIND[piece.lower()] + 8 * piece.islower()] = slots[64 * kind + square]
        self.rights = np.zeros((16, 2), np.int64)
        for bit, slot in enumerate(CASTLING_SLOTS.values()):
            self.rights[np.arange(16) >> bit & 1 == 1] ^= slots[slot]
        self.file = np.concatenate([np.zeros((1, 2), np.int64), slots[EP_SLOT : EP_SLOT + 8]])
        self.side = np.stack([np.zeros(2, np.int64), slots[WHITE_SLOT]])


def state_number(side: Column, castling: Column, ep: Column) -> Column:
    """White to move (bit 0), named rights KQkq (bits 1 to 4) and the ep square's bit, or 64 (from bit 5)."""
    rights = [(castling.contains(r) | castling.contains(f)).cast("int") * (2 << i) for i, (r, f) in enumerate(RIGHT_LETTERS)]
    square = F.when(ep.rlike(P.SQUARE), P.square_index(ep).bitwiseXOR(F.lit(7))).otherwise(B.NO_SQUARE)
    return sum(rights, F.when(side == "w", 1).otherwise(0)) + square * 32


# The letters that name a right, the second one by the rook's file.
RIGHT_LETTERS = ["KH", "QA", "kh", "qa"]


def _texts(board: pa.Array) -> np.ndarray:
    """The bytes of a column of texts of one length."""
    offsets = np.frombuffer(board.buffers()[1], np.int32)[board.offset : board.offset + len(board) + 1]
    return np.frombuffer(board.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]


def board_facts(board: Column, state: Column) -> Column:
    """Bits of ``bitboard.facts``; ``board`` is an expanded board, never null."""

    @F.arrow_udf("long")
    def run(board: pa.Array, state: pa.Array) -> pa.Array:
        number = state.to_numpy()
        return pa.array(B.facts(B.codes_of(_texts(board)), number & 1 == 1, number >> 5))

    return run(board, state)


def facts_and_key(board: Column, state: Column, constants: list[tuple[int, int]]) -> Column:
    """Struct ``(facts, hi, lo)``: the key counts rights that the board supports and legal captures only."""
    table = _Lookup(constants)

    @F.arrow_udf("facts long, hi long, lo long")
    def run(board: pa.Array, state: pa.Array) -> pa.Array:
        number = state.to_numpy()
        codes, white, square = B.codes_of(_texts(board)), number & 1, number >> 5
        found = B.facts(codes, white == 1, square)
        rights = number >> 1 & found // B.HOME & 15
        file = np.where(found & B.EP_LEGAL != 0, 8 - (square & 7), 0)
        key = table.rights[rights] ^ table.file[file] ^ table.side[white]
        for place in range(64):
            key ^= table.men[place][codes[place]]
        return pa.StructArray.from_arrays([pa.array(found), pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy())], names=["facts", "hi", "lo"])

    return run(board, state)


def key_by_expression(board: Column, state: Column, facts: Column, constants: list[tuple[int, int]]) -> Column:
    """Struct ``(facts, hi, lo)`` with the key from built-in functions only; slower, used to check."""
    table = _Lookup(constants)
    men = ".PNBRQK..pnbrqk."
    letters = F.split(F.replace(board, F.lit("/"), F.lit("")), "")
    square = F.shiftright(state, 5)
    legal = facts.bitwiseAND(F.lit(B.EP_LEGAL)) != 0
    rest = {
        "rights": F.shiftright(state, 1).bitwiseAND(F.floor(facts / B.HOME)).bitwiseAND(F.lit(15)),
        "file": F.when(legal, 8 - square.bitwiseAND(F.lit(7))).otherwise(0),
        "side": state.bitwiseAND(F.lit(1)),
    }

    def half(which: int) -> Column:
        def of(values: np.ndarray, at: Column) -> Column:
            return F.get(F.array(*[F.lit(int(v)) for v in values[..., which].reshape(-1)]), at.cast("int"))

        start = F.lit(0).cast("bigint")
        for name, at in rest.items():
            start = start.bitwiseXOR(of(getattr(table, name), at))
        found = F.transform(letters, lambda c, i: of(table.men, i * 16 + F.instr(F.lit(men), c) - 1))
        return F.aggregate(found, start, lambda a, v: a.bitwiseXOR(v))

    return F.struct(facts.alias("facts"), half(0).alias("hi"), half(1).alias("lo"))
