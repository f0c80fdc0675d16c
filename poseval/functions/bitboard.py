"""Positions as bit planes: the rules of the board on whole batches of 64-bit words.

A batch of boards is four planes, bits 0 to 2 of each square's kind and one
plane of black men. Bit 63 is a8, the first square of the position text, and bit
0 is h1, so a plane is the text with its men replaced by bits. Attacks look
outwards from the king: one table of squares per direction, and the nearest man
on it decided by one operation, the lowest bit upwards and, since of two
disjoint sets the one with the higher bit is the greater number, one comparison
downwards. All steps are array operations; no row is looked at by itself.
"""

from __future__ import annotations

import numpy as np

# Kinds of men. Three bits tell the kind, the fourth black.
KIND = {"p": 1, "n": 2, "b": 3, "r": 4, "q": 5, "k": 6}
#: Length of an expanded board text: eight ranks and seven slashes.
TEXT = 71
EMPTY_TEXT = "/".join(["........"] * 8)

# Steps (file, rank); opposite ones are two places apart.
_STRAIGHT = [(0, 1), (1, 0), (0, -1), (-1, 0)]
_DIAGONAL = [(1, 1), (1, -1), (-1, -1), (-1, 1)]
_KNIGHT = [(a, b) for a in (-2, -1, 1, 2) for b in (-2, -1, 1, 2) if abs(a) != abs(b)]

# Fixed values per right, in the order of its bit: king, rook and their squares.
RIGHTS = {"K": ("K", "e1", "R", "h1"), "Q": ("K", "e1", "R", "a1"), "k": ("k", "e8", "r", "h8"), "q": ("k", "e8", "r", "a8")}

#: Bits of a board's facts. The home bits of the four rights follow the last.
KINGS, PAWNS, OPPOSITE, EP_VALID, EP_LEGAL, CHECK, MATERIAL, HOME = (1 << i for i in range(8))
NO_SQUARE = 64


def bit_of(file: int, rank: int) -> int:
    """Bit of a square, both counted from 0 at a1."""
    return 8 * rank + 7 - file


def _word(bits) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


def squares(names: str) -> np.uint64:
    """Plane of named squares, as in ``"e1 h1"``."""
    return _word(bit_of(ord(s[0]) - 97, int(s[1]) - 1) for s in names.split())


def _table(reached) -> np.ndarray:
    """By bit of a square: the plane of the squares that ``reached(file, rank)`` names on the board."""
    rows = [[(f, r) for f, r in reached(7 - bit % 8, bit // 8) if 0 <= f < 8 and 0 <= r < 8] for bit in range(64)]
    return np.array([_word(bit_of(f, r) for f, r in row) for row in rows], np.uint64)


def _jumps(steps) -> np.ndarray:
    return _table(lambda f, r: [(f + a, r + b) for a, b in steps])


_LINES = {s: _table(lambda f, r, s=s: [(f + s[0] * n, r + s[1] * n) for n in range(1, 8)]) for s in _STRAIGHT + _DIAGONAL}
_NEAR_KNIGHT, _NEAR_KING = _jumps(_KNIGHT), _jumps(_STRAIGHT + _DIAGONAL)
_ABOVE, _BELOW = _jumps([(-1, 1), (1, 1)]), _jumps([(-1, -1), (1, -1)])
_ENDS = squares(" ".join(f"{f}{r}" for f in "abcdefgh" for r in (1, 8)))
_DARK = _word(bit_of(f, r) for f in range(8) for r in range(8) if (f + r) % 2 == 0)
_NOT_FILE_A, _NOT_FILE_H = (~squares(" ".join(f"{f}{r}" for r in range(1, 9))) for f in "ah")
_ONE = np.uint64(1)
_CODES = np.zeros(256, np.uint8)
for _m, _k in KIND.items():
    _CODES[[ord(_m.upper()), ord(_m)]] = _k, _k + 8
_PLACES = np.array([9 * r + f for r in range(8) for f in range(8)])


def codes_of(text: np.ndarray) -> np.ndarray:
    """Codes [square of the text, board] of expanded boards, 71 bytes each."""
    return _CODES[text.reshape(-1, TEXT)[:, _PLACES].T]


class Boards:
    """Planes of a batch of boards, and what they say about both kings."""

    def __init__(self, codes: np.ndarray):
        rows = np.ascontiguousarray(codes.T)
        bits = [np.packbits(rows & (1 << i) > 0, axis=1).view(">u8").reshape(-1).astype(np.uint64) for i in range(4)]
        b0, b1, b2, self.black = bits
        self.occupied = b0 | b1 | b2
        self.kind = {
            "p": b0 & ~b1 & ~b2,
            "n": b1 & ~b0 & ~b2,
            "b": b0 & b1 & ~b2,
            "r": b2 & ~b0 & ~b1,
            "q": b0 & b2 & ~b1,
            "k": b1 & b2 & ~b0,
        }

    def men(self, letter: str) -> np.ndarray:
        """Plane of the men that a letter of the position text stands for."""
        return self.kind[letter.lower()] & (self.black if letter.islower() else ~self.black)

    def count(self, letter: str) -> np.ndarray:
        return np.bitwise_count(self.men(letter)).astype(np.int64)


class King:
    """The king of the side where ``white`` says so, and the men that may attack it."""

    def __init__(self, boards: Boards, white: np.ndarray):
        theirs = np.where(white, boards.black, ~boards.black)
        king = boards.kind["k"] & ~theirs
        # Below a single bit lie as many bits as its number. Without a king nothing attacks.
        self.at = np.bitwise_count(king - _ONE).astype(np.intp) & 63
        theirs = np.where(king == 0, np.uint64(0), theirs)
        kind = {k: plane & theirs for k, plane in boards.kind.items()}
        self.straight, self.diagonal = kind["r"] | kind["q"], kind["b"] | kind["q"]
        self.jumps = _NEAR_KNIGHT[self.at] & kind["n"] | _NEAR_KING[self.at] & kind["k"]
        self.pawns = np.where(white, _ABOVE[self.at], _BELOW[self.at]) & kind["p"]

    def _on_line(self, occupied: np.ndarray, step: tuple[int, int], sliders: np.ndarray) -> np.ndarray:
        """The nearest man in one direction is an attacker that moves along it."""
        men = _LINES[step][self.at] & occupied
        if bit_of(*step) > bit_of(0, 0):
            return men & (~men + _ONE) & sliders != 0
        return men & sliders > men & ~sliders

    def lines(self, occupied: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Hits in both directions of the four lines."""
        found = []
        for steps, sliders in ((_STRAIGHT, self.straight), (_DIAGONAL, self.diagonal)):
            found += [tuple(self._on_line(occupied, steps[i + far], sliders) for far in (0, 2)) for i in (0, 1)]
        return found

    def attacked(self, occupied: np.ndarray, taken: np.ndarray = np.uint64(0)) -> np.ndarray:
        """Attacked on a board with these squares occupied and without the pawns ``taken``."""
        hit = self.jumps | self.pawns & ~taken != 0
        for one, other in self.lines(occupied):
            hit |= one | other
        return hit

    def impossible(self, occupied: np.ndarray) -> np.ndarray:
        """Three or more attackers, or two on one line through the king."""
        number = np.bitwise_count(self.jumps).astype(np.int64) + np.bitwise_count(self.pawns)
        aligned = np.zeros(len(self.at), bool)
        for one, other in self.lines(occupied):
            number += one.astype(np.int64) + other
            aligned |= one & other
        return aligned | (number >= 3)


def _captures(boards: Boards, king: King, white: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a pawn can just have passed over ``square``, and whether it can be captured there.

    A capture must leave the own king, ``king``, unattacked.
    """
    known = (square < NO_SQUARE) & (square >> 3 == np.where(white, 5, 2))
    target = np.where(known, _ONE << (square & 63).astype(np.uint64), np.uint64(0))
    up, down = target << np.uint64(8), target >> np.uint64(8)
    taken, start = np.where(white, down, up), np.where(white, up, down)
    theirs = np.where(white, boards.black, ~boards.black)
    enemy, own = boards.kind["p"] & theirs, boards.kind["p"] & ~theirs
    valid = (enemy & taken != 0) & (boards.occupied & (target | start) == 0)
    legal = np.zeros(len(square), bool)
    for beside in ((taken & _NOT_FILE_A) << _ONE & own, (taken & _NOT_FILE_H) >> _ONE & own):
        after = boards.occupied ^ (taken | beside | target)
        legal |= (beside != 0) & ~king.attacked(after, taken)
    return valid, valid & legal


def _too_much(boards: Boards) -> np.ndarray:
    """More than 16 men or 8 pawns, or more promoted men than missing pawns.

    Bishops beyond one per square color are promoted.
    """
    found = np.zeros(len(boards.occupied), bool)
    for letters in ("PNBRQ", "pnbrq"):
        p, n, b, r, q = letters
        mine = boards.black if p.islower() else ~boards.black
        on_dark, on_light = (np.bitwise_count(boards.men(b) & m).astype(np.int64) for m in (_DARK, ~_DARK))
        promoted = sum(np.maximum(c - usual, 0) for c, usual in ((boards.count(n), 2), (on_dark, 1), (on_light, 1), (boards.count(r), 2), (boards.count(q), 1)))
        pawns = boards.count(p)
        found |= (np.bitwise_count(boards.occupied & mine) > 16) | (pawns > 8) | (promoted > 8 - pawns)
    return found


def facts(codes: np.ndarray, white: np.ndarray, square: np.ndarray) -> np.ndarray:
    """The facts of each board as bits of one number.

    ``square`` is the bit of the square passed by a pawn, or ``NO_SQUARE``.
    """
    boards = Boards(codes)
    own, other = King(boards, white), King(boards, ~white)
    valid, legal = _captures(boards, own, white, square)
    ends = boards.kind["p"] & _ENDS != 0
    flags = {
        KINGS: (boards.count("K") != 1) | (boards.count("k") != 1),
        PAWNS: ends,
        OPPOSITE: other.attacked(boards.occupied),
        EP_VALID: valid,
        EP_LEGAL: legal,
        CHECK: own.impossible(boards.occupied),
        MATERIAL: _too_much(boards),
    }
    for i, (king, e, rook, corner) in enumerate(RIGHTS.values()):
        flags[HOME << i] = (boards.men(king) & squares(e) != 0) & (boards.men(rook) & squares(corner) != 0)
    return sum(on.astype(np.int64) * bit for bit, on in flags.items())
