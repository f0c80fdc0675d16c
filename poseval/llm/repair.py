"""Re-Pair grammars over blocks of token ids, with access by token place.

A grammar replaces frequent pairs of neighbours by new symbols, round by round.
A round takes all frequent pairs at once: where occurrences overlap, the more
frequent pair wins, and a pair that keeps fewer than ``LEAST_USES`` places is
left alone. Frequencies that only rank pairs are counted in hashed buckets; the
uses that decide are exact. Symbols are numbered within the block: first the
ids that occur, then one symbol per rule, so most blocks need two bytes each.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: A rule costs two symbols and a length, and saves one symbol per use.
LEAST_USES = 4
#: A round that shortens the sequence by less than this share is the last.
LEAST_SHARE = 1 / 40
#: Pairs are counted in so many buckets; the factors mix two symbols into one.
BUCKET_BITS = 18
MIX = np.array([0x9E3779B1, 0x85EBCA77], np.uint32)
#: Every so many symbols the token place is noted.
STEP = 64


class Grammar(NamedTuple):
    """A block: ``alphabet`` holds the ids, ``rules`` two symbols each, ``lengths`` what they expand to."""

    alphabet: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray
    sequence: np.ndarray
    marks: np.ndarray


def _frequent(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs to replace, the pair's number in the round, and one place of each pair.

    A pair is a candidate where no neighbouring pair outranks it. Of pairs that
    share a bucket one is taken, the others have later rounds; its uses are counted
    exactly.
    """
    bucket = ((seq[:-1] * MIX[0] + seq[1:] * MIX[1]) >> np.uint32(32 - BUCKET_BITS)).astype(np.intp)
    rank = np.bincount(bucket, minlength=1 << BUCKET_BITS)[bucket]
    many = rank >= LEAST_USES
    rank = rank << BUCKET_BITS | bucket
    # In a run of one symbol every other pair is a candidate. Runs are few, so only their places are looked at.
    run = np.flatnonzero(rank[1:] == rank[:-1]) + 1
    if len(run):
        here = np.arange(len(run))
        first = np.maximum.accumulate(np.where(np.append(True, np.diff(run) != 1), here, 0))
        rank[run[(here - first) % 2 == 0]] = 0
    rise = rank[1:] > rank[:-1]
    many[1:] &= rise
    many[:-1] &= ~rise
    at = np.flatnonzero(many)
    bucket = bucket[at]
    holder = np.zeros(1 << BUCKET_BITS, np.int32)
    holder[bucket] = at
    chosen = holder[bucket]
    equal = (seq[at] == seq[chosen]) & (seq[at + 1] == seq[chosen + 1])
    at, bucket = at[equal], bucket[equal]
    used = np.bincount(bucket, minlength=1 << BUCKET_BITS) >= LEAST_USES
    number = np.cumsum(used) - 1
    stay = used[bucket]
    return at[stay], number[bucket[stay]], holder[used]


def compress(ids: np.ndarray) -> Grammar:
    """The grammar of a block of ids."""
    alphabet = np.flatnonzero(np.bincount(ids)) if len(ids) else np.zeros(0, np.int64)
    place = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 0, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    seq = place[ids].astype(np.uint32)
    lengths = [np.ones(len(alphabet), np.int64)]
    rules = [np.zeros((0, 2), np.int64)]
    known = lengths[0]
    while len(seq) > 1:
        at, number, one = _frequent(seq)
        if not len(at):
            break
        made = np.stack([seq[one], seq[one + 1]], axis=1).astype(np.int64)
        rules.append(made)
        stays = np.ones(len(seq), bool)
        stays[at + 1] = False
        seq[at] = number + len(known)
        seq = seq[stays]
        known = np.concatenate([known, known[made].sum(axis=1)])
        if len(at) < LEAST_SHARE * (len(seq) + len(at)):
            break
    seq = seq.astype(np.int64)
    ends = np.cumsum(known[seq])
    marks = np.concatenate([[0], ends])[: len(seq) : STEP] if len(seq) else np.zeros(0, np.int64)
    return Grammar(alphabet, np.concatenate(rules), known[len(alphabet) :], seq, marks)


def _symbols(rules: np.ndarray, first: int, symbols: np.ndarray) -> np.ndarray:
    """The symbols below ``first`` that ``symbols`` stand for, level by level."""
    while True:
        rule = symbols >= first
        if not rule.any():
            return symbols
        size = 1 + rule
        out = np.repeat(symbols, size)
        left = (np.cumsum(size) - size)[rule]
        parts = rules[symbols[rule] - first]
        out[left], out[left + 1] = parts[:, 0], parts[:, 1]
        symbols = out


def expand(g: Grammar) -> np.ndarray:
    """All ids of a block: each rule is expanded once, then copied to its places."""
    first = len(g.alphabet)
    table = np.concatenate([np.arange(first), _symbols(g.rules, first, first + np.arange(len(g.rules)))])
    lengths = np.concatenate([np.ones(first, np.int64), g.lengths])
    starts = np.cumsum(lengths) - lengths
    size = lengths[g.sequence]
    ends = np.cumsum(size)
    at = np.repeat(starts[g.sequence] - (ends - size), size)
    at += np.arange(len(at))
    return g.alphabet[table[at]]


def expand_range(g: Grammar, start: int, length: int) -> np.ndarray:
    """Ids ``start .. start + length - 1``; only the symbols that cover them are expanded."""
    first = len(g.alphabet)
    stop = min(start + length, int(g.marks[-1] + _lengths(g, g.sequence[(len(g.marks) - 1) * STEP :]).sum())) if len(g.marks) else 0
    if start < 0 or start >= stop:
        return np.zeros(0, np.int64)
    low = int(np.searchsorted(g.marks, start, "right")) - 1
    high = int(np.searchsorted(g.marks, stop, "left"))
    part = g.sequence[low * STEP : high * STEP]
    ends = int(g.marks[low]) + np.cumsum(_lengths(g, part))
    lo, hi = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left"))
    before = int(ends[lo - 1]) if lo else int(g.marks[low])
    ids = g.alphabet[_symbols(g.rules, first, part[lo : hi + 1])]
    return ids[start - before : stop - before]


def _lengths(g: Grammar, symbols: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    rule = symbols >= len(g.alphabet)
    out[rule] = g.lengths[symbols[rule] - len(g.alphabet)]
    return out


def symbol_width(g: Grammar) -> int:
    """Bytes that any symbol fits."""
    return max(1, ((len(g.alphabet) + len(g.rules) - 1).bit_length() + 7) // 8)


def pack(numbers: np.ndarray, width: int) -> bytes:
    """Unsigned little-endian numbers of ``width`` bytes."""
    return numbers.astype("<u4").reshape(-1, 1).view(np.uint8)[:, :width].tobytes()


def unpack(data: bytes | memoryview, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    wide = np.zeros((len(raw), 4), np.uint8)
    wide[:, :width] = raw
    return wide.view("<u4").reshape(-1).astype(np.int64)
