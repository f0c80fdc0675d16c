"""Removed bytes against a dictionary of all 100-byte strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from poseval.llm import suffix_dedup as S


def brute(rows):
    """Spans and rest of every row."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, hashlib.sha256((rows[k][1] or "").encode()).digest()))
    seen, out = {}, [None] * len(rows)
    for k in order:
        data = (rows[k][1] or "").encode()
        cover = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - 99):
            piece = data[i : i + 100]
            if piece in seen:
                cover[i : i + 100] = True
            else:
                seen[piece] = k
        edges = np.flatnonzero(np.diff(np.r_[False, cover]))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out[k] = (rows[k][0], len(data), spans, bytes(b for b, c in zip(data, cover) if not c))
    return out


def check(rows, got):
    def key(r):
        return (r[0] is not None, r[0] or 0, r[1], r[2], r[3] if r[3] is not None else b"")

    texts = {}
    found = []
    for i, t in rows:
        texts.setdefault((i, hashlib.sha256((t or "").encode()).digest()), (t or "").encode())
    for r in got:
        kept = bytes(r.kept) if r.kept is not None else texts[(r.doc_id, bytes(r.sha))]
        found.append((r.doc_id, r.n_bytes, [(s.start, s.stop) for s in r.spans], kept))
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


def corpus(n):
    rnd = random.Random(n)
    words = [f"{rnd.getrandbits(40):x}" for _ in range(500)]
    text = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    passages = [text(rnd.choice([9, 10, 12, 30])) for _ in range(8)]
    rows = []
    for k in range(n):
        parts = [text(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(passages)[rnd.randint(0, 20) :], text(rnd.randint(0, 30))]
        rows.append((k, " ".join(parts)))
    hot = text(40)
    rows += [(1000 + k, text(3) + hot[: rnd.randint(150, 400)] + text(3)) for k in range(80)]
    rows += [(2000, "a" * 150), (2001, "b" + "a" * 99), (2002, "a" * 99), (2003, "ab" * 200), (2004, "é" * 130), (2005, None), (2006, "")]
    rows += [(3000 + k, rows[3][1]) for k in range(4)] + [(5, "short"), (None, rows[6][1]), (None, text(40)), (rows[9][0], rows[9][1]), (2100, "x" * 60)]
    return rows


@pytest.mark.parametrize("bucket", [7, 60, 1 << 15])
def test_removed_bytes(docs_of, bucket, monkeypatch):
    """Small buckets cut the shared passages by many splitters."""
    rows = corpus(60)
    check(rows, S.repeated_strings(docs_of(rows).selectExpr("*", "1 AS seq", "2 AS sha"), bucket=bucket).collect())


def test_unique_ids_and_long_texts(docs_of, monkeypatch):
    rows = [(i, t) for i, t in dict(corpus(40)).items() if i is not None]
    rnd = random.Random(9)
    long = "".join(rnd.choice("abcd ") for _ in range(3000))
    rows += [(9000, long + "!" + long[50:2000]), (9001, "?" + long)]
    monkeypatch.setattr(S, "CHUNK", 700)
    check(rows, S.repeated_strings(docs_of(rows)).collect())
    starts = np.array([0]), np.array([len(long)])
    data = np.frombuffer(long.encode(), np.uint8)
    gram, place, first, last = S.anchors(data, *starts)
    hashes = S._rolling(data, [32]) >> np.uint64(32)
    for p, a, b in zip(place, first, last):
        for i in range(a, b + 1):
            assert p == i + int(hashes[i : i + 69].argmin())
    assert first[0] == 0 and last[-1] == len(long) - 100 and (first[1:] == last[:-1] + 1).all()


def test_repeated_rows_of_unique_ids(docs_of):
    rnd = random.Random(5)
    text = "".join(rnd.choice("abcdef ") for _ in range(400))
    rows = [(1, text), (2, text[:300] + "?"), (2, text[:300] + "?"), (3, "short"), (3, "short")]
    check(rows, S.repeated_strings(docs_of(rows)).collect())


def test_equal_hashes_are_told_apart(monkeypatch):
    data = np.frombuffer((b"x" * 100 + b"y" * 100) * 2, np.uint8)
    monkeypatch.setattr(S, "_rolling", lambda data, sizes: np.zeros(len(data), np.uint64))
    assert S._sources(data, np.array([0, 100, 200, 300]), np.array([0, 1, 2, 3])).tolist() == [0, 1, 0, 1]


def test_quicksort():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3, (5000, 4)).astype(np.uint64)
    order = S.multikey_quicksort(words)
    assert sorted(order.tolist()) == list(range(5000))
    rows = [tuple(r) for r in words[order].tolist()]
    assert rows == sorted(rows)


def test_empty_table(docs_of):
    assert S.repeated_strings(docs_of(["a"]).where("false")).collect() == []
