"""Fingerprints bit by bit, and components against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from poseval.llm import simhash as S
from poseval.llm.components import connected_components
from pyspark.sql import functions as F


def plain_fingerprint(spark, text: str) -> int:
    """Shingles hashed by Spark's own XXH64 (seed 42)."""
    words = text.translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [r[0] for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "a b c d", "A b\tc d e\x0bF g", "é É ñ É b", "x " * 50, "a b c d e f"])
def test_fingerprint(spark, text):
    assert S.fingerprint(text.encode()) == plain_fingerprint(spark, text)


def brute(fps: list[int]) -> dict[int, int]:
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {f: find(f) for f in distinct}


def planted(n: int, cluster: int) -> list[int]:
    rnd = random.Random(n)
    fps = [rnd.getrandbits(64) for _ in range(n)]
    near = [f ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 3, 4, 5]))) for f in fps[: n // 2]]
    near += [f ^ sum(1 << b for b in rnd.sample(range(64), 4)) for f in near[: n // 4]]
    base = rnd.getrandbits(64)
    return fps + near + [base ^ rnd.getrandbits(12) ^ (rnd.getrandbits(3) << 40) for _ in range(cluster)]


@pytest.mark.parametrize("group", [16, 64, 4096])
def test_links_connect_as_all_pairs(spark, group):
    """With groups of 16 or 64, the dense cluster goes through the deeper levels."""
    fps = planted(200, 400)
    signed = [int(f) for f in np.array(fps, np.uint64).view(np.int64)]
    table = spark.createDataFrame([(f,) for f in set(signed)], "fp long").repartition(5)
    links = S.fingerprint_links(table, group).collect()
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 4 and a != b for a, b in links)
    want = brute([f for f in set(fps)])
    got = {f: f for f in want}

    def find(f):
        while got[f] != f:
            f = got[f]
        return f

    for a, b in links:
        a, b = find(a & (1 << 64) - 1), find(b & (1 << 64) - 1)
        got[max(a, b)] = min(a, b)
    groups = {}
    for f in want:
        groups.setdefault(find(f), set()).add(f)
    expect = {}
    for f, r in want.items():
        expect.setdefault(r, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, k) for k in range(2000, 2300)] + [(5000, 5000), (None, 7)]
    links += [(9000 + (k * 7) % 40, 9000 + (k * 7 + 7) % 40) for k in range(40)]
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long").repartition(7), "a", "b").collect())
    want = {i: 0 for i in range(61)} | {k: 1000 for k in [1000, *range(2000, 2300)]} | {9000 + k: 9000 for k in range(40)}
    assert got == want
    none = spark.createDataFrame([], "a long, b long")
    assert connected_components(none, "a", "b").collect() == []


def test_documents(spark, docs_of):
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rnd.choice(words) for _ in range(200)) for _ in range(12)]
    near = [" ".join("zz" if k == 57 else w for k, w in enumerate(t.split())) for t in base]
    rows = list(enumerate([*base, *near, *base[:3], "", "\n", "few words"])) + [(None, base[0]), (90, None), (5, base[5])]
    got = S.near_duplicates(docs_of(rows)).collect()
    fps = {(r.doc_id, r.fp) for r in got}
    assert fps == {(i, int(np.array(S.fingerprint((t or "").encode()), np.uint64).astype(np.int64))) for i, t in rows}
    assert len(got) == len(rows)
    roots = brute([S.fingerprint((t or "").encode()) for _, t in rows])
    least = {}
    for i, t in rows:
        r = roots[S.fingerprint((t or "").encode())]
        least[r] = min(x for x in (i, least.get(r)) if x is not None)
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == sorted(
        (i or -1, least[roots[S.fingerprint((t or "").encode())]]) for i, t in rows
    )
    assert S.near_duplicates(docs_of(rows).where("false")).collect() == []
