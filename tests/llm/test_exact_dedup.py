"""Groups against a dictionary of texts; filters against the keys that went in."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from poseval.llm import exact_dedup as E


def brute(rows):
    groups = {}
    for i, t in rows:
        norm = (t or "").translate({c: None for c in (*range(9, 14), 32)})
        groups.setdefault(norm, []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        members.sort()
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), k == 0, sha) for k, m in enumerate(members)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 60_000])
def test_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    made = E.FuseFilter.load(E.FuseFilter.build(np.r_[keys, keys[:5]]).dump())
    assert made.admits(keys).all()
    assert made.admits(rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)).mean() < 0.01
    if n > 1000:
        assert len(made.slots) < 1.3 * n


@pytest.mark.parametrize("batches", [1, 3])
def test_groups(docs_of, batches):
    rnd = random.Random(4)
    rows = [(k, " ".join(rnd.choice(["a", "b", "C"]) for _ in range(rnd.choice([0, 1, 2, 6])))) for k in range(150)]
    rows += [(k, "hot\ttext " + " " * (k % 3)) for k in range(200, 300)]
    rows += [(5, rows[5][1]), (5, "other"), (400, None), (None, "a b"), (None, "only null"), (None, "only null"), (401, " x"), (402, "x")]
    rows += [(500 + k, "é" * 40_000 + "\n" * k) for k in range(3)]
    got = E.exact_duplicates(docs_of(rows), batches, shard_keys=20).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.sha).hex()) for r in got), key=repr) == brute(rows)


def test_empty_table(docs_of):
    assert E.exact_duplicates(docs_of([(1, "a")]).where("false")).collect() == []


def test_other_bytes_under_one_digest_stop_the_job(spark, docs_of):
    digest = E.digests(docs_of([(1, "a"), (2, "b")])).collect()
    docs = docs_of([(1, "a"), (2, "a")])
    ok = spark.createDataFrame([(1, digest[0].sha if digest[0].doc_id == 1 else digest[1].sha)], "doc_id long, sha binary")
    assert E.check_bytes(docs, ok).count() == 1
