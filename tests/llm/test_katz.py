"""The model against dictionaries, and its probabilities against one."""

from __future__ import annotations

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from poseval.llm import katz as K
from pyspark.sql import functions as F


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in (text or "").split(" ") if w] + ["</s>"]


def held(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2


class Plain:
    def __init__(self, rows, order):
        self.counts = [Counter() for _ in range(order + 1)]
        for i, t in rows:
            if not held(i):
                tokens = ["<s>"] * (order - 1) + words_of(t)
                for k in range(order - 1, len(tokens)):
                    for n in range(1, order + 1):
                        self.counts[n][tuple(tokens[k - n + 1 : k + 1])] += 1
        self.d = [None]
        for n in range(1, order + 1):
            often = Counter(self.counts[n].values())
            self.d.append(K.discounts(np.array([often[r] for r in range(1, K.CUT + 2)])))
        self.follow = [defaultdict(list) for _ in range(order + 1)]
        for n in range(1, order + 1):
            for g, c in self.counts[n].items():
                self.follow[n][g[:-1]].append((g[-1], c))

    def p(self, context, word):
        """Recursion; the unknown word is None."""
        n = len(context) + 1
        seen = self.follow[n].get(context)
        if not seen:
            return self.p(context[1:], word) if context else 1.0
        total = sum(c for _, c in seen)
        left = sum((1 - self.d[n][c - 1]) * c for _, c in seen if c <= K.CUT)
        base = total if left > 0 else total + 1
        c = self.counts[n].get((*context, word), 0)
        if c:
            return (c if c > K.CUT else c * self.d[n][c - 1]) / base
        mass = (left if left > 0 else 1.0) / base
        if not context:
            return mass
        return mass / (1 - sum(self.p(context[1:], w) for w, _ in seen)) * self.p(context[1:], word)


def corpus(n):
    rnd = random.Random(n)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(400)]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))) for k in range(n)]
    return rows + [(900, None), (901, " \n"), (None, "the END w1 w2"), (3, rows[3][1]), (902, "É w1\tW2 unseen" + str(n)), (904, "zz yy xx")]


@pytest.mark.parametrize("order,block,bucket,share", [(1, 100, 30, 0.1), (2, 150, 40, 0.01), (2, 10**6, 10**6, 1.0), (3, 200, 60, 0.02)])
def test_scores(docs_of, order, block, bucket, share):
    rows = corpus(150)
    plain = Plain(rows, order)
    n, v = sum(plain.counts[1].values()), len(plain.counts[1])
    want = []
    for i, t in rows:
        tokens = words_of(t)
        score, history = 0.0, ("<s>",) * (order - 1)
        for w in tokens:
            score += math.log10(plain.p(history, w))
            history = (*history, w)[1:]
        c = [plain.counts[1].get((w,), 0) for w in tokens]
        base = sum(math.log10((k + 1) / (n + v + 1)) for k in c)
        want.append((str(i), held(i), len(tokens), sum(k > 0 for k in c), n, round(base, 6), round(score, 6)))
    table = docs_of(rows).selectExpr("*", "1 AS block", "2 AS train")
    got = K.score_documents(table, order, block, bucket, share).collect()
    rounded = [(str(r.doc_id), *list(r)[1:5], round(r.base_score, 6), round(r.score, 6)) for r in got]
    assert sorted(rounded) == sorted(want)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_sum_to_one(order):
    plain = Plain(corpus(80), order)
    vocabulary = [w for (w,) in plain.counts[1]] + [None]
    for context in list(plain.follow[order])[:25]:
        assert abs(sum(plain.p(context, w) for w in vocabulary) - 1) < 1e-9


def test_discounts():
    d = K.discounts(np.array([1000, 400, 200, 120, 80, 60]))
    assert ((0 < d) & (d < 1)).all()
    assert (K.discounts(np.zeros(6)) == 1).all()
    assert ((0 < K.discounts(np.array([5, 0, 0, 0, 0, 9]))) & (K.discounts(np.array([5, 0, 0, 0, 0, 9])) < 1)).all()


def test_empty_and_untrained(docs_of):
    assert K.score_documents(docs_of(["a"]).where("false")).collect() == []
    only = next(i for i in range(50) if held(i))
    (row,) = K.score_documents(docs_of([(only, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)


def test_divided_contexts_and_packing_grow_with_the_text(docs_of, monkeypatch):
    """Rows do not grow with contexts times buckets, nor an n-gram's bytes with the number of buckets."""
    rnd = random.Random(5)
    rows = [(k, " ".join(f"w{int(rnd.paretovariate(0.8))}" for _ in range(300))) for k in range(80)]
    seen = {}

    def put(df, name, heavy=False):
        seen[name] = staged(df, name, heavy)
        return seen[name]

    staged = K.staged
    monkeypatch.setattr(K, "staged", put)
    spark = (docs := docs_of(rows)).sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 200)
        K.score_documents(docs, 2, 2000, 4000, 1 / 1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    blocks = seen["blocks"].count()
    for level in ("level-1", "level-2"):
        divided = seen[level].where("block = -2").count()
        assert 0 < divided <= 2 * 8 * 24_080 / 4000
        assert seen[level].where("block >= 0").count() <= blocks * 7


def test_packed_numbers():
    rnd = np.random.default_rng(1)
    for x in (rnd.random(1000), rnd.choice(rnd.random(9), 1000), np.zeros(5), rnd.random(1)):
        assert (K._unpack_values(K._pack_values(x)) == x).all()
    # Numbers that all differ take no dictionary beside them.
    assert len(K._pack_values(rnd.random(1000))) < 8200


def test_a_task_holds_one_block_at_a_time(docs_of, monkeypatch):
    """Blocks come in as many tasks as there are blocks, and what one takes in memory is gone before the next."""
    rnd = random.Random(3)
    docs = docs_of([(k, " ".join(f"w{int(rnd.paretovariate(0.5)) % 50_000}" for _ in range(500))) for k in range(160)])
    calls, kept = [], type(docs).mapInArrow

    def noted(df, run, *rest):
        calls.append((df, run))
        return kept(df, run, *rest)

    def peak(run, batches):
        tracemalloc.start()
        for _ in run(iter(batches)):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    spark, before = docs.sparkSession, docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 1)
        scores = K.score_documents(docs.coalesce(1), 2, 10_000, 10_000)
        assert scores.count() == 160
        assert scores.select(F.spark_partition_id()).distinct().count() >= 3
        # Blocks, then asked and answered by level, then scored.
        assert len(calls) == 6
        for k in (1, 3, 5):
            df, run = calls[k]
            rows = df.toArrow().combine_chunks().to_batches()
            blocks = [b.slice(i, 1) for b in rows for i in range(b.num_rows)]
            assert len(blocks) == 8
            peak(run, blocks[:1])
            assert peak(run, blocks) < 1.15 * max(peak(run, [b]) for b in blocks), k
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
