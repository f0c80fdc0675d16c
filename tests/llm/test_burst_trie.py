"""Prefix tries against a dictionary of prefixes, with containers of every size."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from poseval.llm.burst_trie import conversation_paths, prefix_trie
from poseval.llm.queries import op12_prefix_trie

KIND = "conv_id long, turn long, role string, text string, path string, words string, key string, top int"


def table(spark, conversations, partitions=4):
    """Conversations as lists of (turn, role, text); extra columns have the names the operator uses inside."""
    rows = [(c, *t, "p", "w", "k", 1) for c, turns in conversations for t in turns]
    return spark.createDataFrame(rows, KIND).repartition(partitions)


def plain(sequences):
    """Nodes of the sequences ``{conv_id: [(role, text), ..]}``, one row each."""
    members = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    total = {p: [0, 0] for p in members}
    kids = {p: 0 for p in members}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        saved = (len(m) - 1) * len(p[-1][1].split()) if p else 0
        for d in range(len(p) + 1):
            total[p[:d]][0] += not kids[p]
            total[p[:d]][1] += saved
    rows = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        rows.append((min(m), len(p), up, len(m), kids[p], *total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, n=300):
    """Copies, prefixes of others, long shared beginnings and turns with equal texts."""
    rng = random.Random(seed)
    long = [("user", f"w{i} x") for i in range(40)]
    out = []
    for c in range(n):
        kind = rng.randrange(4)
        if kind == 0:
            s = long[: rng.choice([3, 40, 40])] + [("assistant", "end " * rng.randrange(3))] * rng.randrange(3)
        elif kind == 1:
            s = [("user", "hi there"), ("assistant", "one two")]
        else:
            s = [(rng.choice(["user", ""]), rng.choice(["a", "b c", ""])) for _ in range(rng.randrange(1, 6))]
        out.append((rng.choice([-1, 1]) * (c * 7 + 1), s))
    return out


@pytest.mark.parametrize("limits", [(1, 1 << 20), (3, 1 << 20), (50, 400), (2048, 1 << 22)])
def test_nodes(spark, limits):
    conversations = made(limits[0])
    df = table(spark, [(c, [(i, *t) for i, t in enumerate(s)]) for c, s in conversations])
    assert found(prefix_trie(conversation_paths(df), *limits)) == plain(dict(conversations))


def test_many_copies(spark):
    """Thousands of copies are one path, and their ids one stream."""
    conversations = [(c, [("user", "same turn"), ("assistant", "same answer")]) for c in range(-3000, 3000)]
    conversations += [(9000, [("user", "same turn")])]
    df = table(spark, [(c, [(i, *t) for i, t in enumerate(s)]) for c, s in conversations])
    assert found(prefix_trie(conversation_paths(df), 1)) == plain(dict(conversations))


def test_order_nulls_and_repeats(spark):
    """Null turns come first, null texts are empty, rows without a conversation go, repeated rows stay."""
    df = table(spark, [(5, [(2, "user", None), (None, None, "first"), (1, "user", "b")]), (None, [(0, "user", "x")]), (6, [(0, "u", "r"), (0, "u", "r")])])
    expected = {5: [("", "first"), ("user", "b"), ("user", "")], 6: [("u", "r"), ("u", "r")]}
    assert found(prefix_trie(conversation_paths(df))) == plain(expected)
    assert found(prefix_trie(conversation_paths(df.where("false")))) == []


@pytest.mark.parametrize("limit", [1, 2048])
def test_shared_beginnings(spark, limit):
    """Heads of another conversation: longer, shorter, absent, and conversations left without turns."""
    rng = random.Random(4)
    conversations = [(c, [("user", f"{c % 3} {i}") for i in range(rng.randrange(1, 6))]) for c in range(130) if c not in (40, 60)]
    own = dict(conversations)
    rebuilt = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + s[h:]
    assert any(not s for s in rebuilt.values())
    df = table(spark, [(c, [(i, *t) for i, t in enumerate(s)]) for c, s in conversations])
    paths = conversation_paths(df, F.col("conv_id") - F.col("conv_id") % 20, F.crc32(F.col("conv_id").cast("string")) % 4)
    assert found(prefix_trie(paths, limit)) == plain(rebuilt)


def test_long_text_and_conversation(spark):
    s = [("user", "word " * 200_000), *[("user", str(i)) for i in range(400)]]
    df = table(spark, [(c, [(i, *t) for i, t in enumerate(s[: 401 - c])]) for c in (0, 1)], 2)
    assert found(prefix_trie(conversation_paths(df), 1)) == plain({0: s, 1: s[:400]})


def test_query_without_rows(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert op12_prefix_trie(spark, str(tmp_path)).count() == 0
