"""Token files: exact round trips through grammars, and ids equal to the tokenizer's own."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from poseval.llm import repair, token_files
from poseval.llm.bytewords import ByteTokenizer
from poseval.llm.queries import op13_token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "",
    " ",
    "  two  blanks  ",
    "a\n b \n\nc",
    "tail ",
    "\n",
    " \n x",
    "it's 'tis don't 'S we'll'd",
    "x y z w",
    "a\x1cb c\x1f d",
    "a\x85b",
    "café, über; naïve... (1,234.5) 日本語",
    "<|endoftext|> is text",
    "\tcol\tcol  \t end",
    "é ́x ​z ﻿q",
    "word" * 500,
    "..., !? — …",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers(plain, spark):
    rng = random.Random(5)
    parts = ["a", "Word", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "é", "İ", "9", " ", "\r\n", "\x0b", " ", "-"]
    texts = ODD + ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text]
    ours = ByteTokenizer(FILE)
    for text in texts:
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == plain(text), text[:80]


def grammars():
    rng = np.random.default_rng(6)
    yield np.zeros(0, np.int64)
    yield np.array([7])
    yield np.full(1000, 3)
    yield np.arange(500)
    yield np.tile([5, 9, 5, 5, 50_256], 900)
    yield rng.integers(0, 6, 20_000)
    yield (rng.zipf(1.3, 30_000) % 50_257).astype(np.int64)
    yield np.concatenate([rng.integers(0, 50_000, 70_000), np.tile(rng.integers(0, 90, 40), 60)])


@pytest.mark.parametrize("ids", list(grammars()), ids=range(8))
def test_grammar_round_trip(ids):
    g = repair.compress(ids)
    width = repair.symbol_width(g)
    stored = g._replace(sequence=repair.unpack(repair.pack(g.sequence, width), width))
    assert repair.expand(stored).tolist() == ids.tolist()
    # Every rule expands to what its length says.
    lengths = np.concatenate([np.ones(len(g.alphabet), int), g.lengths])
    assert (lengths[g.rules].sum(axis=1) == g.lengths).all()
    rng = random.Random(len(ids))
    for _ in range(40):
        start, length = rng.randrange(len(ids) + 2), rng.choice([0, 1, 5, 700, 10**6])
        assert repair.expand_range(g, start, length).tolist() == ids[start : start + length].tolist()


def test_grammar_is_small():
    """Repeats leave little, and no pair worth a rule stays behind in them."""
    phrase = np.arange(64)
    g = repair.compress(np.tile(phrase, 512))
    assert len(g.sequence) + 2 * len(g.rules) < 400
    assert len(repair.compress(np.full(1 << 16, 1)).sequence) < 600


def expected(rows, plain):
    out, start = [], 0
    for doc_id, text in rows:
        ids = plain(text or "") + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def read(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("block", [1, 40, 1 << 19])
def test_files(spark, docs_of, plain, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", block)
    monkeypatch.setattr(token_files, "ROWS_PER_SHARD", 9)
    texts = ODD + [None, "long " * 3000, "same", "same"]
    rows = [(i * 3 - 10, t) for i, t in enumerate(texts)]
    docs = docs_of(rows).selectExpr("*", "1 AS shard", "'x' AS ids", "2 AS _hash", "3 AS start")
    token_files.write_token_files(docs, FILE, f"{tmp_path}/f")
    assert read(token_files.read_documents(spark, f"{tmp_path}/f")) == expected(rows, plain)
    stream = [i for _, t in rows for i in plain(t or "") + [0]]
    for start, length in ((0, 1), (17, 200), (len(stream) - 5, 50), (len(stream), 3), (100, 4000)):
        parts = sorted(token_files.read_tokens(spark, f"{tmp_path}/f", start, length).collect())
        assert [i for p in parts for i in np.frombuffer(bytes(p.ids), "<u4").tolist()] == stream[start : start + length]


def test_ties_and_null_ids(spark, docs_of, plain, tmp_path):
    docs = docs_of([(1, "b"), (None, "n"), (1, "b"), (1, "a"), (None, None), (0, "z")])
    token_files.write_token_files(docs, FILE, f"{tmp_path}/f")
    got = read(token_files.read_documents(spark, f"{tmp_path}/f"))
    assert [g[0] for g in got] == [None, None, 0, 1, 1, 1]
    assert got[-1][1] + got[-1][2] == sum(len(plain(t)) + 1 for t in ("b", "n", "b", "a", "", "z"))
    crc = lambda t: zlib.crc32(np.array(plain(t) + [0], "<u4").tobytes())
    assert sorted(g[3] for g in got[3:]) == sorted(map(crc, "abb"))


def test_empty_table(spark, docs_of, tmp_path):
    token_files.write_token_files(docs_of([(1, "a")]).where("false"), FILE, f"{tmp_path}/f")
    out = token_files.read_documents(spark, f"{tmp_path}/f")
    assert out.count() == 0 and out.columns == ["doc_id", "start", "n_tokens", "ids"]
    assert token_files.read_tokens(spark, f"{tmp_path}/f", 0, 10).count() == 0


def test_query(spark, plain):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    got = sorted((tuple(r) for r in op13_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert got == expected(rows, plain)
