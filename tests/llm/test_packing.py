"""Every token in one piece, sequences gapless and full, limits kept."""

from __future__ import annotations

import collections
import random

import numpy as np
import public_tokenizers
import pytest
from poseval.llm.packing import Example, Limits, Packer, pack_documents
from poseval.llm.wordpieces import WordTokenizer
from tokenizers import Tokenizer

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["don't we'll", "ΣΑΣ Σ", "İstanbul", "été", "a1b22", "x<|endoftext|>y", "ß!! ***a***", " wide gap", "it's_fine's", "日本語 テスト", "😀!a", "ª º²", "it'S", "a\x1cb \x1f c", "a\x85b\xa0c"]


def test_words_match_the_tokenizer():
    plain = Tokenizer.from_file(FILE)
    plain.encode_special_tokens = True
    quick = WordTokenizer(FILE)
    rnd = random.Random(3)
    letters = "abcABCéÉßñ.,!?'|*%09 \n\tΣσ"
    made = ["".join(rnd.choice(letters) for _ in range(40)) for _ in range(300)]
    for text in [*ODD, *made, ""]:
        assert np.frombuffer(quick.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def padded(n: int) -> int:
    return 0 if n & (n - 1) == 0 else 2048 - n


@pytest.mark.parametrize("limits", [Limits(16, 4, 16), Limits(16, 2, 7), Limits(1, 1, 1), Limits(64, 64, 3)])
def test_packer_keeps_limits(limits):
    rnd = random.Random(5)
    packer, made = Packer(limits), []
    sizes = [rnd.choice([1, 1, 2, 5, 16, 40]) for _ in range(200)]
    starts = [rnd.choice([0, 0, 3, 100]) for _ in sizes]
    for k, (n, loss_from) in enumerate(zip(sizes, starts)):
        packer.add(Example(k, b"", 0, n, n, loss_from))
        if k % 50 == 0:
            made += packer.drain()
    made += packer.drain(last=True)
    covered = collections.defaultdict(list)
    for sequence in made:
        used = sum(n for _, n in sequence)
        assert used & (used - 1) == 0 or used == limits.tokens
        assert used <= limits.tokens and len(sequence) <= limits.segments
        assert sum(e.loss(e.start, e.start + n) for e, n in sequence) <= limits.loss_tokens
        for e, n in sequence:
            assert n > 0
            covered[e.doc_id] += range(e.start, e.start + n)
    assert {k: sorted(v) for k, v in covered.items()} == {k: list(range(n)) for k, n in enumerate(sizes)}


def test_documents_round_trip(docs_of):
    rnd = random.Random(1)
    words = ["alpha", "Beta,", "gamma!!", "del", "2024", "É"]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 30, 300, 9000])))) for k in range(60)]
    rows += [(100, None), (None, "no id"), (7, rows[7][1]), (101, "")]
    got = pack_documents(docs_of(rows), FILE).collect()
    plain = Tokenizer.from_file(FILE)
    want = collections.Counter((i, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in rows)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length
    for (i, ids), copies in want.items():
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert all(p.doc_tokens == len(ids) for p in pieces)
        tokens = collections.Counter()
        for p in pieces:
            for k, t in enumerate(np.frombuffer(p.ids, "<u4").tolist()):
                assert ids[p.start + k] == t
                tokens[p.start + k] += 1
        assert tokens == {k: copies for k in range(len(ids))}
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at <= 2048 and padded(at) == 0


def test_empty_table_and_clashing_columns(spark, docs_of):
    assert pack_documents(docs_of([(1, "a")]).where("doc_id < 0"), FILE).collect() == []
    named = docs_of([(1, "a b c")]).selectExpr("*", "1 AS ids", "2 AS start", "1 AS from_token")
    assert [r.length for r in pack_documents(named, FILE, loss_from="from_token").collect()] == [4]
