"""Alignment against the plain recursion, and planted passages."""

from __future__ import annotations

import random

import numpy as np
import pytest
from poseval.llm import decontaminate as D


def plain_alignment(item, passage):
    h = np.zeros((len(item) + 1, len(passage) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a == b else -0.5), h[i - 1, j] - 0.5, h[i, j - 1] - 0.5)
    return h.max()


def test_alignment():
    rnd = random.Random(6)
    for _ in range(60):
        a = np.array([rnd.randint(1, 4) for _ in range(rnd.randint(1, 14))])
        b = np.array([rnd.randint(0, 4) for _ in range(rnd.randint(1, 30))])
        score, start, end = D.smith_waterman(a, b)
        assert score == plain_alignment(a, b)
        assert plain_alignment(a, b[start:end]) == score or score == 0
    assert D.smith_waterman(np.array([5, 6, 7]), np.array([1, 5, 6, 7, 1])) == (3.0, 1, 4)


@pytest.mark.parametrize("item_words", [60, 500_000])
def test_planted_passages(spark, docs_of, item_words):
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 60
    make = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [(k, " ".join(make(30))) for k in range(12)] + [(50, " ".join(make(600)))]
    rows, want = [], set()
    for k in range(120):
        body = make(rnd.randint(0, 300))
        if k % 3 == 0:
            i, text = items[k // 3 % 13]
            part = text.split()[:250]
            if k % 2:  # every eighth word is another, one is left out
                part = [("zz" if n % 8 == 4 else w) for n, w in enumerate(part) if n != 14]
            at = rnd.randint(0, len(body))
            body = body[:at] + [w.upper() + "," for w in part] + body[at:]
            want.add((k, i))
        rows.append((k, " ".join(body)))
    rows += [(None, items[0][1]), (500, None), (501, ""), (0, rows[0][1])]
    want.add((None, 0))
    tests = spark.createDataFrame([*items, (90, None), (91, ""), (92, "of the"), items[1], (None, "never seen here at all")], "item_id long, text string")
    table = docs_of(rows).selectExpr("*", "1 AS item_id", "2 AS score")
    got = D.contaminated(table, tests, item_words=item_words).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(0.5 <= r.score <= 1 and r.start_word < r.end_word for r in got)
    kept = D.drop_contaminated(table, tests)
    assert kept.columns == table.columns
    hit = {i for i, _ in want}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in hit)


def test_empty_tables(spark, docs_of):
    tests = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert D.contaminated(docs_of(["a b c d"]).where("false"), tests).collect() == []
    got = D.contaminated(docs_of(["a b c d"]), tests.where("false"))
    assert got.collect() == [] and got.columns == ["doc_id", "item_id", "score", "start_word", "end_word"]


def test_sole_edited_copies(spark, docs_of):
    """An item's only copy, every fifth word changed: all n-grams that no document has are rarer than its own."""
    rnd = random.Random(9)
    items = [(k, [f"w{rnd.randint(0, 3000)}" for _ in range(n)]) for k, n in enumerate((27, 39, 59))]
    rows = [(k, " ".join("zz" if n % 5 == 2 else w for n, w in enumerate(words))) for k, words in items]
    tests = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = D.contaminated(docs_of(rows), tests).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(0, 0), (1, 1), (2, 2)]
    assert D.drop_contaminated(docs_of(rows), tests).count() == 0


@pytest.mark.parametrize("min_score", [0.3, 0.5, 0.8])
def test_every_passage_that_scores_enough(spark, docs_of, min_score):
    """Few words and many edits: the same as aligning each item with each whole text."""
    rnd = random.Random(10)
    words = [f"w{k}" for k in range(40)] + ["the", "of"] * 8
    make = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [make(rnd.randint(3, 20)) for _ in range(8)]
    rows = []
    for k in range(60):
        part = []
        for w in rnd.choice(items):
            part += rnd.choice([[w]] * 6 + [["q"], [], [w, "q"]])
        rows.append((k, " ".join(make(rnd.randint(0, 30)) + part + make(rnd.randint(0, 30)))))
    own = D.Items([(k, " ".join(w).encode()) for k, w in enumerate(items)])
    want = {}
    for k, text in rows:
        for i, piece in zip(own.ids, own.pieces):
            score = D.smith_waterman(piece, own.numbers(text.encode()))[0] / len(piece)
            assert D.best_score(piece, own.numbers(text.encode())) == score * len(piece)
            if score >= min_score:
                want[k, i] = score
    tests = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = D.contaminated(docs_of(rows), tests, min_score).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == pytest.approx(want)


def test_pieces():
    for n in (0, 1, 99, 100, 101, 125, 126, 259, 600, 5000):
        starts = D.piece_starts(n)
        assert starts[0] == 0 and starts[-1] == max(n - D.PIECE, 0)
        assert all(0 < b - a <= D.STEP for a, b in zip(starts, starts[1:]))


def test_long_items(spark, docs_of):
    """Short rests of long items decide nothing; long excerpts count wherever they begin."""
    item = [f"w{k}" for k in range(259)]
    other = [f"x{k}" for k in range(80)]
    rows = [(0, other + item[-3:]), (1, other + item[-30:]), (2, item[:45] + other)]
    hits = [(10 + k, other + item[k : k + 100] + other) for k in range(0, 160, 13)]
    hits += [(200 + k, other + item[k : k + 75]) for k in range(0, 185, 13)]
    hits += [(400, ["zz" if n % 5 == 2 else w for n, w in enumerate(item[70:170])])]
    table = docs_of([(k, " ".join(w)) for k, w in rows + hits])
    tests = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in D.contaminated(table, tests).collect()} == {k for k, _ in hits}
    assert {r.doc_id for r in D.drop_contaminated(table, tests).collect()} == {0, 1, 2}
