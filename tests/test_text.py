"""Extraction from text: planted positions come back, and nothing else."""

import random

import pytest

from checks import tables as T
from poseval.operators import text as X
from poseval.sources import readers as R

# Words that no position or key header can contain or be completed by.
FILLER = ["lorem", "12x", "e9", "KK", "4k3/8/8/8/8/8/8", "4k3/8/8/8/8/8/8/4K4", "x4k3/8/8/8/8/8/8/4K3", "zobr64:7", "w/b"]
GAPS = [" ", "\n", "\t ", "  "]
KEYS = [0, 7, 2**63, 2**64 - 1]
# Literal inputs and what they hold.
CASES = [
    ("zobr64: 18446744073709551616 " + T.CORPUS[20], [(None, T.CORPUS[20])]),
    ("zobr64: 4 zobr64: zobr64: +7 " + T.CORPUS[20], [(7, T.CORPUS[20])]),
    ("zobr64: 0000000000000000000000000000000000000000009 " + T.CORPUS[24], [(9, T.CORPUS[24])]),
    ("4k3/8/8/8/8/8/8/4K3 w KK -", []),
    ("4k3/8/8/8/8/8/8/4K3 w kQ - 3 x", [(None, "4k3/8/8/8/8/8/8/4K3 w kQ -")]),
    ("4k3/8/8/8/8/8/8/4K3 b - e3\t3\n4 5", [(None, "4k3/8/8/8/8/8/8/4K3 b - e3 3 4")]),
    ("4k3/8/8/8/8/8/8/4K3 w - e9", []),
    ("4k3/8/8/8/8/8/8/4K3", []),
    ("", []),
]


def extract(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = X.extract_positions(table).orderBy("doc_id", "piece", "nth").collect()
    out = [[] for _ in texts]
    for r in rows:
        out[r["doc_id"]].append((None if r["zobr64"] is None else int(r["zobr64"]), r["fen"]))
    return out


def planted(rnd):
    """A text made of positions, headers and filler, and the positions with their keys."""
    words, found, key = [], [], None
    for _ in range(rnd.randint(0, 12)):
        kind = rnd.random()
        if kind < 0.2:
            key = rnd.choice(KEYS)
            words.append("zobr64:" + rnd.choice(GAPS) + rnd.choice(["", "+", "00"]) + str(key))
        elif kind < 0.6:
            fen = rnd.choice(T.CORPUS[:33])
            clocks = rnd.choice(["", " 0 1", " 12 40"])
            words.append((fen + clocks).replace(" ", rnd.choice(GAPS)))
            found.append((key, fen + clocks))
        words.append(rnd.choice(FILLER))
    return rnd.choice(GAPS).join(words), found


def test_planted_positions_come_back(spark):
    rnd = random.Random(12)
    made = [planted(rnd) for _ in range(400)] + CASES
    assert extract(spark, [t for t, _ in made]) == [f for _, f in made]


def test_recorded_dump_gives_its_groups(spark):
    lines, position = [], 0
    for key, n in T.COLLISION_KEYS:
        lines.append(f"zobr64: {key} (rows={n}, unique_fens={n})")
        lines += T.CORPUS[position : position + n] + [""]
        position += n
    table = spark.createDataFrame([(1, "\n".join(lines))], "doc_id int, text string")
    groups = X.group_positions(table).orderBy("group_no").collect()
    assert [(int(g["zobr64"]), g["n_fens"]) for g in groups] == T.COLLISION_KEYS
    assert [f for g in groups for f in g["fens"]] == T.CORPUS[:33]
    totals = X.extraction_totals(table).first()
    assert (totals["fens"], totals["groups"]) == (33, 8)


def test_copies_stay_in_their_group(spark):
    fen = T.CORPUS[20]
    table = spark.createDataFrame([(1, f"{fen} zobr64: 3 {fen} {fen} zobr64: 4 {fen} zobr64: 3 {fen}")], "doc_id int, text string")
    groups = X.group_positions(table).orderBy("group_no").collect()
    assert [(g["zobr64"], g["n_fens"]) for g in groups] == [(None, 1), (3, 3), (4, 1)]


def test_extraction_does_not_shuffle(spark):
    table = spark.createDataFrame([(1, "x")], "doc_id int, text string")
    plan = X.diagnose_text(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def from_files(spark, path):
    found = X.positions_of_lines(R.read_text_lines(spark, path))
    out = {}
    for r in found.orderBy("file", "block", "chunk", "nth").collect():
        out.setdefault(r.file.rsplit("/", 1)[1], []).append((None if r.zobr64 is None else int(r.zobr64), r.fen))
    return out


@pytest.mark.parametrize("split, chunk", [("64", 1), ("300", 40), ("128m", 1 << 16)])
def test_files_read_in_splits(spark, tmp_path, monkeypatch, split, chunk):
    """Positions and headers across lines, chunks and splits equal those of the whole text."""
    monkeypatch.setattr(X, "CHUNK", chunk)
    rnd = random.Random(int(split.rstrip("m")))
    texts = {"case.txt": " x ".join(t for t, _ in CASES), "empty.txt": "", "blank.txt": "\n \n\n"}
    for i in range(3):
        parts = [planted(rnd)[0] for _ in range(5)]
        # A header, nothing for a while, and then a position with a word to each line.
        parts.insert(5, "zobr64: 77" + "\n" * 12 + "\n".join(T.CORPUS[20].split()) + "\n" * 8 + "\n".join(T.CORPUS[24].split(" ")) + "\n1\n2\n")
        texts[f"t{i}.txt"] = "\n".join(parts)
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    want = {name: found for name, found in zip(texts, extract(spark, list(texts.values()))) if found}
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert from_files(spark, str(tmp_path)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
