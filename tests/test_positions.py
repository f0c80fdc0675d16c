"""Keys, rules and labels on known positions."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import tables as T
from checks.tables import SMALL
from poseval.functions import bitboard as B
from poseval.functions import hashing as H
from poseval.operators import analysis as A
from poseval.operators import positions as N
from poseval.schema import key64_column, key_bytes, to_key64, to_unsigned, unsigned_order


def rows_of(spark, *fens):
    return spark.createDataFrame([(i, f) for i, f in enumerate(fens)], "id int, fen string")


@pytest.fixture(scope="module")
def corpus_keys(corpus):
    keyed = N.with_position_key(corpus, on_error="null").collect()
    return {r["pos_id"]: r for r in keyed}


def test_all_collected_positions_can_be_built(corpus_keys):
    assert all(corpus_keys[i]["zobr64"] is not None for i in range(33))


def test_pairs_that_differ_in_an_illegal_capture_share_a_key(corpus_keys):
    assert corpus_keys[0]["zobr64"] == corpus_keys[1]["zobr64"]
    assert corpus_keys[2]["zobr64"] == corpus_keys[3]["zobr64"]
    assert corpus_keys[2]["zobr128"] == corpus_keys[3]["zobr128"]


def test_legal_capture_changes_the_key(corpus_keys):
    assert corpus_keys[43]["zobr64"] != corpus_keys[44]["zobr64"]


def test_rook_file_letters_equal_plain_letters(corpus_keys):
    assert corpus_keys[33]["zobr64"] == corpus_keys[20]["zobr64"]
    assert corpus_keys[36]["zobr64"] != corpus_keys[20]["zobr64"]
    assert corpus_keys[42]["zobr64"] == corpus_keys[41]["zobr64"]


def test_unusable_positions_name_their_error(corpus_keys):
    found = {i: corpus_keys[i]["position_error"] for i in range(33, 47) if corpus_keys[i]["position_error"]}
    assert found == {
        34: "syntax: castling",
        35: "syntax: castling",
        37: "syntax: side",
        38: "syntax: board",
        39: "syntax: board",
        40: "syntax: board",
        45: "syntax: ep",
        46: "position: kings",
    }


def test_distinct_positions_get_distinct_keys(corpus_keys):
    distinct = {corpus_keys[i]["zobr64"] for i in range(4, 33)}
    assert len(distinct) == 29


def test_key_is_first_half_of_long_key(corpus_keys):
    for row in corpus_keys.values():
        if row["zobr64"] is not None:
            assert int.from_bytes(row["zobr128"][:8], "big") == int(row["zobr64"])


def test_unbuildable_position_stops_the_job(spark):
    with pytest.raises(Exception, match="position: kings"):
        N.with_position_key(rows_of(spark, "8/8/8/8/8/8/8/4K3 w - -")).collect()


def test_both_engines_agree(spark):
    table = T.positions(spark, SMALL)
    arrow = N.with_position_key(table, on_error="null")
    plain = N.with_position_key(table, on_error="null", engine="expression")
    assert arrow.exceptAll(plain).isEmpty() and plain.exceptAll(arrow).isEmpty()


def test_supplied_constants_are_used(spark):
    pairs = [(s + 1, -s - 1) for s in range(H.SLOTS)]
    table = spark.createDataFrame([(s, hi, lo) for s, (hi, lo) in enumerate(pairs)], "slot int, hi long, lo long")
    assert H.constants_from_table(table) == pairs
    with pytest.raises(ValueError):
        H.constants_from_table(table.where("slot <> 5"))
    row = N.with_position_key(rows_of(spark, "4k3/8/8/8/8/8/8/4K3 w - -"), constants=pairs).first()
    # black king on e8, white king on e1, white to move
    want = (10 * 64 + 60 + 1) ^ (11 * 64 + 4 + 1) ^ (780 + 1)
    assert int(row["zobr64"]) == want


@pytest.mark.parametrize(
    "fen, attacked",
    [
        ("4k3/8/8/8/8/8/8/r3K3 w - -", True),
        ("4k3/8/8/8/8/8/8/rN2K3 w - -", False),
        ("4k3/8/8/8/8/8/3p4/4K3 w - -", True),
        ("4k3/8/8/8/8/8/4p3/4K3 w - -", False),
        ("4k3/8/8/8/8/5n2/8/4K3 w - -", True),
        ("4k3/8/8/8/7b/8/8/4K3 w - -", True),
        ("4k3/8/8/8/7b/6P1/8/4K3 w - -", False),
        ("4k3/3P4/8/8/8/8/8/4K3 b - -", True),
        ("4k3/8/8/8/8/8/8/4K2r w - -", True),
        ("7k/8/8/8/8/8/n7/7K w - -", False),
        ("k7/8/8/8/8/8/7n/K7 w - -", False),
        ("7k/8/8/8/8/7K/p7/8 w - -", False),
        ("4k3/8/8/8/8/8/8/q3K3 w - -", True),
    ],
)
def test_king_attacked(fen, attacked):
    board, side = fen.split()[:2]
    text = re.sub("[1-8]", lambda m: "." * int(m[0]), board)
    boards = B.Boards(B.codes_of(np.frombuffer(text.encode(), np.uint8)))
    assert B.King(boards, np.array([side == "w"])).attacked(boards.occupied).tolist() == [attacked]


@pytest.mark.parametrize(
    "fen, legal",
    [
        ("4k3/8/8/3pP3/8/8/8/4K3 w - d6", True),
        ("4k3/8/8/8/3pP3/8/8/4K3 b - e3", True),
        ("4k3/8/8/3pP3/8/8/8/4K3 w - e6", False),
        ("4k3/8/8/K2pP2r/8/8/8/8 w - d6", False),
        ("4k3/8/8/K1NpP2r/8/8/8/8 w - d6", True),
        ("4k3/8/8/P6p/8/8/8/4K3 w - h6", False),
        ("4k3/3p4/8/3pP3/8/8/8/4K3 w - d6", False),
        ("4r1k1/8/8/3pP3/8/8/8/4K3 w - d6", False),
        ("4k3/8/8/2PpP3/8/8/8/4K3 w - d6", True),
    ],
)
def test_legal_ep(spark, fen, legal):
    rows = N.with_legality(rows_of(spark, fen))
    assert rows.select(N.has(B.EP_LEGAL)).first()[0] is legal


def test_problem_labels(spark):
    start = T._START
    found = N.position_problems(
        rows_of(
            spark,
            f"{start} w KQkq -",
            f"{start} b KQkq -",
            f"{start} w HAha -",
            "4k3/8/8/8/8/8/8/4K3 w KQ -",
            "4k3/8/8/8/8/8/8/4K3 w KQ e6",
            "4k3/9/8/8/8/8/8/4K3 w - -",
            "8/8/8/8/8/8/8/4K3 w - -",
            "4k3/8/8/8/8/8/PPPPPPPP/RNBQKQQR w - -",
            "r2rk3/8/8/8/8/8/8/r3K2r w - -",
            "rnbq1bnr/ppp1pppp/8/1k6/2PpP3/8/PP1P1PPP/RNBQKBNR b KQ e3",
        )
    ).orderBy("id")
    castling, ep = N.PROBLEMS["no_castling"], N.PROBLEMS["no_ep"]
    assert [r["reported"] for r in found.collect()] == [
        ["OK"],
        [N.PROBLEMS["start"]],
        [castling],
        [N.PROBLEMS["castling"]],
        [N.PROBLEMS["ep"], castling, ep],
        [N.PROBLEMS["syntax"]],
        [N.PROBLEMS["position"]],
        [N.PROBLEMS["material"]],
        [N.PROBLEMS["check"]],
        [ep],
    ]
    both = found.where("id = 4").first()["problems"]
    assert both == [N.PROBLEMS["castling"], N.PROBLEMS["ep"], ep]


def test_fen_error_branches(corpus):
    found = {r["pos_id"]: r["fen_error"] for r in N.with_board64(corpus).collect()}
    assert {i: e for i, e in found.items() if e} == {
        33: "castling",
        34: "castling",
        35: "castling",
        37: "side",
        38: "board",
        39: "board",
        40: "board",
        41: "fields",
        45: "ep",
    }


def test_board64_starts_at_a1(corpus):
    row = N.with_board64(corpus).where("pos_id = 20").first()
    assert row["board64"][:16] == "RNBQKBNRPPPPPPPP" and row["board64"][-8:] == "rnbqkbnr"


def test_whitespace_of_any_kind_separates_fields(spark):
    row = N.with_fen_fields(rows_of(spark, "  4k3/8/8/8/8/8/8/4K3 w\tKQ \n -  ")).first()
    assert (row["n_fields"], row["side"], row["castling"], row["ep"]) == (4, "w", "KQ", "-")


def test_recorded_groups_keep_their_counts_and_kind(spark):
    position = 0
    rows = []
    for key, n in T.COLLISION_KEYS:
        rows += [(str(key), fen) for fen in T.CORPUS[position : position + n]]
        position += n
    table = spark.createDataFrame(rows, "k string, fen string").select(
        F.col("k").cast("decimal(20,0)").alias("zobr64"), "fen"
    )
    profile = A.collision_profile(table).orderBy("zobr64").collect()
    assert [(int(r["zobr64"]), r["rows"]) for r in profile] == T.COLLISION_KEYS
    assert {r["difference_type"] for r in profile} == {"other_fen_difference"}
    assert [r["ep_unique"] for r in profile[:2]] == [2, 2]
    only = spark.createDataFrame([(T.CORPUS[20],), (T.CORPUS[36],)], "fen string").withColumn(
        "zobr64", F.lit(7).cast("decimal(20,0)")
    )
    assert A.collision_summary(only).collect()[0]["difference_type"] == "castle_rights_only"


def test_unsigned_boundary(spark):
    values = ["0", "1", "9223372036854775807", "9223372036854775808", "18446744073709551615"]
    table = spark.createDataFrame([(v,) for v in values], "v string").select(F.col("v").cast("decimal(20,0)").alias("zobr64"))
    key = to_key64(F.col("zobr64"))
    out = table.select(
        "zobr64",
        to_unsigned(key).alias("back"),
        F.hex(key_bytes(key)).alias("bytes"),
        unsigned_order(key).alias("rank"),
    ).collect()
    assert [str(r["back"]) for r in out] == values
    assert [int(r["bytes"], 16) for r in out] == [int(v) for v in values]
    assert [r["rank"] for r in out] == sorted(r["rank"] for r in out)
    with pytest.raises(Exception, match="unsigned"):
        bad = spark.createDataFrame([(-1,)], "zobr64 long")
        bad.select(key64_column(bad)).collect()
