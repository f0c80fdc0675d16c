"""Best entry, reduce, key/value encoding; ties, limits and hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from checks import tables as T
from checks.tables import SMALL
from poseval.operators import kv as K
from poseval.operators import quality as Q
from poseval.operators import simplify as S
from poseval.schema import EVAL_SCHEMA, read_simplified

START = T.CORPUS[20]


def nested(spark, *evals, fen=START):
    rows = [(fen, list(e)) for e in evals]
    return spark.createDataFrame(rows, EVAL_SCHEMA)


def entry(depth, cp=None, mate=None, line="e2e4 e7e5", pvs=True):
    return (1, depth, [(cp, mate, line)] if pvs else [])


def test_first_of_equal_depths_wins(spark):
    best = S.best_eval(nested(spark, [entry(5, 1), entry(9, 2), entry(9, 3)])).first()
    assert (best["eval"], best["depth"], best["first_move"]) == (2, 9, "e2e4")


def test_last_of_equal_depths_wins_before_variations_count(spark):
    rows = nested(spark, [entry(9, 2), entry(9, 3)], [entry(9, 2), entry(9, pvs=False)])
    assert [r["eval"] for r in S.best_eval(rows, "last").collect()] == [3]


def test_entries_without_variation_or_depth_are_skipped(spark):
    rows = nested(spark, [entry(20, pvs=False), entry(None, 7), entry(3, 1)], [entry(9, pvs=False)], [])
    assert [(r["eval"], r["depth"]) for r in S.best_eval(rows).collect()] == [(1, 3)]
    counters = Q.job_metrics(rows).first()
    assert (counters["input_rows"], counters["skipped_without_eval"]) == (3, 2)


def test_value_outside_int_stops_the_job(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        S.best_eval(nested(spark, [entry(3, 2**40)])).collect()


def test_blank_line_has_no_move(spark):
    moves = [
        S.best_eval(nested(spark, [entry(3, 1, line=line)])).first()["first_move"]
        for line in ("", "   ", " e2e4 e7e5", "0000")
    ]
    assert moves == [None, None, "e2e4", "0000"]


def test_reduce_is_independent_of_partitioning(spark):
    rows = T.eval_rows(spark, SMALL)
    once = S.simplify_positions(rows, ["row_id"])
    again = S.simplify_positions(rows.repartition(13).sortWithinPartitions(F.desc("row_id")), ["row_id"])
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()


def test_reduce_is_idempotent(spark):
    once = S.simplify_positions(T.eval_rows(spark, SMALL), ["row_id"])
    pv = F.array(F.struct(F.col("eval").alias("cp"), "mate", F.coalesce("first_move", F.lit("")).alias("line")))
    back = once.select(
        "zobr64", "fen", F.array(F.struct(F.lit(1).alias("knodes"), "depth", pv.alias("pvs"))).alias("evals")
    )
    twice = S.simplify_positions(back)
    assert once.exceptAll(twice).isEmpty() and once.count() == twice.count()


def brute_reduce(rows):
    """Deepest row per (key, all but castling); the first wins ties."""
    kept = {}
    for key, fen, depth, score, ord in sorted(rows, key=lambda r: r[4]):
        board, side, _, ep = fen.split()
        old = kept.get((key, board, side, ep))
        if old is None or depth > old[2]:
            kept[(key, board, side, ep)] = (key, fen, depth, score)
    return sorted(kept.values())


def test_hot_key_reduces_like_brute_force(spark):
    """A third of the rows share one key and position; ties are everywhere."""
    rng = random.Random(5)
    rows = []
    for ord in range(3000):
        hot = ord % 3 == 0
        fen = START if hot else rng.choice(T.CORPUS[20:25] + [T.CORPUS[36]])
        rows.append((7 if hot else rng.randrange(40), fen, rng.randrange(6), rng.randrange(100), ord))
    table = spark.createDataFrame(rows, "key long, fen string, depth long, score long, ord long")
    line = F.lit("e2e4").alias("line")
    pv = F.array(F.struct(F.col("score").alias("cp"), F.lit(None).cast("long").alias("mate"), line))
    evals = F.array(F.struct(F.lit(1).alias("knodes"), "depth", pv.alias("pvs"))).alias("evals")
    nested_rows = table.select(F.col("key").cast("decimal(20,0)").alias("zobr64"), "fen", evals, "ord").repartition(8)
    out = S.simplify_positions(nested_rows, ["ord"]).collect()
    assert sorted((int(r["zobr64"]), r["fen"], r["depth"], r["eval"]) for r in out) == brute_reduce(rows)

    counters = S.upsert_metrics(nested_rows, "ord").first()
    seen, updated = {}, 0
    for key, _, depth, _, _ in rows:
        if depth > seen.get(key, -1):
            seen[key], updated = depth, updated + 1
    assert (counters["lines"], counters["updated_keys"]) == (3000, updated)
    assert counters["kept_existing_keys"] == 3000 - updated


def flat(spark, *rows):
    return spark.createDataFrame(
        [(k, e, m, d, f, mv) for k, e, m, d, f, mv in rows],
        "zobr64 long, eval int, mate int, depth int, fen string, first_move string",
    )


def test_start_position_bytes(spark):
    kv = K.kv_all_entries(flat(spark, (258, 35, None, 30, START, "e2e4"))).first()
    assert kv["k"].hex() == "0000000000000102"
    meta = 12 | 28 << 6
    # low nibble first: a1 = R = 4 and b1 = N = 2 make 0x24
    board = "24533642" + "11111111" + "00" * 16 + "77777777" + "8ab99ca8"
    assert kv["v"].hex() == "01" + "2300" + "1e" + meta.to_bytes(2, "little").hex() + board + "1e" + "ff"


def test_entries_clamp_and_flag(spark):
    kv = K.kv_all_entries(
        flat(
            spark,
            (1, 50000, None, 300, START, "e7e8Q"),
            (2, 9, -40000, -5, T.CORPUS[43], None),
        )
    )
    out = {int(r["zobr64"]): r for r in K.decode_kv(kv).collect()}
    assert (out[1]["score"], out[1]["kind"], out[1]["depth"], out[1]["promotion"]) == (32767, 0, 255, 4)
    assert (out[2]["score"], out[2]["kind"], out[2]["depth"], out[2]["from_square"]) == (-32768, 1, 0, 0)
    assert out[1]["fen"] == START and out[2]["fen"] == T.CORPUS[43]


def test_encode_errors_in_order(spark):
    rows = [
        (1, None, None, 1, "x", "bad"),
        (2, 1, None, 1, "x", "bad"),
        (3, 1, None, 1, "x", None),
        (4, 1, None, 1, T.CORPUS[33], "e2e4"),
        (5, 1, None, 1, T.CORPUS[35], "0000"),
        (6, 1, None, 1, START, "e2e4\n"),
        (7, 1, None, 1, START, "é2e4"),
        (8, 1, None, 1, START, ""),
        (9, 1, None, 1, START, "a1h8N"),
    ]
    out = {r["zobr64"]: (r["encode_error"], r["bad_letter"]) for r in K.with_encode_error(flat(spark, *rows)).collect()}
    assert out == {
        1: ("score", None),
        2: ("move", None),
        3: ("fields", None),
        4: ("castling", "H"),
        5: ("castling", "-"),
        6: ("move", None),
        7: ("move", None),
        8: ("move", None),
        9: (None, None),
    }


def test_no_letters_gives_the_dash_row(spark):
    rows = flat(spark, (1, 1, None, 1, START, None))
    assert [tuple(r) for r in Q.castling_letter_distribution(rows).collect()] == [("-", 0)]
    assert [tuple(r) for r in Q.castling_letter_distribution(rows.where("false")).collect()] == [("-", 0)]


def test_255_entries_fit_and_256_stop_the_job(spark):
    rows = spark.range(255).select(
        F.lit(3).cast("long").alias("zobr64"),
        F.col("id").cast("int").alias("eval"),
        F.lit(None).cast("int").alias("mate"),
        F.lit(1).alias("depth"),
        F.lit(START).alias("fen"),
        F.lit("e2e4").alias("first_move"),
        F.col("id").alias("ord"),
    )
    value = K.kv_all_entries(rows, ["ord"]).first()["v"]
    assert value[0] == 255 and len(value) == 1 + 255 * 39
    assert [r["score"] for r in K.decode_kv(K.kv_all_entries(rows, ["ord"])).orderBy("nth").collect()] == list(range(255))
    one_more = rows.unionByName(rows.where("ord = 0").withColumn("ord", F.lit(999).cast("long")))
    with pytest.raises(Exception, match="too many entries"):
        K.kv_all_entries(one_more, ["ord"]).collect()


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = K.kv_all_entries(T.flat_rows(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("256, Final") < plan.index("Exchange hashpartitioning(key64") < plan.index("256, Partial")


def test_required_fields(spark):
    good = nested(spark, [entry(3, 1)])
    assert Q.assert_required(good).count() == 1
    holes = nested(spark, [entry(None, 1)], [entry(3, 1, line=None)], [(None, 3, [])], [entry(3, 1)])
    assert [r["missing_field"] for r in Q.assert_required(holes, "split").collect()] == [True, True, True, False]
    with pytest.raises(Exception, match="required field missing"):
        Q.assert_required(holes).collect()
    with pytest.raises(ValueError, match="missing required columns"):
        Q.assert_required(good.drop("evals"))


def test_lenient_simplified_types(spark):
    table = spark.createDataFrame([(5, 1, None, 9, START, "e2e4")], "zobr64 long, eval long, mate long, depth long, fen string, move string")
    row = read_simplified(table).first()
    assert row.asDict() == {"zobr64": 5, "eval": 1, "mate": None, "depth": 9, "fen": START, "first_move": "e2e4"}
    assert read_simplified(table.drop("move")).first()["first_move"] is None
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        read_simplified(table.withColumn("depth", F.lit(2**40))).collect()


def test_sorted_table_divides_a_hot_value(spark):
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 15000).otherwise(F.col("id")).alias("v"), "id")
    for spread in (["id"], None):
        out = Q.global_sort(rows, "v", 9, spread).withColumn("p", F.spark_partition_id())
        hot = {r["p"]: r["count"] for r in out.where("v = 15000").groupBy("p").count().collect()}
        assert len(hot) >= 3 and sum(hot.values()) == 10000
        edges = out.groupBy("p").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("p").collect()
        assert all(a["hi"] <= b["lo"] for a, b in zip(edges, edges[1:]))


def test_sort_puts_nulls_first_and_rejects_unknown_columns(spark):
    rows = spark.createDataFrame([(3,), (None,), (1,)], "v int")
    assert [r["v"] for r in Q.global_sort(rows, "v", 1).collect()] == [None, 1, 3]
    with pytest.raises(ValueError):
        Q.global_sort(rows, "w", 1)
