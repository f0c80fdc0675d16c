"""Tables derived from the given ones, in SQL that both engines run.

``{name}`` marks a table, ``{wide}`` a type that holds 20-digit products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The smallest given tables, for tests.
SMALL = "/root/testdata/sf0.001"

# The position corpus. 33 positions found under eight shared
# keys, then 14 edge cases: castling letters, side, ranks, fields, en passant.
_START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR"
_KINGS = "4k3/8/8/8/8/8/8/4K3"
COLLISION_KEYS = [
    (1469630302202025903, 2),
    (4889619998807747278, 2),
    (5060803636482931868, 18),
    (9384546495678726550, 3),
    (13185648422126966659, 2),
    (13512721484911620885, 2),
    (13757846718353144213, 2),
    (17487811229332759529, 2),
]
CORPUS = [
    "rnbq1bnr/ppp1pppp/8/1k6/2PpP3/8/PP1P1PPP/RNBQKBNR b KQ -",
    "rnbq1bnr/ppp1pppp/8/1k6/2PpP3/8/PP1P1PPP/RNBQKBNR b KQ e3",
    "k7/8/8/2npP3/4K3/8/8/8 w - -",
    "k7/8/8/2npP3/4K3/8/8/8 w - d6",
    "1K2Q3/1B1qR2p/rPR1B1PR/P2p2pr/5R2/Nrp1P3/3b4/N3k3 w - -",
    "1N1R4/2KPP1p1/pB2n3/2p4n/2Bppn2/k2p1n2/3q1R2/b2Q4 w - -",
    "1NR3nb/6B1/2pq2p1/2R4B/2Q5/2N5/1Kb3r1/2n3k1 w - -",
    "1k2n3/n5qq/p7/1rR3Br/KNB2P2/bp2r2Q/1q1Qp3/2n5 w - -",
    "2N2Q2/b7/q2rkn1N/8/1QR1K3/1B2np2/8/7r w - -",
    "4K2B/2N5/1P3b2/qn2RnBn/7b/Rn2p3/Nn4Q1/k7 w - -",
    "5QBQ/R7/N2n4/P4K2/2pq1R2/P1kb2B1/4b2n/3r4 w - -",
    "5RQ1/N1pq2bN/K5k1/1n4B1/BqN4Q/r2nBRq1/Rp2qnQ1/1n6 w - -",
    "6r1/b1p1kB2/Np6/np3K2/RNrR4/3q2NP/4P1nN/1rN1q3 w - -",
    "7B/Q1pq1Rb1/P2R2P1/1p1P4/2p3p1/RQ2K2k/qrQ4n/2n1b1B1 w - -",
    "7N/b2nB1nk/2pK4/1BQP1p2/3r1r2/R1RN2p1/1bb5/8 b - -",
    "8/1b2K3/q3NP2/1BQ1r1NB/3q4/NRNn3p/1q2npPk/3B4 w - -",
    "8/3B1q2/3K1k2/1Pn2P2/5nR1/1q2Qq2/2NRr2B/q3R3 w - -",
    "q2N4/3ppRKn/p2p1n2/2bP4/7r/np1pb2P/Nr2BP1k/2b1N3 w - -",
    "q2k1q1r/5R2/p1bp1n2/R1p2P2/7r/np2br2/5Pn1/1B2N1K1 w - -",
    "r1n1r3/r5n1/3q2P1/k2qP1p1/3P3P/2NK1b1n/1p1Q2Q1/2Bqb2N w - -",
    "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq -",
    "rr1qBRb1/4qqN1/2p3Bp/Pn2RQR1/3Bp2K/k4Nn1/pnQq1Qp1/4B3 w - -",
    "3Nn2R/BK1Q4/R5QQ/R1B2b2/r1k1P2p/1bqR4/1bB4P/2Nq1bb1 b - -",
    "4b1QQ/rq1RQ1b1/p4r2/Q2B1pkp/1pNrP1rb/R7/2B5/K1n4Q b - -",
    "rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq -",
    "1q6/N2KQ2Q/1B1NQ1r1/2Bq2n1/5Nb1/3P2R1/1B1kbQ2/1r1B4 b - -",
    "8/k5B1/2Q1Qp1p/3PQ1NK/N1PRrr2/p1pn2R1/Nq2Pp2/6r1 b - -",
    "4K2B/2N5/1P3b2/qn2RnBn/7b/Rn2p1Q1/Nn6/k7 b - -",
    "4q3/1K1Q1b2/3p3Q/R4B2/2k4p/2NR1QQq/1bB4N/1b1q1b2 b - -",
    "7N/b2nB1nk/2pK4/1BQP1p2/3r1r2/R1RN2p1/1bb5/8 w - -",
    "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR b KQkq -",
    "1k2n3/n5qq/p7/1rR3Br/KNBQ1P2/bp2r2Q/1q2p3/2n5 b - -",
    "1k5n/1p4rP/B4pn1/BR4p1/1pQQN1R1/4q1rb/n1N2BQ1/7K b - -",
    f"{_START} w HAha -",
    f"{_START} w KQkx -",
    f"{_START} w K- -",
    f"{_START} w KQ -",
    f"{_KINGS} x - -",
    "4k3/8/8/8/8/8/4K3 w - -",
    "4k3/9/8/8/8/8/8/4K3 w - -",
    "4k3/8/8/8/8/8/8/4KX2 w - -",
    f"{_KINGS} w",
    f"{_KINGS} w KQ -",
    "4k3/8/8/3pP3/8/8/8/4K3 w - d6",
    "4k3/8/8/3pP3/8/8/8/4K3 w - -",
    f"{_KINGS} w - z9",
    "8/8/8/8/8/8/8/4K3 w - -",
]

CORPUS_SQL = "SELECT * FROM (VALUES {}) AS corpus(pos_id, fen)".format(
    ", ".join(f"({i}, '{fen}')" for i, fen in enumerate(CORPUS))
)

_KEY = (
    "CAST((CAST(floor({row}/8) AS DECIMAL(18,0)) * CAST('11400714819323198485' AS {{wide}}))"
    " % CAST('18446744073709551616' AS {{wide}}) AS DECIMAL(20,0))"
)

# About eight rows per key; keys cover the whole unsigned range.
KEYED_SQL = f"""
SELECT o.o_orderkey AS row_id, c.fen, {_KEY.format(row="o.o_orderkey")} AS zobr64
FROM {{orders}} o JOIN {{corpus}} c ON c.pos_id = o.o_custkey % 47
"""

# One evaluation entry per order line.
ENTRIES_SQL = """
SELECT l_orderkey AS row_id, l_linenumber, l_partkey, l_suppkey,
       l_partkey AS knodes,
       CAST(l_linenumber * 5 + l_partkey % 3 AS BIGINT) AS depth,
       (l_suppkey % 10 = 0) AS empty_pvs,
       CASE WHEN l_returnflag <> 'A' THEN CAST(floor(l_extendedprice) AS BIGINT) - 50000 END AS cp,
       CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) - 25 END AS mate,
       CASE l_partkey % 4 WHEN 0 THEN 'e2e4 e7e5' WHEN 1 THEN 'e7e8q' WHEN 2 THEN '' ELSE '0000' END AS line
FROM {lineitem}
"""

# Rows in the simplified layout with every kind of encoding failure.
FLAT_SQL = f"""
SELECT l.l_orderkey AS row_id, l.l_linenumber AS line_no, l.l_partkey AS part, l.l_suppkey AS supp,
       {_KEY.format(row="l.l_orderkey")} AS zobr64,
       CASE WHEN l.l_returnflag <> 'A' AND l.l_suppkey % 17 <> 0
            THEN CAST(floor(l.l_extendedprice) AS INT) - 50000 END AS eval,
       CASE WHEN l.l_returnflag = 'A' AND l.l_suppkey % 17 <> 0
            THEN CAST(l.l_quantity AS INT) - 25 END AS mate,
       CAST(l.l_quantity * 7 - 20 AS INT) AS depth,
       c.fen,
       CASE l.l_partkey % 9 WHEN 0 THEN 'e2e4' WHEN 1 THEN 'e7e8q' WHEN 2 THEN 'a7a8N' WHEN 4 THEN '0000'
            WHEN 5 THEN 'e2e9' WHEN 6 THEN 'e2e4x' WHEN 7 THEN 'O-O' WHEN 8 THEN 'h2h1B' END AS first_move
FROM {{lineitem}} l JOIN {{corpus}} c ON c.pos_id = (l.l_partkey + l.l_linenumber) % 47
"""

# One made-up position per order: thousands of different boards with checks,
# pins on the en-passant capture, impossible rights and malformed fields.
_MIDDLE = "8|pppppppp|PPPPPPPP|3pP3|2pPp3|4P3|3p4|1n4N1|2b2B2|r6R|3q4|4Q3|8|8|5Pp1|pP4P1"


def _pick(values: str, shift: int) -> str:
    n = values.count("|") + 1
    return f"split_part('{values}', '|', CAST((h >> {shift}) % {n} + 1 AS INT))"


_TOP = "r3k2r|4k3|r3k3|4k2r|2k4r|rnbqkbnr|k7|4k3"
_BOTTOM = "R3K2R|4K3|R3K3|4K2R|1K5R|RNBQKBNR|7K|4K3"
_CASTLING = "-|KQkq|K|Qk|HAha|Kq|KQ|kq|-|-|B|x"
POSITIONS_SQL = f"""
SELECT row_id,
       CASE WHEN instr(body, 'k') > 0 AND h % 29 <> 0 THEN 'r6r' ELSE top END || '/' || body || '/' ||
       CASE WHEN instr(body, 'K') > 0 AND h % 31 <> 0 THEN 'R6R' ELSE bottom END ||
       ' ' || side || ' ' || castling || tail AS fen
FROM (
  SELECT row_id, h, {_pick(_TOP, 3)} AS top, {_pick(_BOTTOM, 24)} AS bottom, {_pick(_CASTLING, 17)} AS castling,
         CASE kind WHEN 0 THEN 'w' WHEN 1 THEN 'b' ELSE {_pick("w|b|w|b|w|b|c", 13)} END AS side,
         CASE kind WHEN 0 THEN {_pick(" d6| d6| e6| d3", 27)} WHEN 1 THEN {_pick(" e3| e3| d3| -", 27)}
                   ELSE {_pick(" -| -| -| e3| f6| z9| - 0 1| - 0 x||", 20)} END AS tail,
         CASE kind
           WHEN 0 THEN '8/' || {_pick("8|4k3|1q4K1|8|3r4", 7)} || '/' || {_pick("3pP3|K2pP2q|2KPp2r|k2pPP2|3pP2R", 11)}
                       || '/8/' || {_pick(_MIDDLE, 15)} || '/8'
           WHEN 1 THEN '8/' || {_pick(_MIDDLE, 7)} || '/8/' || {_pick("3pP3|k2pP2Q|2kPp2R|3PpP1K|3pP2r", 11)}
                       || '/' || {_pick("8|8|1Q4k1|3R4", 15)} || '/8'
           ELSE {_pick(_MIDDLE, 6)} || '/' || {_pick(_MIDDLE, 9)} || '/' || {_pick(_MIDDLE, 12)} || '/' ||
                {_pick(_MIDDLE, 15)} || '/' || {_pick(_MIDDLE, 18)} || '/' || {_pick(_MIDDLE, 21)}
         END AS body
  FROM (SELECT o_orderkey AS row_id, o_orderkey % 3 AS kind,
               o_orderkey * 48271 + CAST(floor(o_totalprice * 100) AS BIGINT) * 69621 AS h
        FROM {{orders}}) t
) u
"""

# Texts with planted key headers and positions.
DOCS_SQL = """
SELECT d.doc_id,
       CASE d.doc_id % 5
         WHEN 0 THEN d.text || ' zobr64: ' || CAST(d.doc_id AS {text}) || ' ' || a.fen || ' 0 1 junk ' || b.fen
         WHEN 1 THEN 'zobr64: 18446744073709551616 ' || a.fen || chr(10) || 'zobr64: zobr64: +7' || chr(9) || b.fen
                     || ' 12 x' || chr(10) || d.text || ' ' || a.fen || '  3' || chr(10) || '4 ' || b.fen
         WHEN 2 THEN d.text || ' zobr64: 0018446744073709551615 x' || a.fen || ' ' || b.fen || ' zobr64: 5 ' || a.fen
                     || ' zobr64: 0018446744073709551615 ' || a.fen
         ELSE d.text
       END AS text
FROM {documents} d JOIN {corpus} a ON a.pos_id = d.doc_id % 47 JOIN {corpus} b ON b.pos_id = (d.doc_id * 7) % 47
"""

SPARK_TYPES = {"wide": "DECIMAL(38,0)", "text": "STRING"}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _derive(spark: SparkSession, folder: str, sql: str, *tables: str) -> DataFrame:
    """Run shared SQL with the tables it names."""
    frames = {t: spark.sql(CORPUS_SQL) if t == "corpus" else load(spark, folder, t) for t in tables}
    text = sql.format(**SPARK_TYPES, **{t: f"{{{t}}}" for t in tables})
    return spark.sql(text, **frames)


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(spark, folder, KEYED_SQL, "orders", "corpus")


def entries(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(spark, folder, ENTRIES_SQL, "lineitem")


def flat_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(spark, folder, FLAT_SQL, "lineitem", "corpus")


def positions(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(spark, folder, POSITIONS_SQL, "orders")


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return _derive(spark, folder, DOCS_SQL, "documents", "corpus")


def eval_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``(row_id, fen, zobr64, evals)``: the nested input, keyed."""
    nested = spark.sql(
        """
        SELECT row_id, transform(sort_array(collect_list(struct(l_linenumber, l_partkey, l_suppkey,
                 named_struct('knodes', knodes, 'depth', depth,
                              'pvs', IF(empty_pvs, array(), array(struct(cp, mate, line)))) AS e))), x -> x.e) AS evals
        FROM {e} GROUP BY row_id
        """,
        e=entries(spark, folder),
    )
    rows = keyed(spark, folder)
    return spark.sql(
        "SELECT row_id, fen, zobr64, coalesce(evals, array()) AS evals FROM {k} LEFT JOIN {n} USING (row_id)",
        k=rows,
        n=nested,
    )
