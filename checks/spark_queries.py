"""One query per operator, over whole derived tables.

Keys and binary values are rendered as text so both engines compare equal.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import tables as T
from poseval.functions import codec as C
from poseval.functions import evals as E
from poseval.functions import position as P
from poseval.operators import analysis as A
from poseval.operators import fileindex as FX
from poseval.operators import kv as K
from poseval.operators import ordinal as O
from poseval.operators import positions as N
from poseval.operators import quality as Q
from poseval.operators import runs as U
from poseval.operators import simplify as S
from poseval.operators import text as X
from poseval.plans import jobs as J
from poseval.schema import SCORE_SCHEMA, key64_column, key_bytes, to_unsigned
from poseval.session import new_folder, stage, staging
from poseval.sources import readers as R
from poseval.sources import sinks as W

ORD = ["row_id"]
LINE = ["row_id", "line_no", "part", "supp"]
# A key that exists at every scale: the rows 8 to 15.
LOOKUP = "11400714819323198485"
# Rows of a written file of compressed lines, and splits of a text, at most.
FILE_ROWS, SPLITS = 250_000, 256


def _key(name: str = "zobr64") -> Column:
    return F.col(name).cast("string").alias(name)


def _simplified(spark: SparkSession, folder: str) -> DataFrame:
    return S.simplify_positions(T.eval_rows(spark, folder), ORD)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return T.load(spark, folder, "orders").select("o_orderkey", "o_custkey")


def _fens_of(orders: DataFrame) -> DataFrame:
    """Corpus position of each order row."""
    spark = orders.sparkSession
    return orders.join(spark.sql(T.CORPUS_SQL), F.col("o_custkey") % 47 == F.col("pos_id"))


def _with_move(orders: DataFrame) -> DataFrame:
    """Order rows as encodable rows."""
    return _fens_of(orders).select(
        "*", F.lit(1).alias("eval"), F.lit(None).cast("int").alias("mate"), F.lit("e2e4").alias("first_move")
    )


def best_eval_first(spark, folder):
    return S.best_eval(T.eval_rows(spark, folder)).select("row_id", "eval", "mate", "depth", "first_move")


def best_eval_last(spark, folder):
    return S.best_eval(T.eval_rows(spark, folder), "last").select("row_id", "eval", "mate", "depth")


def first_token(spark, folder):
    lines = T.entries(spark, folder)
    return lines.select("row_id", "l_linenumber", "l_partkey", "l_suppkey", P.first_token(F.col("line")).alias("move"))


def fen_fields(spark, folder):
    return N.with_fen_fields(T.positions(spark, folder)).select("row_id", "n_fields", "board", "side", "castling", "ep")


def dedupe_key(spark, folder):
    rows = T.positions(spark, folder).withColumn("parts", P.tokens(F.col("fen")))
    return rows.select("row_id", P.dedupe_key(F.col("fen"), F.col("parts")).alias("dedupe_key"))


def board64(spark, folder):
    return N.with_board64(T.keyed(spark, folder)).select("row_id", "board64", "fen_error")


def simplify_positions(spark, folder):
    return _simplified(spark, folder).withColumn("zobr64", F.col("zobr64").cast("string"))


def latest_per_key(spark, folder):
    return S.latest_per_key(_simplified(spark, folder))


def deepest_per_key(spark, folder):
    kv = S.deepest_per_key(T.eval_rows(spark, folder), ORD)
    return kv.select(F.hex("k").alias("k"), "v")


def upsert_metrics(spark, folder):
    return S.upsert_metrics(T.eval_rows(spark, folder), "row_id")


def longest_depth_per_fen(spark, folder):
    return S.longest_depth_per_fen(T.eval_rows(spark, folder))


def row_longest_depth(spark, folder):
    return T.eval_rows(spark, folder).select("row_id", E.row_longest_depth(F.col("evals")).alias("row_longest_depth"))


def assert_required(spark, folder):
    return Q.assert_required(_with_gaps(spark, folder), "split").select("row_id", "missing_field")


def _with_gaps(spark, folder):
    """Rows whose entries lose their depth where the part number says so."""
    rows = T.eval_rows(spark, folder)
    holes = F.transform(
        "evals",
        lambda e: F.struct(
            e["knodes"].alias("knodes"),
            F.when(e["knodes"] % 7 != 0, e["depth"]).alias("depth"),
            F.when(e["knodes"] % 11 != 0, e["pvs"]).alias("pvs"),
        ),
    )
    return rows.withColumn("evals", holes)


def job_metrics(spark, folder):
    return Q.job_metrics(T.eval_rows(spark, folder))


def load_metrics(spark, folder):
    return Q.load_metrics(T.flat_rows(spark, folder))


def pack_move_meta(spark, folder):
    kind = C.score_kind(F.col("mate"))
    return T.flat_rows(spark, folder).select(*LINE, C.pack_move(F.col("first_move"), kind).alias("move_meta"))


def score_of(spark, folder):
    rows = T.flat_rows(spark, folder)
    return rows.select(
        *LINE,
        C.score_of(F.col("eval"), F.col("mate")).alias("score"),
        C.score_kind(F.col("mate")).alias("kind"),
        C.clamp_depth(F.col("depth")).alias("depth"),
    )


def encode_errors(spark, folder):
    return K.with_encode_error(T.flat_rows(spark, folder)).select(*LINE, "encode_error", "bad_letter")


def encode_entry(spark, folder):
    return K.with_entry(T.flat_rows(spark, folder)).select(*LINE, F.hex("entry").alias("entry"))


def kv_all_entries(spark, folder):
    kv = K.kv_all_entries(T.flat_rows(spark, folder), ["fen", *LINE])
    return kv.select(F.hex("k").alias("k"), F.hex("v").alias("v"))


def decode_kv(spark, folder):
    decoded = K.decode_kv(K.kv_all_entries(_simplified(spark, folder)))
    return decoded.withColumn("zobr64", F.col("zobr64").cast("string"))


def castling_letter_distribution(spark, folder):
    return Q.castling_letter_distribution(T.flat_rows(spark, folder))


def castling_distribution_by_decile(spark, folder):
    """Over a stored table of encodable rows in order number order."""
    path = _folder(spark, "encodable")
    rows = _with_move(_orders(spark, folder))
    rows.repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    return Q.castling_distribution_by_decile(R.read_table(spark, path))


def bad_castling_scan(spark, folder):
    head = _fens_of(O.head_percent(_orders(spark, folder), 25.0))
    return Q.bad_castling_scan(head).select("o_orderkey", "fen", "bad_letter")


def castling_possible(spark, folder):
    rows = N.with_legality(T.positions(spark, folder))
    possible = F.col("board_ok") & N.castling_possible()
    return rows.select("row_id", possible.alias("possible"))


def position_key(spark, folder):
    rows = N.with_position_key(T.positions(spark, folder), on_error="null")
    return rows.select("row_id", _key(), F.hex("zobr128").alias("zobr128"), "position_error")


def position_problems(spark, folder):
    rows = N.position_problems(T.positions(spark, folder))
    return rows.select(
        "row_id", F.array_join("problems", "; ").alias("problems"), F.array_join("reported", "; ").alias("reported")
    )


def _ordered(spark, folder):
    return T.keyed(spark, folder).withColumnRenamed("row_id", "ord")


def duplicate_keys(spark, folder):
    return A.duplicate_keys(_ordered(spark, folder), 100, "ord").select(_key(), "count", "first_idx")


def collision_profile(spark, folder):
    return A.collision_profile(_ordered(spark, folder)).withColumn("zobr64", _key())


def collision_fens(spark, folder):
    return A.collision_fens(_ordered(spark, folder)).withColumn("zobr64", _key())


def collision_summary(spark, folder):
    return A.collision_summary(_ordered(spark, folder))


def duplicate_summary(spark, folder):
    return A.duplicate_summary(_ordered(spark, folder))


def duplicated_keys(spark, folder):
    return A.duplicated_keys(_ordered(spark, folder)).select(_key(), "rows")


def duplicate_fens(spark, folder):
    return A.duplicate_fens(_ordered(spark, folder)).withColumn("zobr64", _key())


def rows_with_duplicate_key(spark, folder):
    table = stage(_simplified(spark, folder), "simplified")
    return A.rows_with_duplicate_key(table).select(_key(), "fen", "depth")


def lookup_latest(spark, folder):
    """A key above 2^63 - 1 in the stored table of bit patterns."""
    dst = _folder(spark, "latest")
    J.build_latest(spark, _simple_table(spark, folder), dst)
    return A.lookup_key(R.read_table(spark, dst), LOOKUP)


def lookup_key(spark, folder):
    return A.lookup_key(T.keyed(spark, folder), LOOKUP).select("row_id", _key(), "fen")


def row_ordinal(spark, folder):
    return O.with_row_ordinal(_orders(spark, folder)).select("o_orderkey", "ord")


def row_count(spark, folder):
    return O.row_count(T.load(spark, folder, "lineitem"))


def head_percent(spark, folder):
    return O.head_percent(_orders(spark, folder), 1.0)


def slice_rows(spark, folder):
    return O.slice_rows(_orders(spark, folder), 100, 250)


def global_sort(spark, folder):
    """The sorted rows with their place in the order of partitions and rows."""
    rows = T.keyed(spark, folder).withColumn("zobr64", F.when(F.col("row_id") % 3 != 0, F.col("zobr64")))
    ordered = Q.global_sort(rows, "zobr64", 8, ["row_id"])
    # An id is the sorted partition's number and, in the lower 33 bits, the row's place in it.
    placed = stage(ordered.withColumn("_id", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    return placed.join(F.broadcast(before), "_part").select(place.alias("ord"), "row_id", _key(), "fen")


def sortedness_violations(spark, folder):
    """Over seven stored files whose keys fall inside files and between them."""
    path = _folder(spark, "keyed")
    rows = T.keyed(spark, folder).withColumn("file", F.floor(F.col("row_id") / 1000) % 7)
    rows.repartition(7, "file").sortWithinPartitions("file", "row_id").write.partitionBy("file").parquet(path)
    table = spark.read.parquet(path).withColumn("name", F.concat(F.lit("part-"), "file"))
    return Q.sortedness_violations(table, "zobr64", "name", "row_id")


def is_sorted_head(spark, folder):
    return Q.is_sorted_head(T.keyed(spark, folder), "zobr64", ORD)


def extract_positions(spark, folder):
    return X.extract_positions(T.docs(spark, folder)).select("doc_id", _key(), "fen")


def group_positions(spark, folder):
    groups = X.group_positions(T.docs(spark, folder))
    return groups.select("doc_id", "group_no", _key(), "n_fens", F.array_join("fens", "|").alias("fens"))


def extraction_totals(spark, folder):
    return X.extraction_totals(T.docs(spark, folder))


def positions_of_lines(spark, folder):
    """All texts as four files, read in many splits, so that headers and positions cross lines and splits.

    A split has 64 KB, or more where the texts would else have more than ``SPLITS``.
    """
    path = _folder(spark, "lines")
    docs = T.docs(spark, folder).select("doc_id", F.coalesce("text", F.lit("")).alias("value"), (F.col("doc_id") % 4).alias("part"))
    docs.repartition(4, "part").sortWithinPartitions("part", "doc_id").select("part", "value").write.partitionBy("part").text(path)
    size, total = spark.conf.get("spark.sql.files.maxPartitionBytes"), R.list_files(spark, path, "*").agg(F.sum("length")).first()[0]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(64 * 1024, math.ceil((total or 0) / SPLITS))))
    try:
        found = stage(X.positions_of_lines(R.read_text_lines(spark, path)), "positions")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    part = F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint")
    return found.select(part.alias("doc_id"), _key(), "fen")


def diagnose_text(spark, folder):
    found = X.diagnose_text(T.docs(spark, folder))
    return found.select("doc_id", _key(), "fen", F.array_join("reported", "; ").alias("reported"))


def _folder(spark, name):
    return new_folder(spark, name)


def read_eval_json(spark, folder):
    """Nested rows written as compressed JSON lines and read back."""
    path = _folder(spark, "json")
    lines = T.eval_rows(spark, folder).select(F.to_json(F.struct("fen", "evals")).alias("value"))
    lines.write.option("compression", "gzip").text(path)
    return R.read_eval_json(spark, f"{path}/*.gz").select("fen", _entries().alias("entries"))


def _entries():
    entry = lambda e: F.concat_ws(
        ":", e["knodes"], e["depth"], F.array_join(F.transform(e["pvs"], _variation), ",")
    )
    return F.array_join(F.transform("evals", entry), "|")


def _variation(pv):
    text = lambda c: F.coalesce(c.cast("string"), F.lit("NULL"))
    return F.concat_ws("/", text(pv["cp"]), text(pv["mate"]), pv["line"])


def sort_table_job(spark, folder):
    """The sorted table as stored: key by arrival ordinal."""
    src, dst = _folder(spark, "keyed"), _folder(spark, "sorted")
    T.keyed(spark, folder).write.parquet(src)
    J.sort_table(spark, src, dst)
    return O.with_row_ordinal(R.read_table(spark, dst)).select("ord", _key())


def duplicates_of_sorted(spark, folder):
    """Keys that the sorted table holds more than once, found in its runs."""
    src, dst = _folder(spark, "keyed"), _folder(spark, "sorted")
    T.keyed(spark, folder).write.parquet(src)
    J.sort_table(spark, src, dst)
    rows = O.with_location(R.read_table(spark, dst))
    with staging(spark) as put:
        found = stage(U.repeated_of_runs(rows.withColumn("key64", key64_column(rows)), put), "repeated")
    return found.select(to_unsigned(F.col("key64")).cast("string").alias("zobr64"), "n")


def _simple_table(spark, folder):
    """Folder of the stored reduced table, made by the reduce job."""
    src, dst = _folder(spark, "nested"), _folder(spark, "simple")
    rows = T.eval_rows(spark, folder).repartitionByRange("row_id").sortWithinPartitions("row_id")
    rows.write.parquet(src)
    J.simplify(spark, src, dst)
    return dst


def simplify_job(spark, folder):
    """The reduced table as stored: every column and the arrival ordinal."""
    table = R.read_table(spark, _simple_table(spark, folder))
    return O.with_row_ordinal(table).withColumn("zobr64", _key())


def build_latest_job(spark, folder):
    dst = _folder(spark, "latest")
    J.build_latest(spark, _simple_table(spark, folder), dst)
    return R.read_table(spark, dst)


def build_kv_job(spark, folder):
    """The stored key/value table with the arrival ordinal of each key."""
    dst = _folder(spark, "kv")
    J.build_kv(spark, _simple_table(spark, folder), dst)
    return O.with_row_ordinal(R.read_table(spark, dst)).select("ord", F.hex("k").alias("k"), F.hex("v").alias("v"))


def _counters(spark, counts):
    """Plain numbers of a job's counters as one row."""
    numbers = {k: v for k, v in counts.items() if isinstance(v, int)}
    return spark.createDataFrame([tuple(numbers.values())], ", ".join(f"{k} long" for k in numbers))


def simplify_counters(spark, folder):
    src, dst = _folder(spark, "nested"), _folder(spark, "simple")
    T.eval_rows(spark, folder).write.parquet(src)
    return _counters(spark, J.simplify(spark, src, dst))


def _kv_counts(spark, folder):
    src, dst = _folder(spark, "flat"), _folder(spark, "kv")
    T.flat_rows(spark, folder).write.parquet(src)
    return J.build_kv(spark, src, dst, check_sorted=False)


def build_kv_counters(spark, folder):
    return _counters(spark, _kv_counts(spark, folder))


def build_kv_letters(spark, folder):
    return _kv_counts(spark, folder)["castling_letters"]


def _files(rows):
    """Files to write ``rows`` rows to, four at least: one task sorts, writes and later reads each."""
    return max(4, math.ceil(rows / FILE_ROWS))


def _raw(spark, folder, rows):
    """Compressed JSON lines of ``fen, evals`` in ``row_id`` order, several files, with blank lines."""
    path = _folder(spark, "raw")
    line = F.to_json(F.struct("fen", "evals"))
    # The blank line is a second value of its row, so that the rows are computed once. No list is empty; the
    # outer generator keeps an inferred size check from making each line twice.
    values = F.when(F.col("row_id") % 50 == 7, F.array(line, F.lit(" "))).otherwise(F.array(line))
    lines = rows.select("row_id", F.explode_outer(values).alias("value"))
    files = _files(T.load(spark, folder, "orders").count())
    ordered = lines.repartitionByRange(files, "row_id").sortWithinPartitions("row_id", "value")
    ordered.select("value").write.option("compression", "gzip").text(path)
    return f"{path}/*.gz"


def _legal_rows(spark, folder):
    """Nested rows over made-up boards that have a key, five lines to a board."""
    # Few splits hold many small rows; they are spread before the rules are tried.
    spread = T.positions(spark, folder).repartition("row_id")
    boards = N.with_position_key(spread, on_error="null").where("position_error IS NULL")
    boards = stage(boards.select((F.col("row_id") - F.col("row_id") % 5).alias("board"), "row_id", "fen"), "boards")
    boards = boards.groupBy("board").agg(F.min_by("fen", "row_id").alias("fen"))
    rows = T.eval_rows(spark, folder).select("row_id", "evals", (F.col("row_id") - F.col("row_id") % 5).alias("board"))
    flat = F.transform("evals", lambda e: e.withField("depth", F.least(e["depth"], F.lit(20).cast("bigint"))))
    return rows.join(boards, "board").select("row_id", "fen", flat.alias("evals"))


def ingest_job(spark, folder):
    """Compressed lines of several files as the stored nested table, entries as text."""
    dst = _folder(spark, "nested")
    path = _raw(spark, folder, T.eval_rows(spark, folder))
    J.ingest_evals(spark, path, dst, file=path)
    return R.read_table(spark, dst).select("fen", _entries().alias("entries"))


def read_scores_json(spark, folder):
    """The narrow reader over the input that the job would choose."""
    path = _raw(spark, folder, T.eval_rows(spark, folder))
    rows = R.read_eval_json(spark, R.resolve_eval_input(spark, path, file=path), SCORE_SCHEMA)
    entry = lambda e: F.concat_ws(":", e["depth"], F.array_join(F.transform(e["pvs"], _score), ","))
    return rows.select("fen", F.array_join(F.transform("evals", entry), "|").alias("entries"))


def _score(pv):
    text = lambda c: F.coalesce(c.cast("string"), F.lit("NULL"))
    return F.concat_ws("/", text(pv["cp"]), text(pv["mate"]))


def add_position_key_job(spark, folder):
    src, dst = _folder(spark, "nested"), _folder(spark, "hashed")
    N.with_position_key(T.positions(spark, folder), on_error="null").where("position_error IS NULL").select(
        "row_id", "fen"
    ).write.parquet(src)
    J.add_position_key(spark, src, dst)
    return R.read_table(spark, dst).select("row_id", _key(), F.hex("zobr128").alias("zobr128"))


def position_key_per_file(spark, folder):
    """Keys per input file: five files of one remainder each, and the file each row is in afterwards."""
    raw, src, dst = (_folder(spark, n) for n in ("raw", "nested", "hashed"))
    rows = N.with_position_key(T.positions(spark, folder), on_error="null").where("position_error IS NULL").select("row_id", "fen")
    rows.withColumn("part", F.col("row_id") % 5).repartition(5, "part").write.partitionBy("part").parquet(raw)
    for part in range(5):
        spark.read.parquet(f"{raw}/part={part}").coalesce(1).write.mode("append").parquet(src)
    J.add_position_key(spark, src, dst, keep_files=True)
    name = lambda t: t.select("*", F.substring_index("_metadata.file_path", "/", -1).alias("file"))
    found = name(R.read_table(spark, dst)).select("row_id", _key(), "file")
    before = name(R.read_table(spark, src)).select(F.col("row_id").alias("_id"), F.col("file").alias("_file"))
    kept = found.join(before, F.col("row_id") == F.col("_id"))
    return kept.select("row_id", "zobr64", (F.col("file") == F.col("_file")).alias("same_file"))


def latest_catalog_table(spark, folder):
    """The latest table in the catalog, joined with itself by key."""
    name = f"latest_{uuid.uuid4().hex}"
    table = S.latest_per_key(_simplified(spark, folder)).drop("skipped")
    saved = W.save_latest_table(table, name, 8, _folder(spark, "catalog"))
    depths = spark.table(name).select("zobr64", "depth")
    return saved.drop("depth").join(depths, "zobr64")


def _deepest(spark, folder):
    path, dst = _raw(spark, folder, _legal_rows(spark, folder)), _folder(spark, "deepest")
    return J.build_deepest(spark, path, dst, file=path), dst


def build_deepest_job(spark, folder):
    """The stored values by key; many lines share a position and a depth."""
    table = R.read_table(spark, _deepest(spark, folder)[1])
    return O.with_row_ordinal(table).select("ord", F.hex("k").alias("k"), "v")


def build_deepest_counters(spark, folder):
    return _counters(spark, _deepest(spark, folder)[0])


def update_deepest_job(spark, folder):
    """A table built from the first four fifths of the lines, in several files, and updated with the rest."""
    rows, dst = stage(_legal_rows(spark, folder), "legal"), _folder(spark, "deepest")
    cut = rows.agg((F.max("row_id") * 4 / 5).alias("cut"))
    early = F.col("row_id") <= cut.first()["cut"]
    first, rest = (_raw(spark, folder, rows.where(c)) for c in (early, ~early))
    built = _folder(spark, "built")
    J.build_deepest(spark, first, built, file=first)
    kv = R.read_table(spark, built)
    kv.repartitionByRange(_files(kv.count()), "k").sortWithinPartitions("k").write.parquet(dst)
    J.update_deepest(spark, rest, dst, file=rest)
    return O.with_row_ordinal(R.read_table(spark, dst)).select("ord", F.hex("k").alias("k"), "v")


def lookup_keys(spark, folder):
    """Values of the keys of every fiftieth row, through the key ranges of the table's files."""
    dst = _folder(spark, "kv")
    J.build_kv(spark, _simple_table(spark, folder), dst)
    FX.build_index(spark, dst, "k")
    rows = T.keyed(spark, folder).where("row_id % 50 = 0")
    keys = rows.select(key_bytes(key64_column(rows)).alias("k"))
    return FX.lookup_keys(spark, dst, keys).select(F.hex("k").alias("k"), F.hex("v").alias("v"))


def scan_castling_job(spark, folder):
    """Letters of the failing rows in the first quarter of a stored table."""
    src = _folder(spark, "encodable")
    rows = _with_move(_orders(spark, folder))
    rows.repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(src)
    found, letters, counts = J.scan_castling(spark, src, 25.0)
    return letters.select("*", *[F.lit(v).cast("long").alias(k) for k, v in counts.items()])


_ALL = [
    simplify_counters,
    build_kv_counters,
    build_kv_letters,
    build_deepest_job,
    build_deepest_counters,
    update_deepest_job,
    lookup_keys,
    lookup_latest,
    ingest_job,
    read_scores_json,
    add_position_key_job,
    position_key_per_file,
    latest_catalog_table,
    scan_castling_job,
    read_eval_json,
    sort_table_job,
    duplicates_of_sorted,
    simplify_job,
    build_latest_job,
    build_kv_job,
    best_eval_first,
    best_eval_last,
    first_token,
    fen_fields,
    dedupe_key,
    board64,
    simplify_positions,
    latest_per_key,
    deepest_per_key,
    upsert_metrics,
    longest_depth_per_fen,
    row_longest_depth,
    assert_required,
    job_metrics,
    load_metrics,
    pack_move_meta,
    score_of,
    encode_errors,
    encode_entry,
    kv_all_entries,
    decode_kv,
    castling_letter_distribution,
    castling_distribution_by_decile,
    bad_castling_scan,
    castling_possible,
    position_key,
    position_problems,
    duplicate_keys,
    collision_profile,
    collision_fens,
    collision_summary,
    duplicate_summary,
    duplicated_keys,
    duplicate_fens,
    rows_with_duplicate_key,
    lookup_key,
    row_ordinal,
    row_count,
    head_percent,
    slice_rows,
    global_sort,
    sortedness_violations,
    is_sorted_head,
    extract_positions,
    group_positions,
    extraction_totals,
    positions_of_lines,
    diagnose_text,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
