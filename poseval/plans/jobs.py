"""The batch jobs. Each reads a stored table, writes one, returns counters.

Stages hand over stored Parquet, so a lost executor costs the tasks it ran and
no stage recomputes an earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poseval.operators import fileindex as X
from poseval.operators import ordinal as O
from poseval.operators import quality as Q
from poseval.operators.kv import encoded_rows, grouped_entries, packed_entries
from poseval.operators.positions import with_position_key
from poseval.operators.runs import entries_of_runs, latest_of_runs, one_stretch_per_task
from poseval.operators.simplify import deepest_of, latest_per_key, scored_rows, simplify_positions, upsert_counts
from poseval.operators.text import diagnose_text
from poseval.schema import BITS, SCORE_SCHEMA, SIMPLIFIED_COLUMNS, key64_column, read_simplified, require_columns, unsigned_order
from poseval.session import delete_folder, new_folder, stage, staging
from poseval.sources import readers as R
from poseval.sources import sinks as S

ORDER = [O.FILE, O.ROW]


def _rows(spark: SparkSession, folder: str) -> int:
    """Row count from file footers."""
    if not R.has_files(spark, folder, R.PARQUET_GLOB):
        return 0
    return R.read_table(spark, folder).count()


def ingest_evals(
    spark: SparkSession,
    src: str,
    dst: str,
    file: str | None = None,
    first_only: bool = False,
    target_mb: int = S.TARGET_MB,
    zstd_level: int = S.ZSTD_LEVEL,
    partitions: int | None = None,
) -> dict:
    """Nested JSON lines to nested Parquet. An existing output is replaced.

    The part size is estimated on the first lines of the first file, which one
    task reads; nothing is shuffled for it.
    """
    path = R.resolve_eval_input(spark, src, file, first_only)
    head = R.resolve_eval_input(spark, src, file, first_only=True)
    limit = S.rows_per_part(R.read_eval_json(spark, head, partitions=0), target_mb, zstd_level)
    rows = Q.assert_required(R.read_eval_json(spark, path, partitions=partitions))
    S.write_parts(rows, dst, target_mb, zstd_level, overwrite=True, src=src, max_rows=limit)
    return {"output_rows": _rows(spark, dst)}


def add_position_key(
    spark: SparkSession,
    src: str,
    dst: str,
    constants: list[tuple[int, int]] | None = None,
    zstd_level: int = S.ZSTD_LEVEL,
    keep_files: bool = False,
) -> dict:
    """Append both keys. No shuffle: partitions follow the input splits.

    ``keep_files`` writes one output file per input file, of the same name; a
    task then reads a whole file.
    """
    S.check_output(spark, src, dst, overwrite=True)
    S._check_sizes(S.TARGET_MB, zstd_level)
    if keep_files:
        S.write_per_file(spark, src, dst, lambda table: with_position_key(table, constants), zstd_level)
    else:
        S._writer(with_position_key(R.read_table(spark, src), constants), "overwrite", zstd_level).parquet(dst)
    return {"output_rows": _rows(spark, dst)}


def sort_table(
    spark: SparkSession,
    src: str,
    dst: str,
    column: str = "zobr64",
    target_mb: int = S.TARGET_MB,
    zstd_level: int = S.ZSTD_LEVEL,
    overwrite: bool = False,
) -> dict:
    """Global sort by one column into parts of about ``target_mb``.

    The row index inside the source file extends the range key: it differs
    between copies, so a hot value spreads over many partitions.
    """
    table = R.read_table(spark, src)
    require_columns(table, [column])
    if table.isEmpty():
        raise ValueError("input holds no rows")
    located = table.select("*", F.col("_metadata.row_index").alias(O.ROW))
    size = S.folder_bytes(spark, src)
    S.write_sorted(located, dst, column, size, [O.ROW], [O.ROW], target_mb, zstd_level, overwrite, src, table.count())
    return {"output_rows": _rows(spark, dst)}


def simplify(
    spark: SparkSession,
    src: str,
    dst: str,
    target_mb: int = S.TARGET_MB,
    zstd_level: int = S.ZSTD_LEVEL,
    overwrite: bool = False,
) -> dict:
    """One deepest row per distinct position, sorted by key and position.

    The reduced table is stored once in the shared folder, sized from its
    files, then range-sorted into the output. It carries the number of rows
    that went into each kept one, so the counters read no input again.
    """
    S.check_output(spark, src, dst, overwrite)
    S._check_sizes(target_mb, zstd_level)
    table = R.read_table(spark, src)
    folder = new_folder(spark, "simplify")
    try:
        reduced = simplify_positions(O.with_location(table), ORDER, count="_n")
        S._writer(reduced, "errorifexists", zstd_level).parquet(folder)
        stored = spark.read.schema(reduced.schema).parquet(folder)
        size = S.folder_bytes(spark, folder)
        S.write_sorted(stored, dst, "zobr64", size, ["fen"], ["_n"], target_mb, zstd_level, overwrite, src, stored.count())
        found = stored.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_n"), F.lit(0)).alias("used")).first()
    finally:
        delete_folder(spark, folder)
    read = table.count()
    return {"input_rows": read, "skipped_rows_without_eval": read - found["used"], "output_rows": found["rows"]}


def build_latest(
    spark: SparkSession,
    src: str,
    dst: str,
    overwrite: bool = False,
    zstd_level: int = S.ZSTD_LEVEL,
    check_sorted: bool = True,
    target_mb: int = S.TARGET_MB,
) -> dict:
    """One row per key, the last in arrival order wins; key as BIGINT bits.

    The input has to be sorted by key. It is then reduced where it is read and
    its parts follow the input's splits; only keys at their ends are shuffled.
    ``check_sorted=False`` takes any order and groups by a shuffle, into parts
    of ``target_mb``.
    """
    mode = S.check_output(spark, src, dst, overwrite, empty=True)
    S._check_sizes(target_mb, zstd_level)
    table = R.read_table(spark, src)
    rows = read_simplified(O.with_location(table))
    if check_sorted:
        values = SIMPLIFIED_COLUMNS[1:]
        with staging(spark) as put:
            latest = latest_of_runs(rows.withColumn("key64", key64_column(rows)), values, put)
            S.write_runs(latest.select(F.col("key64").alias("zobr64", metadata=BITS), *values), dst, unsigned_order(F.col("zobr64")), mode, zstd_level)
    else:
        S.write_latest_table(latest_per_key(rows, ORDER).drop("skipped"), dst, target_mb, zstd_level, overwrite, src)
    read, written = table.count(), _rows(spark, dst)
    return {"input_rows": read, "inserted_rows": written, "skipped_duplicate_keys": read - written}


def build_kv(
    spark: SparkSession,
    src: str,
    dst: str,
    overwrite: bool = False,
    zstd_level: int = S.ZSTD_LEVEL,
    target_mb: int = S.TARGET_MB,
    check_sorted: bool = True,
) -> dict:
    """Compact binary table with all entries of a key, plus castling letters.

    The input is encoded once into a stored table (key, entry or error, and
    place); the build and all counters read that. Input sorted by key, among the
    rows that can be encoded, is grouped where it is read, and the parts follow
    its splits; ``check_sorted=False`` takes any order and groups by a shuffle,
    into parts of ``target_mb``.
    ``castling_letters`` and ``castling_snapshots`` (letters of the first 10%,
    20%, .. of the rows) are tables, one row per letter however many there are.
    """
    mode = S.check_output(spark, src, dst, overwrite, empty=True)
    S._check_sizes(target_mb, zstd_level)
    table = R.read_table(spark, src)
    rows = read_simplified(O.with_location(table))
    percent = O.decile_of(table)
    with staging(spark) as put:
        with one_stretch_per_task(spark):
            encoded = put(encoded_rows(rows, ORDER), "encoded")
        good = encoded.where("encode_error IS NULL").select("key64", "entry", *ORDER)
        if check_sorted:
            S.write_runs(packed_entries(entries_of_runs(good, put)), dst, F.col("k"), mode, zstd_level)
        else:
            S.write_kv(grouped_entries(good, ORDER), dst, target_mb, zstd_level, overwrite, src)
        counts = stage(
            encoded.groupBy(percent.alias("percent"), F.col("encode_error").isNull().alias("good"), "bad_letter").agg(
                F.count(F.lit(1)).alias("n")
            ),
            "kv-counts",
        )
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("read"), F.coalesce(F.sum(F.when(~F.col("good"), F.col("n"))), F.lit(0)).alias("skipped")
    ).first()
    return {
        "input_rows": total["read"],
        "skipped_rows": total["skipped"],
        "written_keys": _rows(spark, dst),
        "castling_letters": Q.letter_distribution(counts, "n"),
        "castling_snapshots": Q.letter_snapshots(counts, "n"),
    }


def _scored_lines(lines: DataFrame, constants: list[tuple[int, int]] | None) -> DataFrame:
    """One scored row per line; a line that is no position stops the job, a blank one has no key."""
    parsed = with_position_key(R.parse_all_lines(lines, SCORE_SCHEMA), constants, on_error="null")
    bad = ~F.col("blank") & F.col("position_error").isNotNull()
    message = F.concat_ws(" ", "position_error", F.lit("in"), F.coalesce("fen", F.lit("a line without fen")))
    checked = parsed.withColumn("fen", F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("fen")))
    return scored_rows(checked, R.LINE_ORDER)


def build_deepest(
    spark: SparkSession,
    src: str,
    dst: str,
    file: str | None = None,
    first_only: bool = False,
    overwrite: bool = False,
    constants: list[tuple[int, int]] | None = None,
    partitions: int | None = None,
    target_mb: int = S.TARGET_MB,
) -> dict:
    """JSON lines straight to one JSON value per key, the deepest.

    Among lines of equal depth the first in file and line order stays. Lines
    are read and parsed once, into a stored table of one scored row per line;
    the result and the counters of a load in that order come from it. Blank
    lines count as lines.
    """
    S.check_output(spark, src, dst, overwrite, empty=True)
    path = R.resolve_eval_input(spark, src, file, first_only)
    lines = R.read_lines(spark, path, partitions)
    with staging(spark) as put:
        scored = put(_scored_lines(lines, constants), "scored")
        S.write_kv(deepest_of(scored), dst, target_mb, overwrite=overwrite, src=src)
        counters = upsert_counts(scored).first().asDict()
        # Blank lines are the rows without a key.
        counters["rows_missing_eval"] -= scored.where("key64 IS NULL").count()
    return {**counters, "written_keys": _rows(spark, dst)}


def update_deepest(
    spark: SparkSession,
    src: str,
    dst: str,
    file: str | None = None,
    first_only: bool = False,
    constants: list[tuple[int, int]] | None = None,
    partitions: int | None = None,
    zstd_level: int = S.ZSTD_LEVEL,
) -> dict:
    """Merge JSON lines into a table of ``build_deepest``: a key keeps its value unless a line is deeper.

    The result is that of one build over the old lines and then the new ones.
    Only files whose key range the batch touches are read and written anew, each
    by one task; all others stay byte for byte. Counters are those of a load of
    the batch in line order. Nobody may read or update the table meanwhile.
    """
    path = R.resolve_eval_input(spark, src, file, first_only)
    if not R.has_files(spark, f"{dst}/{X.INDEX}", R.PARQUET_GLOB):
        X.build_index(spark, dst, "k")
    files = X.Files(X.read_index(spark, dst))
    if not files.disjoint():
        raise ValueError(f"the key ranges of the files overlap: {dst}")
    with staging(spark) as put:
        scored = put(_scored_lines(R.read_lines(spark, path, partitions), constants), "scored")
        batch = scored.withColumn("_oa", F.lit(1))
        order = unsigned_order(F.col("key64"))
        usable = batch.where("depth IS NOT NULL")
        numbers = sorted(r[0] for r in usable.select(files.number(order).alias("f")).distinct().collect()) if files.path else []
        kept = ["key64", "fen", "eval", "mate", "depth", "_oa", *[c for c in scored.columns if c.startswith("_o")]]
        if numbers:
            old = spark.read.parquet(*[files.path[i] for i in numbers])
            value = F.from_json("v", "eval int, mate int, depth int, fen string").alias("_v")
            stored = old.select(unsigned_order(X.key_order(old, "k")).alias("key64"), value).select("key64", "_v.*")
            # What is there came before any line of the batch.
            stored = stored.withColumns({"_oa": F.lit(0), **{c: F.lit(None).cast(scored.schema[c].dataType) for c in kept[6:]}})
            known = batch.where("key64 IS NOT NULL").select("key64").distinct()
            counted = batch.select(kept).unionByName(stored.join(known, "key64", "left_semi").select(kept))
            merged = deepest_of(batch.select(kept).unionByName(stored.select(kept)))
        else:
            counted, merged = batch.select(kept), deepest_of(batch.select(kept))
        counted = put(counted, "counted")
        before = counted.where("_oa = 0").count()
        counters = upsert_counts(counted).first().asDict()
        for name in ("lines", "rows_with_eval", "updated_keys"):
            counters[name] -= before
        counters["rows_missing_eval"] -= scored.where("key64 IS NULL").count()
        if not usable.isEmpty():
            made = new_folder(spark, "update")
            place = files.number(X.key_order(merged, "k"), numbers) if numbers else F.lit(0)
            rows = merged.withColumn("_f", place).repartitionById(max(len(numbers), 1), F.col("_f"))
            rows = rows.sortWithinPartitions("k").select("k", "v")
            S._writer(rows, "errorifexists", zstd_level).parquet(made)
            X.replace_files(spark, dst, made, numbers, files, "k")
    return {**counters, "written_keys": _rows(spark, dst), "files_rewritten": len(numbers)}


def scan_castling(spark: SparkSession, src: str, percent: float = 1.0) -> tuple[DataFrame, DataFrame, dict]:
    """Failing positions of the first ``percent`` of the rows, their letters, and counters."""
    table = R.read_table(spark, src)
    head = O.head_percent(table, percent)
    found = stage(Q.bad_castling_scan(head), "castling-scan")
    return found, Q.letter_distribution(found), {"sampled_rows": head.count(), "failed_rows": found.count()}


def diagnose(df: DataFrame, text: str = "text") -> DataFrame:
    """Problem lists of all positions in a text table; finding none is an error."""
    found = diagnose_text(df, text)
    if found.isEmpty():
        raise ValueError("no positions found in the input")
    return found
