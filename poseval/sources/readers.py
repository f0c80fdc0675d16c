"""Readers for nested JSON lines, Parquet tables and text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseval.operators.ordinal import file_order
from poseval.schema import EVAL_SCHEMA

EVAL_GLOB = "*.jsonl.zst"
PARQUET_GLOB = "*.{[pP][aA][rR][qQ][uU][eE][tT]}"
# Compressions that one task must read from start to end.
UNSPLITTABLE = ("zst", "gz")
# Columns that order lines: file, split, and number within the split.
LINE_ORDER = ["_line_file", "_line_block", "_line_no"]


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """``path, length`` of the files of one folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", "length")
    )


def resolve_eval_input(spark: SparkSession, folder: str, file: str | None = None, first_only: bool = False) -> str:
    """Path to read: a given file, the first matching name, or all of them."""
    if file is not None:
        if list_files(spark, file, "*").isEmpty():
            raise FileNotFoundError(f"input file does not exist: {file}")
        return file
    found = list_files(spark, folder, EVAL_GLOB)
    first = found.agg(F.min("path").alias("first")).first()["first"]
    if first is None:
        raise FileNotFoundError(f"no {EVAL_GLOB} file in {folder}")
    return first if first_only else f"{folder.rstrip('/')}/{EVAL_GLOB}"


def read_eval_json(
    spark: SparkSession, path: str, schema: T.StructType = EVAL_SCHEMA, partitions: int | None = None
) -> DataFrame:
    """Parse JSON lines with a fixed schema; a malformed line stops the job.

    Blank lines are skipped, unknown fields ignored; see ``read_lines`` for
    how lines are spread.
    """
    return parse_lines(read_lines(spark, path, partitions), schema)


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """``value`` of every line, blank ones too, with ``LINE_ORDER``: where it stood.

    A compressed file can only be read by one task. That task does no more than
    cut and number lines: they are spread over ``partitions`` tasks (default:
    the session's shuffle partitions) by a hash of the line and its number,
    which needs no sort and gives the same split on every attempt. 0 never
    spreads; files that can be split stay where they are read.
    """
    place = [
        file_order(F.col("_metadata.file_path")).alias("_line_file"),
        F.col("_metadata.file_block_start").alias("_line_block"),
        F.monotonically_increasing_id().alias("_line_no"),
    ]
    lines = spark.read.text(path).select("value", *place)
    packed = F.col("path").rlike(rf"\.({'|'.join(UNSPLITTABLE)})$")
    if partitions == 0 or list_files(spark, path, "*").where(packed).isEmpty():
        return lines
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(wanted, "value", "_line_no")


def is_blank() -> Column:
    return ~F.col("value").rlike(r"\S")


def parse_lines(lines: DataFrame, schema: T.StructType = EVAL_SCHEMA) -> DataFrame:
    """The JSON object of each line that is not blank."""
    parsed = lines.where(~is_blank()).select(_object(F.col("value"), schema).alias("_row"))
    return parsed.select("_row.*")


def parse_all_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The JSON object of every line with ``LINE_ORDER`` and ``blank``; a blank line's fields are null."""
    value = F.when(~is_blank(), F.col("value"))
    parsed = lines.select(*LINE_ORDER, is_blank().alias("blank"), _object(value, schema).alias("_row"))
    return parsed.select(*LINE_ORDER, "blank", "_row.*")


def _object(value: Column, schema: T.StructType) -> Column:
    return F.from_json(value, schema, {"mode": "FAILFAST"})


def read_table(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files of one folder; a folder without any is an error.

    The name filter ignores case. Arrival order (file name, then row) is kept
    in the scan metadata, see ``operators.ordinal``.
    """
    if not has_files(spark, folder, PARQUET_GLOB):
        raise FileNotFoundError(f"no parquet files in {folder}")
    return spark.read.option("pathGlobFilter", PARQUET_GLOB).parquet(folder)


def has_files(spark: SparkSession, folder: str, glob: str) -> bool:
    try:
        return not list_files(spark, folder, glob).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files of any size: ``file, block, value``, in order within each split.

    ``block`` is where the split begins in its file; large files are read by
    many tasks. See ``text.positions_of_lines``.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def read_text_positions(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files as ``(doc_id, text)``; the path is the id."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text")
    )


def text_positions(spark: SparkSession, text: str) -> DataFrame:
    """Inline text as a one-row ``(doc_id, text)`` table."""
    return spark.createDataFrame([("inline", text)], "doc_id string, text string")
