"""Token ids of documents in grammar-compressed files.

A folder holds two Parquet tables. ``blocks``: one row per block of whole
documents, in ascending document order, each a Re-Pair grammar of its own with
expansion lengths; so any block, and any range of tokens in it, is decoded by
itself. ``shards``: where each shard's tokens begin. Both are written by Spark,
so the writing survives lost executors and works in any store Spark reaches.

Columns of ``blocks`` (numbers little-endian, unsigned): ``shard``, ``block``;
``before`` tokens of the shard before the block; ``n_tokens``; ``doc_ids`` and
``doc_tokens`` (4 bytes each) of its documents; ``width`` of a symbol;
``alphabet`` (4 bytes), the ids that symbols 0, 1, .. stand for; ``rules``, two
symbols each, for the symbols that follow; ``lengths`` (4 bytes), the ids each
rule expands to; ``sequence``; ``marks`` (4 bytes), the token place of every
64th symbol.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poseval.llm import repair
from poseval.llm.bytewords import tokenizer_of
from poseval.llm.common import tasks_for, texts

#: A block ends with the document that brings it to so many tokens.
BLOCK_TOKENS = 1 << 19
ROWS_PER_SHARD = 50_000
#: Shards up to which their starts are sent to every task, 16 bytes each.
MAX_BROADCAST_SHARDS = 1_000_000

_BLOCKS = (
    "shard int, block int, before long, n_tokens long, doc_ids array<{id}>, doc_tokens binary, width int, "
    "alphabet binary, rules binary, lengths binary, sequence binary, marks binary"
)
_NAMES = [c.split()[0] for c in _BLOCKS.split(", ")]


def write_token_files(docs: DataFrame, tokenizer_file: str, folder: str, end_id: int = 0) -> None:
    """Encode every text, add ``end_id`` and write the ids in ascending ``doc_id`` order.

    A null or empty text is the end token alone; a null ``doc_id`` comes first;
    rows of one id follow by a hash of the text, then by the text, and repeated
    rows are written each. Other columns are ignored; an empty table gives a
    folder without blocks. Documents are range-partitioned by id and, so that an
    id with many rows is divided, by that hash and the row's number. A task holds
    one block and its longest document, never a shard.
    """
    rows = texts(docs)
    spark, kind = rows.sparkSession, rows.schema["doc_id"].dataType.simpleString()
    shards = tasks_for(spark, docs.count(), ROWS_PER_SHARD)
    placed = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = placed.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "_hash", "_row")
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_hash", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = tokenizer_of(tokenizer_file), np.array([end_id], "<u4").tobytes()
        shard, block, before, size, waiting = TaskContext.get().partitionId(), 0, 0, 0, []
        id_type = None

        def finished() -> pa.RecordBatch:
            g = repair.compress(np.frombuffer(b"".join([x for _, x in waiting]), "<u4"))
            width = repair.symbol_width(g)
            cells = [
                pa.array([shard], pa.int32()),
                pa.array([block], pa.int32()),
                pa.array([before], pa.int64()),
                pa.array([size], pa.int64()),
                pa.array([[i for i, _ in waiting]], pa.list_(id_type)),
                pa.array([repair.pack(np.array([len(x) // 4 for _, x in waiting]), 4)]),
                pa.array([width], pa.int32()),
                *[
                    pa.array([repair.pack(x, w)])
                    for x, w in ((g.alphabet, 4), (g.rules.reshape(-1), width), (g.lengths, 4), (g.sequence, width), (g.marks, 4))
                ],
            ]
            return pa.RecordBatch.from_arrays(cells, names=_NAMES)

        for b in batches:
            id_type = b.schema.field("doc_id").type
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = tokenizer.ids(text.as_py()) + end
                waiting.append((doc_id, ids))
                size += len(ids) // 4
                if size >= BLOCK_TOKENS:
                    yield finished()
                    block, before, size, waiting = block + 1, before + size, 0, []
        if waiting:
            yield finished()

    blocks = ordered.mapInArrow(run, _BLOCKS.format(id=kind))
    blocks.write.option("compression", "zstd").parquet(f"{folder}/blocks")
    per_shard = _blocks(spark, folder).groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_shard.withColumn("shard_start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("long")))
    starts.write.parquet(f"{folder}/shards")


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/blocks")


def _with_starts(spark: SparkSession, folder: str, found: DataFrame) -> DataFrame:
    """Add ``shard_start``; one small row per shard."""
    starts = spark.read.parquet(f"{folder}/shards").select("shard", "shard_start")
    if starts.count() <= MAX_BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    return found.join(starts, "shard")


def _grammar(b: pa.RecordBatch, i: int) -> repair.Grammar:
    width = b.column(b.schema.get_field_index("width"))[i].as_py()
    of = lambda name, w: repair.unpack(b.column(b.schema.get_field_index(name))[i].as_buffer(), w)
    return repair.Grammar(of("alphabet", 4), of("rules", width).reshape(-1, 2), of("lengths", 4), of("sequence", width), of("marks", 4))


_GRAMMAR = ["width", "alphabet", "rules", "lengths", "sequence", "marks"]


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document: ids as stored, 4 bytes each.

    ``start`` counts the ids of all documents before it.
    """
    blocks = _blocks(spark, folder).select("shard", "before", "doc_ids", "doc_tokens", *_GRAMMAR)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                data = repair.expand(_grammar(b, i)).astype("<u4").tobytes()
                sizes = repair.unpack(b.column(3)[i].as_buffer(), 4)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                n, ids = len(sizes), b.column(2)[i].values
                for lo in range(0, n, 4096):
                    cut = slice(lo, lo + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(sizes[cut]), b.column(0)[i].as_py()), pa.int32()),
                            ids[cut],
                            pa.array(starts[cut] + b.column(1)[i].as_py()),
                            pa.array(sizes[cut]),
                            pa.array([data[4 * s : 4 * e] for s, e in zip(starts[cut].tolist(), ends[cut].tolist())], pa.binary()),
                        ],
                        names=["shard", "doc_id", "offset", "n_tokens", "ids"],
                    )

    found = blocks.mapInArrow(run, f"shard int, doc_id {kind}, offset long, n_tokens long, ids binary")
    placed = _with_starts(spark, folder, found)
    return placed.select("doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids")


def read_tokens(spark: SparkSession, folder: str, start: int, length: int) -> DataFrame:
    """``start, ids`` for the tokens ``start .. start + length - 1``, one row per block they lie in.

    Other blocks are not opened beyond their counts, and in these only the
    symbols that cover the range are expanded.
    """
    stop = start + length
    begin = F.col("shard_start") + F.col("before")
    wanted = _with_starts(spark, folder, _blocks(spark, folder).select("shard", "before", "n_tokens", *_GRAMMAR))
    inside = wanted.where((begin < stop) & (begin + F.col("n_tokens") > start)).select(begin.alias("begin"), *_GRAMMAR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                begin = b.column(0)[i].as_py()
                low = max(start - begin, 0)
                ids = repair.expand_range(_grammar(b, i), low, stop - begin - low)
                yield pa.RecordBatch.from_arrays([pa.array([begin + low]), pa.array([ids.astype("<u4").tobytes()])], names=["start", "ids"])

    return inside.mapInArrow(run, "start long, ids binary")
