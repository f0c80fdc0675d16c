"""From raw documents to packed training sequences, one stored table per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poseval.llm.common import load, staged
from poseval.llm.decontaminate import drop_contaminated
from poseval.llm.exact_dedup import drop_exact_duplicates
from poseval.llm.packing import Limits, pack_documents
from poseval.llm.quality import drop_low_quality
from poseval.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return drop_low_quality(docs, load(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    pieces = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), limits=Limits(2048, 128, 2048))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]
#: SQL has no tokenizer, classifier or SimHash; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", heavy=True)
    name, stage = STAGES[-1]
    return staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
