"""Documents under one number each, in the order of their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poseval.llm.common import staged, texts


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Heads ``doc_id, sha, n_bytes, copies, seq, copy`` and texts ``seq, text`` (as bytes).

    Rows of equal id and text are one number with its ``copies``; ``copy``
    tells that an earlier number has the same text. Ids that are unique and not
    null are their own numbers, and texts then come straight from the scan.
    Otherwise rows are numbered by id, null first, then by digest.
    """
    text = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    sha = F.unhex(F.sha2("text", 256)).alias("sha")
    heads = text.select("doc_id", sha, F.octet_length("text").cast("long").alias("n_bytes"))
    heads = staged(heads.groupBy("doc_id", "sha", "n_bytes").agg(F.count(F.lit(1)).alias("copies")), "heads")
    total = heads.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count_distinct("doc_id")).first()
    if total[0] == total[1]:
        heads = heads.withColumn("seq", F.col("doc_id").cast("long"))
        rows = text.select(F.col("doc_id").cast("long").alias("seq"), "text")
    else:
        ordered = heads.orderBy(F.asc_nulls_first("doc_id"), "sha").withColumn("seq", F.monotonically_increasing_id())
        heads = staged(ordered, "heads-numbered")
        same = F.expr("t.doc_id <=> h.doc_id AND t.sha = h.sha")
        rows = text.select("*", sha).alias("t").join(heads.alias("h"), same).select("seq", "text").dropDuplicates(["seq"])
    earliest = heads.groupBy("sha").agg(F.min("seq").alias("earliest"))
    return staged(heads.join(earliest, "sha").withColumn("copy", F.col("seq") != F.col("earliest")), "heads-marked"), rows
