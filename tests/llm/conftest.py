from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def docs_of(spark: SparkSession):
    """Make a documents table from texts, or from (doc_id, text) pairs, in any number of partitions."""

    def make(rows, partitions: int = 3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        made = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
        kind = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(made, kind).repartition(partitions)

    return make
