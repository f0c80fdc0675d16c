"""Registered queries: against their SQL, and the pipeline's stages on its own tables."""

from __future__ import annotations

import pytest
from checks.compare import compare, connect
from poseval.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, duck, name):
    equal, found = compare(spark, duck, SMALL, QUERIES[name], ORACLES[name])
    assert equal, found


def test_pipeline_stages(spark):
    import corpus_pipeline
    from poseval.llm.common import load, staged

    docs = load(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SMALL), "stage")
        assert out.columns == docs.columns, name
        assert out.exceptAll(docs).isEmpty() and 0 < out.count() <= docs.count(), name
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    # Whole documents: the pieces of each add up to its tokens.
    short = pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).where("`sum(length)` != `max(doc_tokens)`")
    assert short.isEmpty()


def test_planted_cases_leave_the_pipeline(spark, docs_of, tmp_path):
    """An exact copy, a near copy and a benchmark passage go; their originals and clean documents stay."""
    import corpus_pipeline

    base = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").where("lang = 'en' AND n_chars BETWEEN 1500 AND 4000").limit(9).collect()]
    item = "seven swans went over the old grey bridge at noon while nobody in the village looked up from their bread"
    near = base[1].split(" ")
    near[20] = "changed"
    rows = dict(enumerate(base)) | {100: base[0] + " ", 101: " ".join(near), 102: base[2] + " " + item}
    folder = str(tmp_path)
    docs_of(list(rows.items())).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, folder).select("doc_id").distinct().collect()}
    # The copy with one more space is the longer original, so it is the one that stays.
    assert kept == {*range(1, 9), 100}
