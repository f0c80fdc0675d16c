"""Filtering stages on tables whose columns have the names they use inside."""

from poseval.llm.exact_dedup import drop_exact_duplicates
from poseval.llm.simhash import drop_near_duplicates

CLASH = [f"'x' AS {c}" for c in ("_sha", "_name", "_row", "_FP", "fp", "kept", "sha", "component_id", "batch", "copies", "n")]


def kept(df, columns):
    assert df.columns == columns
    return sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect()))


def test_clashing_columns(spark, docs_of):
    long = " ".join(f"word{i}" for i in range(400))
    docs = docs_of([(1, "a b"), (2, "a  b "), (3, None), (4, ""), (None, "n m"), (None, "n m"), (5, long), (6, long), (7, long + " more")])
    more = docs.selectExpr("*", *CLASH)
    for drop in (drop_exact_duplicates, drop_near_duplicates):
        assert kept(drop(more), more.columns) == kept(drop(docs), docs.columns)
    exact = kept(drop_exact_duplicates(more), more.columns)
    assert [i for _, i, _ in exact] == [0, 2, 3, 5, 7]


def test_empty_tables(docs_of):
    none = docs_of([(1, "a")]).where("false").selectExpr("*", *CLASH)
    assert drop_exact_duplicates(none).count() == 0 and drop_near_duplicates(none).count() == 0
