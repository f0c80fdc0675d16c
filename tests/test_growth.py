"""Queries whose own steps have to spread with their tables."""

import glob
import os

from checks import spark_queries as C
from checks import tables as T
from poseval.sources import readers as R


def test_places_of_a_sort_need_no_task_that_holds_all_rows(spark):
    plan = C.global_sort(spark, T.SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "Sort " not in plan
    found = C.global_sort(spark, T.SMALL).orderBy("ord").collect()
    assert [r["ord"] for r in found] == list(range(len(found)))
    keys = [(r["zobr64"] is not None, int(r["zobr64"] or 0)) for r in found]
    assert keys == sorted(keys)


def test_lines_are_written_to_more_files_as_they_grow(spark, monkeypatch):
    monkeypatch.setattr(C, "FILE_ROWS", 100, raising=False)
    rows = T.eval_rows(spark, T.SMALL)
    path = C._raw(spark, T.SMALL, rows)
    files = sorted(glob.glob(path))
    n = rows.count()
    assert len(files) > n / 100 * 0.9
    lines = R.read_text_lines(spark, os.path.dirname(path)).collect()
    blank = rows.where("row_id % 50 = 7").count()
    assert blank and len(lines) == n + blank and sum(r["value"] == " " for r in lines) == blank
    assert max(sum(r["file"].endswith(os.path.basename(f)) for r in lines) for f in files) < 400


def test_splits_of_texts_do_not_grow_in_number(spark, monkeypatch):
    """The same positions, whether the texts are read in a few splits or in many."""
    seen = []
    read = R.read_text_lines

    def counted(session, path):
        lines = read(session, path)
        seen.append(lines.rdd.getNumPartitions())
        return lines

    monkeypatch.setattr(C.R, "read_text_lines", counted)
    many = sorted(map(tuple, C.positions_of_lines(spark, T.SMALL).collect()), key=str)
    monkeypatch.setattr(C, "SPLITS", 3, raising=False)
    few = sorted(map(tuple, C.positions_of_lines(spark, T.SMALL).collect()), key=str)
    assert many == few and seen[1] < seen[0] and seen[1] <= 8
