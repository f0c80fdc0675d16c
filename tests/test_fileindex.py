"""Batch look-ups and updates by the key ranges of files."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from checks import tables as T
from poseval.operators import fileindex as X
from poseval.operators import ordinal as O
from poseval.operators import positions as N
from poseval.plans import jobs as J
from poseval.sources import readers as R
from poseval.sources import sinks as S


@pytest.fixture(scope="module")
def fens(spark):
    rows = N.with_position_key(T.positions(spark, T.SMALL), on_error="null").where("position_error IS NULL")
    return [r.fen for r in rows.select("fen", "zobr64").dropDuplicates(["zobr64"]).orderBy("zobr64").collect()]


def write_lines(folder, rows):
    folder.mkdir(parents=True)
    lines = [json.dumps({"fen": f, "evals": [] if d is None else [{"depth": d, "knodes": 1, "pvs": [{"cp": c}]}]}) for f, d, c in rows]
    (folder / "x.jsonl").write_text("\n".join(lines + [""]))
    return str(folder / "x.jsonl")


def table_in_files(spark, path, src, parts):
    """The built table, divided into ``parts`` files by key."""
    J.build_deepest(spark, src, f"{path}-one", file=src)
    one = spark.read.parquet(f"{path}-one")
    rows = sorted(one.collect())
    for i in range(parts):
        part = rows[i * len(rows) // parts : (i + 1) * len(rows) // parts]
        spark.createDataFrame(part, one.schema).coalesce(1).write.mode("append").parquet(path)
    S.name_by_order(spark, path, F.col("k"))
    return path


def digests(path):
    import pathlib

    return {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in pathlib.Path(path).glob("*.parquet")}


def content(spark, path):
    return [(r.k, r.v) for r in O.with_row_ordinal(R.read_table(spark, path)).orderBy("ord").collect()]


def test_update_equals_a_rebuild(spark, fens, tmp_path):
    rng = random.Random(3)
    some = fens[: len(fens) // 2 * 2 : 2]
    old = [(f, rng.choice([5, 9, None]), i) for i, f in enumerate(rng.sample(some, len(some)))]
    # The batch touches a stretch of keys: deeper, equal, shallower, new and none.
    cut = fens[len(fens) // 3 : len(fens) // 3 + 30]
    new = [(f, rng.choice([4, 9, 12, None]), 1000 + i) for i, f in enumerate(cut * 2)]
    path = table_in_files(spark, str(tmp_path / "t"), write_lines(tmp_path / "old", old), 8)
    before = digests(path)
    counts = J.update_deepest(spark, write_lines(tmp_path / "new", new), path, file=str(tmp_path / "new" / "x.jsonl"))
    both = write_lines(tmp_path / "both", old + new)
    J.build_deepest(spark, both, str(tmp_path / "whole"), file=both)
    assert content(spark, path) == content(spark, str(tmp_path / "whole"))
    after = digests(path)
    same = [n for n in before if after.get(n) == before[n]]
    assert len(after) == 8 and len(same) == 8 - counts["files_rewritten"] >= 4
    # Counters of a load of the batch in line order.
    depth = {}
    for f, d, _ in old:
        if d is not None:
            depth[f] = max(d, depth.get(f, -1))
    stored = 0
    for f, d, _ in new:
        if d is not None and d > depth.get(f, -1):
            depth[f], stored = d, stored + 1
    with_eval = sum(d is not None for _, d, _ in new)
    assert counts == {
        "lines": len(new),
        "rows_with_eval": with_eval,
        "rows_missing_eval": len(new) - with_eval,
        "updated_keys": stored,
        "kept_existing_keys": with_eval - stored,
        "written_keys": len(content(spark, path)),
        "files_rewritten": counts["files_rewritten"],
    }
    # A second time nothing is deeper.
    again = J.update_deepest(spark, str(tmp_path / "new"), path, file=str(tmp_path / "new" / "x.jsonl"))
    assert again["updated_keys"] == 0 and content(spark, path) == content(spark, str(tmp_path / "whole"))


def test_lookup_opens_few_files(spark, tmp_path):
    rows = spark.range(20_000).select(F.unhex(F.lpad(F.hex(F.xxhash64("id")), 16, "0")).alias("k"), F.col("id").alias("v"))
    path = str(tmp_path / "t")
    rows.repartitionByRange(40, "k").sortWithinPartitions("k").write.parquet(path)
    index = X.build_index(spark, path, "k")
    assert index.count() == 40 and sum(r["rows"] for r in index.collect()) == 20_000
    ranges = sorted((r["low"], r["high"], r["path"]) for r in index.collect())
    ordered = [r[0] for r in rows.orderBy("k").select("k").collect()]
    # A thousand keys out of a few files, keys between files, copies, a null and a key that is not there.
    wanted = [bytes(k) for k in ordered[3000:4000]] + [bytes(ordered[-1]), bytes(ordered[0]), bytes(ordered[0]), b"\0" * 8, b"\xff" * 8, None]
    keys = spark.createDataFrame([(k,) for k in wanted], "k binary")
    found = X.lookup_keys(spark, path, keys)
    assert sorted(bytes(r.k) for r in found.collect()) == sorted({k for k in wanted if k in set(map(bytes, ordered))})
    value = lambda k: int.from_bytes(k, "big") - 2**63
    may = {p.rsplit("/", 1)[1] for low, high, p in ranges if any(k and low <= value(k) <= high for k in wanted)}
    opened = {p.rsplit("/", 1)[1] for p in found.inputFiles()}
    assert may <= opened and len(opened) <= len(may) + 2 < 8
    assert X.lookup_keys(spark, path, keys.where("false")).count() == 0
    assert X.lookup_keys(spark, path, spark.createDataFrame([(b"\0" * 8,)], "k binary")).count() == 0
