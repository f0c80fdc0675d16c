"""Reduction of sorted tables: keys across files and splits, plans, unsorted input."""

import random

import pytest
from pyspark.sql import functions as F

from checks import tables as T
from poseval.operators import ordinal as O
from poseval.operators.runs import entries_of_runs, latest_of_runs, repeated_of_runs
from poseval.plans import jobs as J
from poseval.schema import to_key64
from poseval.session import staging
from poseval.sources import readers as R

FEN = T.CORPUS[20]
KIND = "zobr64 string, eval int, mate int, depth int, fen string, first_move string"


def write_files(spark, folder, files):
    """One Parquet file per list of keys, in name order; ``depth`` numbers the rows."""
    n = 0
    for i, keys in enumerate(files):
        rows = [(str(k), j, None, n + j, FEN, "e2e4") for j, k in enumerate(keys)]
        n += len(keys)
        table = spark.createDataFrame(rows, KIND).withColumn("zobr64", F.col("zobr64").cast("decimal(20,0)"))
        table.coalesce(1).write.parquet(f"{folder}/tmp-{i}")
        (part,) = [p for p in (folder / f"tmp-{i}").iterdir() if p.suffix == ".parquet"]
        (folder / "t").mkdir(exist_ok=True)
        part.rename(folder / "t" / f"part-{i:05d}.parquet")
    return str(folder / "t")


BIG = 2**64 - 1
FILES = [
    [1, 1, 2, 3, 3],
    [3, 3],
    [3],
    [3, 4, 5, 5, 2**63 - 1],
    [2**63, 2**63, BIG - 1],
    [BIG] * 4,
    [BIG],
]


def located(spark, path):
    rows = O.with_location(R.read_table(spark, path))
    return rows.withColumn("key64", to_key64(F.col("zobr64")))


def expected(files):
    """Per key its number of rows and the place of the last one."""
    out, n = {}, 0
    for keys in files:
        for k in keys:
            out[k] = (out.get(k, (0, 0))[0] + 1, n)
            n += 1
    return out


@pytest.mark.parametrize("batch", ["1", "2", "10000"])
def test_keys_across_files_and_batches(spark, tmp_path, batch):
    path = write_files(spark, tmp_path, FILES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        with staging(spark) as put:
            latest = {r.key64 % 2**64: (r.n, r.depth) for r in latest_of_runs(located(spark, path), ["depth"], put).collect()}
            rows = located(spark, path).withColumn("entry", F.unhex(F.lpad(F.hex("depth"), 78, "0")))
            found = {r.key64 % 2**64: r for r in entries_of_runs(rows, put).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert latest == expected(FILES)
    depths, n = {}, 0
    for keys in FILES:
        for k in keys:
            depths.setdefault(k, []).append(n)
            n += 1
    assert {k: [r.entries[39 * i + 38] for i in range(r.n)] for k, r in found.items()} == depths


def test_random_tables(spark, tmp_path):
    rng = random.Random(7)
    keys = sorted(rng.choice([5, 5, 5, rng.randrange(400)]) for _ in range(3000))
    cuts = sorted(rng.randrange(3000) for _ in range(9))
    files = [keys[a:b] for a, b in zip([0, *cuts], [*cuts, 3000]) if a < b]
    path = write_files(spark, tmp_path, files)
    with staging(spark) as put:
        got = {r.key64: (r.n, r.depth) for r in latest_of_runs(located(spark, path), ["depth"], put).collect()}
    assert got == expected(files)


def test_repeated_keys(spark, tmp_path):
    """Repeated keys alone are stored, besides two rows per stretch."""
    path = write_files(spark, tmp_path, [[1, 2, 3], [3], [4, 5, 5, 6, 7], [8], [9, 9], [9, BIG], [BIG]])
    kept = []
    with staging(spark) as put:
        rows = repeated_of_runs(located(spark, path), lambda df, name: kept.append(put(df, name)) or kept[-1])
        assert {r.key64 % 2**64: r.n for r in rows.collect()} == {3: 2, 5: 2, 9: 3, BIG: 2}
        assert kept[0].where("kind = 0").count() == 1 and kept[0].count() <= 1 + 2 * 7


def test_jobs_equal_the_shuffled_builds(spark, tmp_path):
    """Same rows and same order as the builds for input in any order."""
    path = write_files(spark, tmp_path, FILES)
    for job in (J.build_latest, J.build_kv):
        outs = [str(tmp_path / f"{job.__name__}-{check}") for check in (True, False)]
        counts = [job(spark, path, out, check_sorted=check) for out, check in zip(outs, (True, False))]
        assert [{k: v for k, v in c.items() if isinstance(v, int)} for c in counts][0] == {
            k: v for k, v in counts[1].items() if isinstance(v, int)
        }
        tables = [O.with_row_ordinal(R.read_table(spark, out)) for out in outs]
        rows = [[r.asDict() for r in t.orderBy("ord").collect()] for t in tables]
        if job is J.build_latest:
            # The shuffled build orders the key's bits as signed numbers, the sorted one as the keys came.
            assert [r["zobr64"] % 2**64 for r in rows[0]] == sorted(expected(FILES))
            rows = [sorted(({k: v for k, v in r.items() if k != "ord"} for r in x), key=lambda r: r["zobr64"]) for x in rows]
        assert rows[0] == rows[1]


def test_data_is_not_exchanged(spark, tmp_path):
    """The only exchanges are those of the border table."""
    path = write_files(spark, tmp_path, FILES)
    with staging(spark) as put:
        df = latest_of_runs(located(spark, path), ["depth"], put)
        plan = df._jdf.queryExecution().executedPlan().toString()
        df.collect()
    main = plan.split("BroadcastExchange")[0]
    assert "Exchange" not in main and "BroadcastHashJoin" in main
    assert "kind" in plan.split("BroadcastExchange")[1]


@pytest.mark.parametrize("files", [[[1, 3, 2]], [[1, 2], [1, 5]], [[5], [2**63], [6]]])
def test_unsorted_input_stops(spark, tmp_path, files):
    path = write_files(spark, tmp_path, files)
    for job in (J.build_latest, J.build_kv):
        with pytest.raises(ValueError, match="not sorted by zobr64"):
            job(spark, path, str(tmp_path / "out"))
        assert not (tmp_path / "out").exists()


def test_too_many_entries_across_files(spark, tmp_path):
    path = write_files(spark, tmp_path, [[1] + [7] * 200, [7] * 56 + [8]])
    with pytest.raises(Exception, match="too many entries for key 7"):
        J.build_kv(spark, path, str(tmp_path / "kv"))
    (tmp_path / "b").mkdir()
    path = write_files(spark, tmp_path / "b", [[1] + [7] * 200, [7] * 55 + [8]])
    assert J.build_kv(spark, path, str(tmp_path / "kv"))["written_keys"] == 3
