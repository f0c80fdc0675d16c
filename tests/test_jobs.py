"""Sources, sinks and jobs end to end in fresh folders."""

import json
import os

import pytest
import zstandard
from pyspark.sql import functions as F

from checks import tables as T
from poseval.functions import codec as C
from poseval.operators import analysis as A
from poseval.operators import kv as K
from poseval.operators import ordinal as O
from poseval.operators import quality as Q
from poseval.operators import simplify as S
from poseval.plans import jobs as J
from poseval.schema import SCORE_SCHEMA
from poseval.sources import readers as R
from poseval.sources import sinks as W

USABLE = [i for i in range(47) if i not in (34, 35, 37, 38, 39, 40, 45, 46)]


def write_jsonl(path, rows):
    text = "\n".join(json.dumps(r) for r in rows) + "\n\n"
    path.write_bytes(zstandard.ZstdCompressor().compress(text.encode()))


def json_rows():
    rows = []
    for n in range(600):
        fen = T.CORPUS[USABLE[n % len(USABLE)]]
        evals = [
            {"knodes": n, "depth": 10 + (n * d) % 7, "extra": 1, "pvs": [{"cp": n * d, "line": "e2e4 e7e5"}] * (n % 3 > 0)}
            for d in range(n % 4)
        ]
        if n % 5 == 0:
            evals.append({"knodes": 1, "depth": 30, "pvs": [{"mate": -3, "line": "e2e4"}]})
        rows.append({"fen": fen, "evals": evals})
    return rows


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    """All jobs run once, each on the output of the one before."""
    base = tmp_path_factory.mktemp("flow")
    paths = {n: str(base / n) for n in ("raw", "nested", "hashed", "sorted", "simple", "latest", "kv", "deepest")}
    os.mkdir(paths["raw"])
    write_jsonl(base / "raw" / "a.jsonl.zst", json_rows()[:400])
    write_jsonl(base / "raw" / "b.jsonl.zst", json_rows()[400:])
    counts = {
        "ingest": J.ingest_evals(spark, paths["raw"], paths["nested"]),
        "key": J.add_position_key(spark, paths["nested"], paths["hashed"]),
        "sort": J.sort_table(spark, paths["hashed"], paths["sorted"]),
        "simplify": J.simplify(spark, paths["sorted"], paths["simple"]),
        "latest": J.build_latest(spark, paths["simple"], paths["latest"]),
        "kv": J.build_kv(spark, paths["simple"], paths["kv"]),
        "deepest": J.build_deepest(spark, paths["raw"], paths["deepest"]),
    }
    return paths, counts


def test_ingest_keeps_every_line(spark, flow):
    paths, counts = flow
    assert counts["ingest"]["output_rows"] == 600
    table = R.read_table(spark, paths["nested"])
    assert table.dtypes[1][1] == "array<struct<knodes:bigint,depth:bigint,pvs:array<struct<cp:bigint,mate:bigint,line:string>>>>"
    fens = sorted(r["fen"] for r in table.collect())
    assert fens == sorted(r["fen"] for r in json_rows())


def test_keyed_table_has_both_keys(spark, flow):
    table = R.read_table(spark, flow[0]["hashed"])
    assert table.columns == ["fen", "evals", "zobr64", "zobr128"]
    assert table.where("zobr64 IS NULL OR length(zobr128) <> 16").isEmpty()


def test_sorted_table_is_sorted_across_files(spark, flow):
    table = R.read_table(spark, flow[0]["sorted"])
    assert table.count() == 600
    assert Q.sortedness_violations(O.with_location(table)).isEmpty()
    assert not Q.sortedness_violations(O.with_location(R.read_table(spark, flow[0]["hashed"]))).isEmpty()


def test_simplified_table(spark, flow):
    paths, counts = flow
    table = R.read_table(spark, paths["simple"])
    assert table.columns == ["zobr64", "eval", "mate", "depth", "fen", "first_move"]
    want = S.simplify_positions(R.read_table(spark, paths["hashed"]))
    depth = lambda d: sorted((r["zobr64"], r["depth"]) for r in d.select("zobr64", "depth").collect())
    assert depth(table) == depth(want)
    assert counts["simplify"]["output_rows"] == table.count()
    assert counts["simplify"]["input_rows"] == 600
    ordered = O.with_row_ordinal(table).orderBy("ord").select("zobr64", "fen").collect()
    assert [tuple(r) for r in ordered] == sorted(tuple(r) for r in ordered)


def test_latest_table_has_one_row_per_key(spark, flow):
    paths, counts = flow
    latest = R.read_table(spark, paths["latest"])
    keys = R.read_table(spark, paths["simple"]).select("zobr64").distinct().count()
    assert latest.count() == keys == counts["latest"]["inserted_rows"]
    assert dict(latest.dtypes)["zobr64"] == "bigint"
    assert counts["latest"]["skipped_duplicate_keys"] == counts["latest"]["input_rows"] - keys
    assert latest.select("zobr64").distinct().count() == keys
    # Keys above 2^63 - 1 are found, and the filter reaches the scan.
    high = next(r["zobr64"] for r in latest.collect() if r["zobr64"] < 0)
    found = A.lookup_key(latest, high + 2**64)
    assert [r["zobr64"] for r in found.collect()] == [high]
    assert f"EqualTo(zobr64,{high})" in found._jdf.queryExecution().executedPlan().toString()
    assert A.duplicate_summary(latest).first()["duplicate_rows"] == 0


def test_kv_table_round_trip(spark, flow):
    paths, counts = flow
    kv = R.read_table(spark, paths["kv"])
    assert counts["kv"]["written_keys"] == kv.count()
    ordered = [bytes(r["k"]) for r in O.with_row_ordinal(kv).orderBy("ord").collect()]
    assert ordered == sorted(set(ordered))
    back = {(str(r["zobr64"]), r["fen"]): r["depth"] for r in K.decode_kv(kv).collect()}
    rows = K.with_encode_error(R.read_table(spark, paths["simple"])).where("encode_error IS NULL").collect()
    assert back == {(str(r["zobr64"]), r["fen"]): min(r["depth"], 255) for r in rows}
    letters = [tuple(r) for r in counts["kv"]["castling_letters"].collect()]
    bad = sum(" HAha " in r["fen"] for r in R.read_table(spark, paths["simple"]).collect())
    want = ("H", bad) if bad else ("-", 0)
    assert letters == [want]
    snapshots = {r["percent"]: (r["letter"], r["rows"]) for r in counts["kv"]["castling_snapshots"].collect()}
    assert sorted(snapshots) == list(range(10, 101, 10)) and snapshots[100] == want
    assert counts["kv"]["input_rows"] - counts["kv"]["skipped_rows"] == len(rows)


def test_deepest_table_matches_nested_flow(spark, flow):
    paths, counts = flow
    usable = [bool(r["evals"] and max(enumerate(r["evals"]), key=lambda e: (e[1]["depth"], e[0]))[1]["pvs"]) for r in json_rows()]
    assert counts["deepest"]["lines"] == 602  # one blank line ends each file
    assert counts["deepest"]["rows_with_eval"] == sum(usable)
    assert counts["deepest"]["rows_missing_eval"] == 600 - sum(usable)
    kv = R.read_table(spark, paths["deepest"])
    best, updated = {}, 0
    keys = {r["fen"]: int(r["zobr64"]) for r in R.read_table(spark, paths["hashed"]).select("fen", "zobr64").collect()}
    for row, ok in zip(json_rows(), usable):
        if ok:
            last = max(enumerate(row["evals"]), key=lambda e: (e[1]["depth"], e[0]))[1]
            pv, key = last["pvs"][0], keys[row["fen"]]
            if key not in best or last["depth"] > best[key]["depth"]:
                best[key] = {"eval": pv.get("cp"), "mate": pv.get("mate"), "depth": last["depth"], "fen": row["fen"]}
                updated += 1
    assert {int.from_bytes(r["k"], "big"): json.loads(r["v"]) for r in kv.collect()} == best
    assert counts["deepest"]["updated_keys"] == updated
    assert counts["deepest"]["kept_existing_keys"] == sum(usable) - updated
    assert counts["deepest"]["written_keys"] == len(best)


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_equal_depths_keep_the_first_line(spark, tmp_path, partitions):
    """Lines of one position and depth, over two files: the first one stays however lines are spread."""
    rows = [{"fen": T.CORPUS[20], "evals": [{"knodes": 1, "depth": 9, "pvs": [{"cp": cp, "line": "e2e4"}]}]} for cp in range(300, 0, -1)]
    os.mkdir(tmp_path / "raw")
    write_jsonl(tmp_path / "raw" / "a.jsonl.zst", rows[:150])
    write_jsonl(tmp_path / "raw" / "b.jsonl.zst", rows[150:])
    counts = J.build_deepest(spark, str(tmp_path / "raw"), str(tmp_path / "kv"), partitions=partitions)
    (row,) = R.read_table(spark, str(tmp_path / "kv")).collect()
    assert json.loads(row["v"])["eval"] == 300
    assert (counts["lines"], counts["updated_keys"], counts["kept_existing_keys"]) == (302, 1, 299)


def test_every_letter_is_counted(spark, tmp_path):
    """More than a thousand different bad letters."""
    rows = [(i, 1, None, 5, f"8/8/8/8/8/8/8/8 w {chr(0x4E00 + i)} -", "e2e4") for i in range(1500)]
    table = spark.createDataFrame(rows, "zobr64 long, eval int, mate int, depth int, fen string, first_move string")
    table.coalesce(1).write.parquet(str(tmp_path / "t"))
    counts = J.build_kv(spark, str(tmp_path / "t"), str(tmp_path / "kv"))
    letters = counts["castling_letters"].collect()
    assert len(letters) == 1500 and sum(r["rows"] for r in letters) == counts["skipped_rows"] == 1500


def test_size_sample_shuffles_nothing(spark, tmp_path):
    spark.range(0, 640_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).write.parquet(str(tmp_path / "t"))
    table = R.read_table(spark, str(tmp_path / "t"))
    assert table.rdd.getNumPartitions() > 1
    plan = table.coalesce(1).limit(W.SAMPLE_ROWS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Coalesce 1" in plan
    assert W.rows_per_part(table, 1) > 10_000


def test_parts_follow_bytes(spark, tmp_path):
    """Key/value and sorted tables have parts of the wanted size, whatever the shuffle setting."""
    kv = spark.range(120_000).select(F.unhex(F.substr(F.sha2(F.col("id").cast("string"), 256), F.lit(1), F.lit(16))).alias("k"), F.sha2(F.col("id").cast("string"), 384).alias("v"))
    W.write_kv(kv, str(tmp_path / "kv"), target_mb=2)
    sizes = [r["length"] for r in R.list_files(spark, str(tmp_path / "kv"), R.PARQUET_GLOB).collect()]
    assert len(sizes) == W.parts_for(sum(sizes), 2) and max(sizes) < 1.3 * 2 * 2**20
    W.write_parts(kv.select(F.conv(F.hex("k"), 16, 10).cast("decimal(20,0)").alias("zobr64"), "v"), str(tmp_path / "src"))
    J.sort_table(spark, str(tmp_path / "src"), str(tmp_path / "sorted"), target_mb=2)
    sizes = [r["length"] for r in R.list_files(spark, str(tmp_path / "sorted"), R.PARQUET_GLOB).collect()]
    assert max(sizes) < 1.3 * 2 * 2**20 and len(sizes) >= 3


def test_parts_hold_few_rows_however_well_they_compress(spark, tmp_path, monkeypatch):
    """One task sorts a part, so the stored bytes alone must not decide how many rows it gets."""
    monkeypatch.setattr(W, "MAX_ROWS_PER_PART", 1_000, raising=False)
    key = F.xxhash64(F.floor(F.col("id") / 2)).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    entry = "array(named_struct('knodes', 1L, 'depth', 5L, 'pvs', array(named_struct('cp', 1L, 'mate', null, 'line', 'e2e4'))))"
    nested = spark.range(10_000).select(key.cast("decimal(20,0)").alias("zobr64"), F.concat(F.lit("8/8 w - - "), "id").alias("fen"), F.expr(entry).alias("evals"))
    nested.write.parquet(str(tmp_path / "nested"))
    paths = {n: str(tmp_path / n) for n in ("nested", "sorted", "simple", "latest", "unsorted")}
    J.sort_table(spark, paths["nested"], paths["sorted"])
    J.simplify(spark, paths["sorted"], paths["simple"])
    J.build_latest(spark, paths["simple"], paths["latest"])
    J.build_latest(spark, paths["simple"], paths["unsorted"], check_sorted=False)
    rows = {}
    for n in ("sorted", "simple", "latest", "unsorted"):
        table = R.read_table(spark, paths[n])
        rows[n] = table.count()
        assert max(r["count"] for r in table.groupBy("_metadata.file_path").count().collect()) < 2_000, n
        # A grouping by a shuffle puts the BIGINT keys in their own order.
        assert n == "unsorted" or Q.sortedness_violations(O.with_location(table)).isEmpty()
    kept = R.read_table(spark, paths["simple"]).select("zobr64").distinct().count()
    assert rows["sorted"] == 10_000 and rows["latest"] == rows["unsorted"] == kept == 5_000


def test_jobs_clear_their_staging(spark, flow, tmp_path):
    from poseval.session import shared_folder

    before = set(os.listdir(shared_folder(spark)))
    J.simplify(spark, flow[0]["sorted"], str(tmp_path / "s"))
    J.build_latest(spark, str(tmp_path / "s"), str(tmp_path / "l"), check_sorted=False)
    assert set(os.listdir(shared_folder(spark))) == before


def test_sort_check_does_not_shuffle(spark, files):
    rows = O.with_location(files.selectExpr("id AS zobr64", "*"))
    stretches = Q._stretches(rows.select(O.FILE, O.ROW, "zobr64"))
    assert "Exchange" not in stretches._jdf.queryExecution().executedPlan().toString()
    swapped = rows.withColumn("zobr64", F.when(F.col("zobr64") == 500, 10).when(F.col("zobr64") == 0, 2**40).otherwise(F.col("zobr64")))
    assert Q.sortedness_violations(rows).isEmpty()
    found = sorted((r["previous_key64"], r["key64"]) for r in Q.sortedness_violations(swapped).collect())
    assert found == [(499, 10), (2**40, 1)]
    falling = rows.withColumn("zobr64", 10_000 - F.col("zobr64"))
    assert Q.sortedness_violations(falling).count() == 999


def test_keys_out_of_range_are_refused(spark):
    from poseval.schema import key64_column

    for kind, value in (("decimal(20,0)", "-1"), ("decimal(38,0)", str(2**64))):
        table = spark.sql(f"SELECT CAST('{value}' AS {kind}) AS zobr64")
        with pytest.raises(Exception, match="does not fit"):
            table.select(key64_column(table)).collect()
    scaled = spark.sql("SELECT CAST(1 AS decimal(20,2)) AS zobr64")
    with pytest.raises(TypeError):
        key64_column(scaled)


def test_broken_values_stop_decoding(spark):
    for value in (b"", b"\x00", b"\x01" + b"0" * 38, b"\x01" + b"0" * 40, b"\x02" + b"0" * 39):
        table = spark.createDataFrame([(bytes(8), value)], "k binary, v binary")
        with pytest.raises(Exception, match="not a count"):
            K.decode_kv(table).collect()


def test_ties_do_not_depend_on_row_order(spark):
    rows = [(5, T.CORPUS[20], [(1, 7, [(cp, None, "e2e4")])]) for cp in (30, 10, 20)]
    kind = "zobr64 long, fen string, evals array<struct<knodes:long,depth:long,pvs:array<struct<cp:long,mate:long,line:string>>>>"
    found = set()
    for turn in range(3):
        table = spark.createDataFrame(rows[turn:] + rows[:turn], kind).repartition(3)
        found.add((S.deepest_per_key(table).first()["v"], S.simplify_positions(table).first()["eval"]))
    assert len(found) == 1


def test_castling_scan(spark, flow):
    found, letters, counts = J.scan_castling(spark, flow[0]["hashed"], 100)
    bad = sum(T.CORPUS[USABLE[n % len(USABLE)]] == T.CORPUS[33] for n in range(600))
    assert found.count() == bad and [tuple(r) for r in letters.collect()] == [("H", bad)]
    assert counts == {"sampled_rows": 600, "failed_rows": bad}
    with pytest.raises(ValueError):
        J.scan_castling(spark, flow[0]["hashed"], 0)


def test_outputs_are_guarded(spark, flow):
    paths, _ = flow
    with pytest.raises(FileExistsError):
        J.sort_table(spark, paths["hashed"], paths["sorted"])
    with pytest.raises(ValueError, match="different"):
        J.sort_table(spark, paths["sorted"], paths["sorted"], overwrite=True)
    with pytest.raises(FileExistsError):
        J.build_kv(spark, paths["simple"], paths["kv"])
    with pytest.raises(ValueError, match="missing required"):
        J.sort_table(spark, paths["hashed"], paths["sorted"] + "2", column="nope")
    assert J.sort_table(spark, paths["hashed"], paths["sorted"] + "3")["output_rows"] == 600


def test_unsorted_input_is_refused(spark, flow, tmp_path):
    rows = R.read_table(spark, flow[0]["simple"]).orderBy(F.desc("zobr64")).coalesce(1)
    rows.write.parquet(str(tmp_path / "reversed"))
    with pytest.raises(ValueError, match="not sorted"):
        J.build_latest(spark, str(tmp_path / "reversed"), str(tmp_path / "out"))
    with pytest.raises(ValueError, match="not sorted"):
        J.build_kv(spark, str(tmp_path / "reversed"), str(tmp_path / "out"))


def test_input_choice(spark, flow, tmp_path):
    raw = flow[0]["raw"]
    assert R.resolve_eval_input(spark, raw, first_only=True).endswith("a.jsonl.zst")
    assert R.read_eval_json(spark, R.resolve_eval_input(spark, raw)).count() == 600
    assert R.read_eval_json(spark, R.resolve_eval_input(spark, raw, file=f"{raw}/b.jsonl.zst")).count() == 200
    assert R.read_eval_json(spark, raw, SCORE_SCHEMA).columns == ["fen", "evals"]
    with pytest.raises(FileNotFoundError):
        R.resolve_eval_input(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, str(tmp_path / "absent"))


def test_malformed_line_stops_the_job(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"fen": "a", "evals": []}\n{"fen": \n')
    with pytest.raises(Exception, match="MALFORMED"):
        R.read_eval_json(spark, str(tmp_path / "x.jsonl")).collect()


def test_parquet_names_in_any_case(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t"))
    part = next((tmp_path / "t").glob("part-*.parquet"))
    (tmp_path / "t" / "part-zz.PARQUET").write_bytes(part.read_bytes())
    assert R.read_table(spark, str(tmp_path / "t")).count() == 6


def test_parts_keep_the_wanted_size(spark, tmp_path):
    rows = spark.range(60000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    W.write_parts(rows.coalesce(2), str(tmp_path / "parts"), target_mb=1)
    sizes = [r["length"] for r in R.list_files(spark, str(tmp_path / "parts"), R.PARQUET_GLOB).collect()]
    assert len(sizes) >= 3 and max(sizes) < 1.3 * 2**20
    levels = {}
    for level in (1, 19):
        W.write_parts(rows.coalesce(1), str(tmp_path / f"z{level}"), zstd_level=level, max_rows=10**6)
        levels[level] = W.folder_bytes(spark, str(tmp_path / f"z{level}"))
    assert levels[19] < levels[1]
    for bad in ({"target_mb": 0}, {"zstd_level": 0}):
        with pytest.raises(ValueError):
            W.write_parts(rows, str(tmp_path / "bad"), **bad)


def test_empty_input_writes_no_rows(spark, tmp_path):
    W.write_parts(spark.range(0), str(tmp_path / "none"))
    assert J._rows(spark, str(tmp_path / "none")) == 0


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Five files of different sizes; values rise in arrival order."""
    folder = str(tmp_path_factory.mktemp("files") / "t")
    rows = spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id")
    rows.write.option("maxRecordsPerFile", 90).parquet(folder)
    return R.read_table(spark, folder)


def test_ordinal_over_many_files(spark, files):
    assert len(files.inputFiles()) > 5
    assert O.with_row_ordinal(files).where("id <> ord").isEmpty()
    assert O.with_row_ordinal(files).count() == 1000
    assert O.row_count(files).first()["rows"] == 1000


@pytest.mark.parametrize("offset, length, want", [(0, 10, 10), (95, 200, 200), (990, 50, 10), (1000, 5, 0), (5, 0, 0)])
def test_slices_over_many_files(files, offset, length, want):
    assert [r["id"] for r in O.slice_rows(files, offset, length).orderBy("id").collect()] == list(range(offset, offset + want))


def test_slice_reads_only_its_files(files):
    """Files outside the bounds are dropped before the scan."""
    part = O.slice_rows(files, 250, 60)
    part.collect()
    plan = part._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):
        plan = plan.children().head()
    assert plan.metrics().get("numFiles").get().value() <= 2 < len(files.inputFiles())


@pytest.mark.parametrize("percent, want", [(100, 1000), (0.01, 1), (12.34, 124), (50, 500)])
def test_head_of_many_files(files, percent, want):
    assert sorted(r["id"] for r in O.head_percent(files, percent).collect()) == list(range(want))


def test_deciles_over_many_files(files):
    counts = O.with_decile(files.where("true")).groupBy("percent").count().orderBy("percent").collect()
    assert [tuple(r) for r in counts] == [(p, 100) for p in range(10, 101, 10)]


def test_part_numbers_sort_as_numbers(spark):
    names = ["z.parquet", "part-x.parquet", "part-100000-a.parquet", "part-99999.parquet", "part-00002-a.parquet", "a.parquet"]
    table = spark.createDataFrame([(f"/d/{n}",) for n in names], "p string")
    assert [r["p"][3:] for r in table.orderBy(O.file_order(F.col("p"))).collect()] == names[::-1]


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_text(f"zobr64: 9\n{T.CORPUS[20]}\n")
    from_file = J.diagnose(R.read_text_positions(spark, str(tmp_path / "a.txt"))).first()
    inline = J.diagnose(R.text_positions(spark, f"zobr64: 9 {T.CORPUS[20]}")).first()
    assert int(from_file["zobr64"]) == int(inline["zobr64"]) == 9
    assert from_file["reported"] == ["OK"]
    with pytest.raises(ValueError, match="no positions"):
        J.diagnose(R.text_positions(spark, "nothing here"))


def test_key_lookup_is_pushed_to_the_scan(spark, flow):
    from poseval.operators.analysis import lookup_key

    table = R.read_table(spark, flow[0]["simple"])
    key = str(table.first()["zobr64"])
    found = lookup_key(table, key)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(zobr64,{key}" in plan
    assert {str(r["zobr64"]) for r in found.collect()} == {key}


def test_plans_shuffle_once_or_not_at_all(spark, flow):
    from poseval.operators.positions import with_position_key

    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    hashed = R.read_table(spark, flow[0]["hashed"])
    reduced = plan(S.simplify_positions(O.with_location(hashed), J.ORDER))
    assert reduced.count("Exchange") == 1 and "partial_min_by" in reduced
    assert "Exchange" not in plan(with_position_key(R.read_table(spark, flow[0]["nested"])))
    assert plan(S.deepest_per_key(hashed)).count("Exchange") == 1
    assert C.MAX_ENTRIES == 255
