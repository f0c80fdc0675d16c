"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
is run to the end into a sink that discards rows; the best of two runs counts,
so start-up and compilation are left out.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from checks.spark_queries import QUERIES
from poseval.session import build_session

HEADLINE = [
    "simplify_positions",
    "best_eval_first",
    "best_eval_last",
    "deepest_per_key",
    "latest_per_key",
    "upsert_metrics",
    "longest_depth_per_fen",
    "kv_all_entries",
    "decode_kv",
    "encode_entry",
    "encode_errors",
    "castling_letter_distribution",
    "castling_distribution_by_decile",
    "bad_castling_scan",
    "position_key",
    "position_problems",
    "collision_profile",
    "collision_fens",
    "duplicate_keys",
    "duplicate_summary",
    "duplicate_fens",
    "rows_with_duplicate_key",
    "global_sort",
    "sortedness_violations",
    "row_ordinal",
    "head_percent",
    "lookup_key",
    "extract_positions",
    "group_positions",
    "diagnose_text",
    "sort_table_job",
    "simplify_job",
    "build_latest_job",
    "build_kv_job",
    "ingest_job",
    "add_position_key_job",
    "build_deepest_job",
]
RUNS = 2
# Order columns of the tables that the queries read.
TABLES = {"orders": "o_orderkey", "lineitem": "l_orderkey", "documents": "doc_id"}


def copy_in_parts(spark, folder: str, to: str, parts: int) -> str:
    """The given single files as many, in the same order, so that all cores can read."""
    for name, key in TABLES.items():
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        table.repartitionByRange(parts, key).sortWithinPartitions(key).write.parquet(f"{to}/{name}.parquet")
    return to


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    with tempfile.TemporaryDirectory(prefix="bench-") as own:
        tables = copy_in_parts(spark, folder, own, int(cpus))
        for name in chosen:
            best = float("inf")
            for _ in range(RUNS):
                start = time.perf_counter()
                QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - start)
            seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
