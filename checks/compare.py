"""Run registered queries on both engines and compare whole results.

``python -m checks.compare [folder] [query ...]``
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _cell(value) -> str:
    return "NULL" if value is None else str(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder: str, query, oracle: str) -> tuple[bool, str]:
    """Equal or not, and what differs."""
    start = time.time()
    df = query(spark, folder)
    ours = _rows(df.columns, df.collect())
    middle = time.time()
    found = con.execute(oracle)
    names = [d[0] for d in found.description]
    theirs = _rows(names, found.fetchall())
    took = f"{len(ours)} rows, {middle - start:.1f}s / {time.time() - middle:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    types = {d[0]: str(d[1]) for d in found.description}
    shown = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    wrong = [f"{n}: {t} vs {types[n]}" for n, t in df.dtypes if shown.get(t, t) != types[n]]
    if wrong:
        took += " TYPES " + ", ".join(wrong)
    if ours == theirs:
        return True, took
    extra = [r for r in ours if r not in set(theirs)][:3]
    missing = [r for r in theirs if r not in set(ours)][:3]
    return False, f"{took}; oracle {len(theirs)} rows\n  only ours: {extra}\n  only oracle: {missing}"


def main() -> int:
    from checks.duckdb_sql import ORACLES
    from checks.spark_queries import QUERIES
    from poseval.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in chosen:
        if name not in ORACLES:
            print(f"rows  {name}: {QUERIES[name](spark, folder).count()}", flush=True)
            continue
        try:
            ok, note = compare(spark, con, folder, QUERIES[name], ORACLES[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok   ' if ok else 'DIFF '} {name}: {note}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
