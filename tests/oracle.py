"""Compare every registered query with its SQL on DuckDB: columns, row count and values, order ignored.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.apply(lambda s: s.map(lambda v: "<null>" if v is None or v is pd.NaT or v != v else str(v)))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    a, b = canonical(spark_frame), canonical(sql_frame)
    if a.equals(b):
        return None
    differing = (a != b).any(axis=1)
    return f"{differing.sum()} rows differ, first:\n{a[differing].head(2).to_dict('records')}\n{b[differing].head(2).to_dict('records')}"


def kinds(frame) -> dict[str, str]:
    return {k: str(v).replace("[ns]", "[us]") for k, v in sorted(frame.dtypes.items())}


def main() -> int:
    from gaugeline.session import build_session
    from gaugeline.plans.table_queries import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            want = db.execute(ORACLES[name]).df() if name in ORACLES else None
            problem = compare(got, want) if want is not None else None
            if want is not None and not problem and kinds(got) != kinds(want):
                problem = f"(types) {kinds(got)} / {kinds(want)}"
        except Exception as e:
            took, got, problem = time.time() - start, [], f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:22} {len(got):8} rows {took:6.2f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
