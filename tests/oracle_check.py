"""Run the named queries next to their SQL and report differences.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    shown = frame.map(lambda v: "~" if v is None or v != v else str(v))
    return frame.iloc[shown.sort_values(list(shown.columns)).index].reset_index(drop=True)


def kind(dtype: str) -> str:
    return {"object": "text", "str": "text", "string": "text"}.get(dtype, dtype)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None where both hold the same columns, types and rows."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} and {len(sql_frame)}"
    for c in spark_frame.columns:
        if kind(str(spark_frame[c].dtype)) != kind(str(sql_frame[c].dtype)):
            return f"type of {c}: {spark_frame[c].dtype} and {sql_frame[c].dtype}"
    a, b = ordered(spark_frame), ordered(sql_frame)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same[~same].index[0]
            return f"{(~same).sum()} values of {c}, first {a.loc[i].to_dict()} and {b.loc[i].to_dict()}"
    return None


def main() -> int:
    import __spark_entry__ as contract
    from shelfwise.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = contract.queries(), contract.oracle_sql()
    connection = connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            result = queries[name](spark, sf_dir).toPandas()
            seconds = time.time() - start
            note = difference(result, connection.execute(sql[name]).df()) if name in sql else f"no SQL; {result.head(2).to_dict('records')}"
            failed += bool(note) and name in sql
        except Exception as error:  # report and go on
            seconds, note, failed = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", failed + 1
            result = []
        print(f"{name:28s} {len(result):8d} {seconds:7.2f}s  {note or 'same'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
