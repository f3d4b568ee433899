"""Run named queries against their SQL counterparts: ``python tests/check_oracle.py <folder> [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), kind="stable", na_position="last").reset_index(drop=True)


def compare(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """None when equal, else what differs.  Integer and float kinds have to agree too."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    a, b = canonical(spark_rows), canonical(sql_rows)
    for column in a.columns:
        nullable = "Int64" in (str(a[column].dtype), str(b[column].dtype))  # pandas reads whole numbers with nulls as floats
        if a[column].dtype.kind != b[column].dtype.kind and not (nullable and a[column].isna().any()):
            return f"{column}: {a[column].dtype} != {b[column].dtype}"
        same = (a[column] == b[column]) | (a[column].isna() & b[column].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{column}: {(~same).sum()} differ, first {a[column][at]!r} != {b[column][at]!r}"
    return None


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from missive.session import build_session

    spark = build_session(8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            rows = run(spark, folder).toPandas()
            seconds = time.time() - start
            verdict = compare(rows, con.execute(sql[name]).df()) if name in sql else "rows only"
        except Exception as error:  # report and go on with the next query
            seconds, rows, verdict = time.time() - start, [], f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict not in (None, "rows only")
        print(f"{name:28s} {seconds:6.2f}s {len(rows):7d} rows  {verdict or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
