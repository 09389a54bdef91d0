"""Compare registered queries with their SQL on one data folder.

Usage: python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [tuple("NULL" if pd.isna(v) else str(v) for v in row) for row in df.itertuples(index=False)]
    return sorted(rows)


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
          "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE"}


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if columns, types and rows agree, else what differs."""
    have = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    rel = con.sql(sql)
    want = dict(zip(rel.columns, map(str, rel.types)))
    if have != want:
        return f"schema: spark {have} sql {want}"
    # Both through text, so that NULLs keep integers as they are.
    left = spark_df.selectExpr(*[f"cast(`{c}` as string) as `{c}`" for c in have]).toPandas()
    right = rel.project(", ".join(f'cast("{c}" as varchar) as "{c}"' for c in want)).df()
    a, b = _canonical(left), _canonical(right)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"rows: spark {len(a)} sql {len(b)}; only spark {only_a}; only sql {only_b}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, bad = duck(folder), 0
    names = sys.argv[2:] or list(e.queries())
    for name in names:
        t = time.time()
        try:
            diff = difference(e.queries()[name](spark, folder), con, e.oracle_sql()[name])
        except Exception as err:  # report and go on with the next query
            diff = f"{type(err).__name__}: {str(err)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {name} {time.time() - t:.2f}s {diff or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
