"""Compare the registered queries with their SQL in DuckDB: `python tests/check_oracles.py [sf_dir] [name ...]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    started = time.time()
    got = entry_points.queries()[name](spark, sf_dir).toPandas()
    seconds = time.time() - started
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return f"rows {len(got)} {seconds:.1f}s"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"FAIL columns {sorted(got.columns)} {sorted(want.columns)}"
    a, b = normal(got), normal(want)
    if a != b:
        left, right = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        return f"FAIL {len(a)} {len(b)} {left} {right}"
    return f"ok {len(a)} {seconds:.1f}s{' EMPTY' if not a else ''}"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry_points.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        try:
            verdict = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on to the next query
            verdict = f"FAIL {type(error).__name__} {str(error)[:600]}"
        print(f"{name:32s} {verdict}", flush=True)


if __name__ == "__main__":
    main()
