"""Run registered queries beside their SQL: ``python tests/compare.py <folder> [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver


def session(cpus: str = "8", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("nameharbor")
        .config("spark.sql.shuffle.partitions", partitions).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> list[str]:
    """What is wrong with a query; empty when rows, columns and values agree."""
    frame = driver.queries()[name](spark, folder)
    columns = sorted(frame.columns)
    ours = Counter(map(tuple, frame.select(*columns).collect()))
    cursor = con.execute(driver.oracle_sql()[name])
    theirs_columns = [c[0] for c in cursor.description]
    if sorted(theirs_columns) != columns:
        return [f"columns {columns} and {sorted(theirs_columns)}"]
    order = [theirs_columns.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    out = []
    if ours != theirs:
        out.append(f"{sum(ours.values())} and {sum(theirs.values())} rows")
        out += [f"only here {row}" for row in list((ours - theirs))[:3]]
        out += [f"only in SQL {row}" for row in list((theirs - ours))[:3]]
    if not ours:
        out.append("no rows")
    return out


def main(folder: str, *wanted: str) -> None:
    spark, con = session(), database(folder)
    failed = 0
    for name in wanted or driver.queries():
        start = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.2f}s", *found, sep="\n    ", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(*sys.argv[1:])
