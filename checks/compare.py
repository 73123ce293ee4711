"""Run registered queries in Spark and their SQL in DuckDB, and compare all rows.

    python -m checks.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import datetime
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from ledgerspark.session import configure

from .registry import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: str = "8") -> SparkSession:
    spark = (
        configure(SparkSession.builder)
        .master(f"local[{cpus}]")
        .appName("ledgerspark-checks")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.date().isoformat() if value.time() == datetime.time() else value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return Decimal(value).normalize()
    return value


def difference(spark: SparkSession, con, name: str, sf: str) -> tuple[int, str]:
    """Number of rows, and what differs ("" when nothing does)."""
    got = QUERIES[name](spark, sf)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(got.columns):
        return 0, f"columns {sorted(got.columns)} != {sorted(columns)}"
    place = [columns.index(c) for c in sorted(columns)]
    want = Counter(tuple(plain(row[i]) for i in place) for row in cursor.fetchall())
    have = Counter(tuple(plain(v) for v in row) for row in got.select(*sorted(columns)).collect())
    if have == want:
        return sum(have.values()), ""
    extra, missing = have - want, want - have
    return sum(have.values()), (
        f"{sum(extra.values())} extra, {sum(missing.values())} missing\n  extra   {sorted(map(str, extra))[:2]}"
        f"\n  missing {sorted(map(str, missing))[:2]}"
    )


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("queries", nargs="*")
    options = args.parse_args()
    spark, con = local_session(), duck(options.sf)
    bad = 0
    for name in options.queries or list(SQL):
        start = time.time()
        try:
            rows, diff = difference(spark, con, name, options.sf)
        except Exception as error:  # report and go on with the next query
            rows, diff = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(diff)
        print(f"{'DIFF' if diff else 'ok  '} {name:28} {rows:8} rows {time.time() - start:6.1f}s {diff}", flush=True)
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
