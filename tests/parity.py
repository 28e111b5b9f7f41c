"""Run queries and their SQL on the same tables and compare the results value by value."""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("isobar-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return str(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def expected(sf_dir: str, sql: str):
    with duckdb.connect() as con:
        for path in Path(sf_dir).glob("*.parquet"):
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
        result = con.execute(sql)
        columns = [d[0] for d in result.description]
        return columns, result.fetchall()


def difference(spark, sf_dir: str, name: str) -> str:
    """Empty where the query and its SQL agree."""
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    if name not in entry.oracle_sql():
        return "" if rows else "no rows"
    columns, wanted = expected(sf_dir, entry.oracle_sql()[name])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    got, want = multiset(df.columns, rows), multiset(columns, wanted)
    if got == want:
        return ""
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows against {len(want)}; only here {only_got}; only there {only_want}"


if __name__ == "__main__":
    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        started = time.time()
        try:
            found = difference(spark, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - started:.2f}s {found}", flush=True)
    print(f"{bad} of {len(names)} differ")
