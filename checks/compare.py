"""Run registered queries in both engines and compare rows, names and values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.queries import ORACLE, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when both engines agree, else a short account of the first difference."""
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = normal(got, df.columns), normal(want, names)
    for x, y in zip(a, b):
        if x != y:
            where = [(n, p, q) for n, p, q in zip(sorted(names), x, y) if p != q]
            return f"values {str(where)[:600]} in {str(x)[:200]}"
    return None if got else "no rows"


def main(sf_dir: str, *only: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in only or QUERIES:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
