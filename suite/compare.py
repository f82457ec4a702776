"""Run registered queries next to their SQL in DuckDB: `python -m suite.compare <sf_dir> [name part ...]`."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from . import ORDERED
from .base import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def local_session(cores: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("vacancy-lake")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when rows, column names and values agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    mine = sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    order = [names.index(c) for c in cols]
    theirs = sorted((tuple(_plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}; {mine[:1]} {theirs[:1]}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, e.g. {cols}\n  spark {bad[0][0]}\n  sql   {bad[0][1]}" if bad else None


def main() -> int:
    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark, con, failed = local_session(), oracle(sf_dir), 0
    for name in ORDERED():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                diff = difference(spark, con, name, sf_dir)
            else:
                diff = None if QUERIES[name](spark, sf_dir).count() >= 0 else "no rows"
        except Exception as e:  # report and go on: this is the feedback loop
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.2f}s {diff or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
