"""Run registered queries next to their SQL: python -m checks.compare <folder> [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


def _lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[str, float]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = _lines(df.columns, df.collect())
    took = time.time() - start
    if name not in ORACLE:
        return f"rows only ({len(got[1])})", took
    cur = con.execute(ORACLE[name])
    want = _lines([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"COLUMNS differ: {got[0]} / {want[0]}", took
    if got[1] != want[1]:
        only_got = sorted(set(got[1]) - set(want[1]))[:3]
        only_want = sorted(set(want[1]) - set(got[1]))[:3]
        return f"ROWS differ {len(got[1])}/{len(want[1])}: {only_got} / {only_want}", took
    return f"equal ({len(got[1])} rows)", took


def main() -> None:
    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            verdict, took = compare(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001
            verdict, took = f"FAILED {type(e).__name__}: {str(e)[:1500]}", 0.0
        bad += not verdict.startswith(("equal", "rows only"))
        print(f"{name:32s} {took:6.2f}s {verdict}", flush=True)
    print("all equal" if not bad else f"{bad} differ")
    spark.stop()
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
