"""Run every query against its oracle: ``python -m checks.compare <sf_dir> [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def cell(v) -> str:
    if isinstance(v, float):
        return "NULL" if v != v else repr(v)
    return "NULL" if v is None else f"{type(v).__name__}:{v}"


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, sf: str, names: list[str] | None = None) -> list[str]:
    """Names of queries whose rows differ from the oracle's; prints a line per query."""
    from checks.oracles import ORACLES
    from checks.queries import QUERIES

    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = []
    for name in names or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, sf)
        got = rows_of(df.columns, df.collect())
        spent = time.time() - start
        if name not in ORACLES:
            print(f"{name:26s} {len(got):6d} rows, no oracle, {spent:.2f}s", flush=True)
            continue
        cursor = db.execute(ORACLES[name])
        columns = [d[0] for d in cursor.description]
        want = rows_of(columns, cursor.fetchall())
        same = got == want and sorted(columns) == sorted(df.columns)
        print(f"{name:26s} {len(got):6d} rows, {'ok' if same else 'DIFFERENT'}, {spent:.2f}s",
              flush=True)
        if not same:
            bad.append(name)
            print("   columns", sorted(df.columns), sorted(columns))
            for label, rows in (("spark", set(got) - set(want)), ("duckdb", set(want) - set(got))):
                for r in sorted(rows)[:3]:
                    print("  ", label, str(r)[:400])
    return bad


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    session = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    failed = compare(session, sys.argv[1], sys.argv[2:] or None)
    print("different:", failed or "none")
