"""Compare registered queries with DuckDB on the same Parquet tables.

Run as a script: ``python tests/oracle.py <folder> [query ...]``.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tarnworks.sources.tables import TABLES  # noqa: E402


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v) + 0.0:.6g}"
    return str(v)


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree in columns, types of number and values."""
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    wanted = _rows(names, cursor.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if sorted(names) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} against {sorted(names)}")
    if len(got) != len(wanted):
        found.append(f"{len(got)} rows against {len(wanted)}")
    found += [f"{g} against {w}" for g, w in zip(got, wanted) if g != w][:3]
    return found


if __name__ == "__main__":
    from tarnworks.plans import registered
    from tarnworks.session import local_session

    folder, picked = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db = database(folder)
    bad = 0
    for name, (query, sql) in registered().items():
        if picked and name not in picked:
            continue
        start = time.time()
        try:
            if sql is None:
                result = [] if query(spark, folder).count() else ["no rows"]
            else:
                result = differences(query(spark, folder), db, sql)
        except Exception as error:  # report and go on with the next query
            result = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(result)
        print(f"{name:24s} {time.time() - start:6.1f}s {'ok' if not result else 'DIFFERS'}", flush=True)
        for line in result:
            print("    ", line, flush=True)
    print(f"{bad} differ")
