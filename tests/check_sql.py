"""Run every query next to its SQL on the same tables and compare the rows.

Usage: python tests/check_sql.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from lexmill.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "-"
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, (bool, int)):
        return repr(float(value))
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in data)


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def compare(spark, db, name: str, folder: str) -> str | None:
    """None if equal, otherwise what differs."""
    df = driver.queries()[name](spark, folder)
    mine = rows(df.columns, df.collect())
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for left, right in zip(mine, theirs):
        if left != right:
            return f"{str(left)[:700]}\n   against {str(right)[:700]}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(driver.queries())
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, db, name, folder)
        except Exception as error:  # a failing query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        state = "ok" if problem is None else "FAIL"
        checked = "" if name in driver.oracle_sql() else " (rows only)"
        print(f"{state:4} {time.time() - start:6.2f}s {name}{checked}", flush=True)
        if problem:
            failed += 1
            print("   " + problem, flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} equal")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
