"""Run named queries and their SQL twins side by side and compare all values.

Usage: python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from orderloom.session import local_session  # noqa: E402


def comparable(value):
    """A sortable stand-in that two engines agree on."""
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, decimal.Decimal):
        return (2, str(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else format(value, ".12g"))
    if isinstance(value, int):
        return (2, str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return (3, value.isoformat())
    return (4, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(r[i]) for i in order) for r in rows)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def compare(spark, connection, folder: str, name: str) -> tuple[str | None, int]:
    """(difference or None, row count)."""
    frame = queries()[name](spark, folder)
    mine = rows_of(frame.columns, frame.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return (None if mine else "no rows"), len(mine)
    result = connection.sql(sql)
    theirs = rows_of(result.columns, result.fetchall())
    if sorted(frame.columns) != sorted(result.columns):
        return f"columns {sorted(frame.columns)} <> {sorted(result.columns)}", len(mine)
    if mine != theirs:
        ours_only = [r for r in mine if r not in set(theirs)][:3]
        theirs_only = [r for r in theirs if r not in set(mine)][:3]
        return f"{len(mine)} vs {len(theirs)} rows; {ours_only} <> {theirs_only}", len(mine)
    return None, len(mine)


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name in names or queries():
        start = time.time()
        try:
            difference, count = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            difference, count = f"{type(error).__name__}: {str(error)[:600]}", 0
        bad += difference is not None
        mark = "rows-only" if name not in oracle_sql() else "ok"
        print(f"{name:26} {count:7} rows {time.time() - start:6.2f}s  {difference or mark}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
