"""Run registered queries against their oracle SQL in DuckDB and compare values."""

from __future__ import annotations

import re
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from gleanspark.fixtures import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    columns = [
        ["~" if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v) else _text(v) for v in frame[c]]
        for c in frame.columns
    ]
    return sorted(zip(*columns))


def _text(value: object) -> str:
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value)


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs between a query and its oracle; empty when they agree."""
    frame = contract.queries()[name](spark, sf_dir)
    actual, expected = frame.toPandas(), con.execute(contract.oracle_sql()[name]).df()
    problems = []
    if sorted(actual.columns) != sorted(expected.columns):
        return [f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"]
    for column in actual.columns:
        # A whole number that may be null comes as float64 from Spark, as Int64 from DuckDB.
        kinds = [re.sub(r"\[.*\]", "", str(f[column].dtype)) for f in (actual, expected)]
        if expected[column].isna().any():
            kinds = [{"Int64": "float64"}.get(kind, kind) for kind in kinds]
        if kinds[0] != kinds[1]:
            problems.append(f"dtype {column}: {actual[column].dtype} != {expected[column].dtype}")
    left, right = canonical(actual), canonical(expected)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        problems.append(f"values, e.g. {[(a, b) for a, b in zip(left, right) if a != b][:2]}")
    return problems if problems or len(left) else ["no rows"]


def main() -> None:
    from gleanspark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(contract.queries())
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, name, sf_dir) if name in contract.oracle_sql() else ["no oracle"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.1f}s", *found, flush=True)
    print(f"{bad} bad of {len(names)}")


if __name__ == "__main__":
    main()
