"""Compare registered queries with their SQL counterparts in DuckDB.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _kind(value) -> str:
    return type(value).__name__


def rows_and_kinds(columns: list[str], rows: list[tuple]):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = sorted(tuple(_cell(r[i]) for i in order) for r in rows)
    kinds = {
        columns[i]: {_kind(r[i]) for r in rows if r[i] is not None} for i in order
    }
    return [columns[i] for i in order], cells, kinds


def compare(spark, folder: str, name: str, con=None) -> list[str]:
    """The differences between the query and its SQL; empty if they agree."""
    con = con or database(folder)
    df = queries()[name](spark, folder)
    got = rows_and_kinds(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(oracle_sql()[name])
    want = rows_and_kinds([d[0] for d in result.description], result.fetchall())
    problems = []
    if got[0] != want[0]:
        problems.append(f"columns {got[0]} != {want[0]}")
    elif len(got[1]) != len(want[1]):
        problems.append(f"rows {len(got[1])} != {len(want[1])}")
    elif got[1] != want[1]:
        differing = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        problems.append(f"{len(differing)} rows differ, such as {differing[0]}")
    if not problems and got[2] != want[2]:
        problems.append(f"types {got[2]} != {want[2]}")
    return problems


if __name__ == "__main__":
    from cartloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    session = local_session(8)
    con = database(folder)
    failed = 0
    for name in names:
        start = time.time()
        if name not in oracle_sql():
            print(f"{name}: no SQL, {queries()[name](session, folder).count()} rows", flush=True)
            continue
        try:
            problems = compare(session, folder, name, con)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{name}: {'; '.join(problems) or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    sys.exit(bool(failed))
