"""Run the named queries against DuckDB on one scale and print what differs.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    f = float(v)
    return "nan" if math.isnan(f) else f + 0.0


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, sf: str, name: str) -> list[str]:
    """What differs between the query and its SQL, values compared exactly."""
    df = queries()[name](spark, sf)
    mine = rows_of(df.columns, df.collect())
    if name not in oracle_sql():
        return [] if mine else ["no rows"]
    found = con.execute(oracle_sql()[name])
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    theirs = rows_of(names, found.fetchall())
    if len(mine) != len(theirs):
        return [f"{len(mine)} rows against {len(theirs)}", f"{mine[:3]}", f"{theirs[:3]}"]
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return [f"{len(wrong)} of {len(mine)} rows"] + [f"{a}\n   {b}" for a, b in wrong[:3]] if wrong else []


if __name__ == "__main__":
    from conftest import make_session

    session = make_session()
    sf_dir = sys.argv[1]
    con = connect(sf_dir)
    for query in sys.argv[2:] or queries():
        start = time.time()
        try:
            wrong = differences(session, con, sf_dir, query)
        except Exception as e:  # noqa: BLE001 - report and go on
            wrong = [f"{type(e).__name__}: {str(e)[:700]}"]
        kind = "" if query in oracle_sql() else " (rows only)"
        print(f"{'ok  ' if not wrong else 'FAIL'} {time.time() - start:6.1f}s {query}{kind}", *wrong, sep="\n   ", flush=True)
