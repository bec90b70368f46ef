"""Run registered queries on Spark and their SQL on DuckDB and compare: columns, row count, values.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    plain = [[None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in frame[c].tolist()] for c in columns]
    return sorted(zip(*plain), key=repr)


def difference(got: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    a, b = _rows(got), _rows(expected)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first: {wrong[0]}"
    return None


def check(spark, con, name: str, folder: str) -> tuple[str, float]:
    from workload import ORACLES, QUERIES
    start = time.time()
    got = QUERIES[name](spark, folder)
    types = dict(got.dtypes)
    got = got.toPandas()
    took = time.time() - start
    if name not in ORACLES:
        return f"rows only: {len(got)}", took
    relation = con.sql(ORACLES[name])
    sql_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    expected = relation.df()
    problem = difference(got, expected)
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = {c: (types[c], sql_types.get(c)) for c in types if pairs.get(types[c]) != sql_types.get(c)}
    note = f" types {odd}" if odd else ""
    return ("DIFF " + problem if problem else f"ok {len(got)}") + note, took


if __name__ == "__main__":
    from casewright.session import local_session
    from workload import QUERIES
    folder = sys.argv[1]
    session = local_session(8)
    connection = connect(folder)
    for query_name in sys.argv[2:] or QUERIES:
        try:
            outcome, seconds = check(session, connection, query_name, folder)
        except Exception as failure:
            outcome, seconds = "FAIL " + str(failure)[:600].replace("\n", " | "), 0.0
        print(f"{query_name:32s} {seconds:6.2f}s {outcome}", flush=True)
