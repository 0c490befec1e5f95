"""Run registered queries in Spark and their SQL counterparts in DuckDB.

``python tests/compare.py [name-prefix …]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = []
    for row in pdf.itertuples(index=False, name=None):
        out = []
        for v in row:
            if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
                out.append(None)
            elif hasattr(v, "isoformat"):
                out.append(pd.Timestamp(v).isoformat())
            elif hasattr(v, "item"):
                out.append(v.item())
            else:
                out.append(v)
        rows.append(tuple(out))
    return sorted(rows, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def _kind(t: str) -> str:
    t = t.lower()
    return {"integer": "int", "varchar": "string", "bigint": "bigint", "double": "double", "date": "date", "timestamp_ntz": "timestamp"}.get(t, t)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when equal."""
    rel = con.sql(sql)
    left = {c: _kind(t) for c, t in df.dtypes}
    right = {c: _kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    problems = []
    if left != right:
        problems.append(f"schema {sorted(set(left.items()) ^ set(right.items()))}")
        if set(left) != set(right):
            return problems
    cols = sorted(left)
    a = sorted_rows = _canonical(pd.DataFrame([r.asDict() for r in df.collect()], columns=cols, dtype=object))
    b = _canonical(pd.DataFrame(rel.fetchall(), columns=rel.columns, dtype=object))
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} of {len(sorted_rows)} rows differ, e.g. spark {bad[0][0]} sql {bad[0][1]}")
    return problems


def main(prefixes: list[str]) -> int:
    from wattloom.catalog import ORACLE, QUERIES
    from wattloom.session import build_session

    sf_dir = f"{DATA}/sf{os.environ.get('SF', '0.01')}"
    tuned = {} if os.environ.get("PLAIN") else {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", **tuned})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problems = compare(df, con, ORACLE[name]) if name in ORACLE else []
            note = "" if name in ORACLE else f"rows only: {df.count()}"
        except Exception as e:
            problems, note = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {note} {'; '.join(problems)}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
