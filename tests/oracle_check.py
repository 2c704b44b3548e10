"""Run every catalogue query in Spark and its SQL twin in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts and sorted row values exactly.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from letramento.plans.catalog import ALL_TABLES  # noqa: E402

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
                 "date": "DATE", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    df = E.queries()[name](spark, sf_dir)
    cols = df.columns
    srows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    ts = time.time() - t0
    sql = E.oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: spark {len(srows)} rows, no oracle ({ts:.1f}s)"
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    dtypes = {d[0]: str(d[1]) for d in rel.description}
    drows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    if sorted(cols) != sorted(dcols):
        return False, f"{name}: columns differ spark={cols} duck={dcols}"
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in idx) for r in drows]
    stypes = dict(df.dtypes)
    bad_types = [(c, stypes[c], dtypes[c]) for c in cols if SPARK_TO_DUCK.get(stypes[c], stypes[c]) != dtypes[c]]
    if len(srows) != len(drows):
        return False, f"{name}: rows spark={len(srows)} duck={len(drows)}"
    a, b = sorted(srows, key=_key), sorted(drows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"{name}: first diff spark={x} duck={y}"
    msg = f"{name}: OK {len(srows)} rows ({ts:.1f}s)"
    if bad_types:
        return False, msg + f" but types differ {bad_types}"
    return True, msg


def main(argv):
    from letramento.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, n, sf_dir)
        except Exception as exc:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
