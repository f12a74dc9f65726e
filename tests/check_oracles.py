"""Compare every registered query with its oracle: python tests/check_oracles.py [folder] [names]."""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from __spark_entry__ import oracle_sql, queries  # noqa: E402


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return float(repr(value))
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, name, sf_dir):
    """(same?, detail) for one query."""
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    result = con.execute(oracle_sql()[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return False, f"{len(got[1])} rows != {len(want[1])}"
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return not wrong, f"{len(wrong)} of {len(got[1])} differ, first {wrong[:2]}" if wrong else (
        f"{len(got[1])} rows")


if __name__ == "__main__":
    from conftest import make_session

    session = make_session()
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    bad = 0
    for key in sys.argv[2:] or queries():
        started = time.time()
        try:
            same, detail = compare(session, key, folder)
        except Exception as error:  # report and go on with the next query
            same, detail = False, str(error)[:600]
        bad += not same
        print(f"{'ok  ' if same else 'FAIL'} {key} {time.time() - started:.1f}s {detail}", flush=True)
    print(f"{bad} failed")
