"""Compare every registered query with its DuckDB oracle (like the driver does).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH with row counts and the first issue.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("orders", "customer")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _key(row):
    return tuple((v is None, v or "") for v in row)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key), rel


SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_issues(df, rel):
    duck = {d[0]: str(d[1]) for d in rel.description}
    out = []
    for f in df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck.get(f.name) != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} duck {duck.get(f.name)}")
    return out


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from loanscore.session import local_session

    spark = local_session(8)
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for key, fn in qs.items():
        if only and key not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols, srows = rows_of_spark(df)
            st = time.time() - t0
        except Exception as e:  # noqa: BLE001
            print(f"{key:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        if key not in oracles:
            print(f"{key:32s} NO-ORACLE rows={len(srows)}")
            continue
        try:
            dcols, drows, rel = rows_of_duck(con, oracles[key])
        except Exception as e:  # noqa: BLE001
            print(f"{key:32s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        issue = ""
        types = type_issues(df, rel)
        if types:
            issue = "types " + "; ".join(types)
        if scols != dcols:
            issue = f"columns spark-only={sorted(set(scols)-set(dcols))} duck-only={sorted(set(dcols)-set(scols))}"
        if not issue and len(srows) != len(drows):
            issue = f"rows {len(srows)} vs {len(drows)}"
        elif srows != drows:
            diff = [(a, b) for a, b in zip(srows, drows) if a != b][:1]
            issue = f"values differ, first: {diff}"
        if issue:
            bad += 1
            print(f"{key:32s} MISMATCH {issue[:600]}")
        else:
            print(f"{key:32s} OK rows={len(srows)} spark={st:.2f}s")
    print("bad", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
