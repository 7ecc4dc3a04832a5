"""Compare registered queries with their SQL on the driver tables: ``python -m tests.oracle [sf] [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _cell(v):
    if v is None:
        return "\0"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_cell(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    t = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    spent = time.time() - t
    if sql is None:
        return ("ROWS" if got else "EMPTY"), len(got), spent, ""
    t = time.time()
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    want = rel.fetchall()
    duck_s = time.time() - t
    if sorted(df.columns) != sorted(columns):
        return "COLUMNS", len(got), spent, f"{df.columns} vs {columns}"
    types = dict(zip(columns, [str(d[1]) for d in rel.description]))
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return "DIFF", len(got), spent, f"{len(a)} vs {len(b)} rows {diff}"
    note = f"duck {duck_s:.1f}s" if duck_s > 5 else ""
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for c, k in df.dtypes:
        if k in kinds and types[c] != kinds[k]:
            note += f" type {c}: {k} vs {types[c]}"
    return ("OK" if got else "EMPTY"), len(got), spent, note


def main():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as e
    from tests.conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    spark, con = make_session(), duck(sf_dir)
    bad = 0
    for name, fn in e.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            status, n, spent, note = compare(spark, con, sf_dir, name, fn, e.oracle_sql().get(name))
        except Exception as err:  # report and go on
            status, n, spent, note = "ERROR", 0, 0.0, f"{type(err).__name__}: {str(err)[:1500]}"
        bad += status not in ("OK", "ROWS")
        print(f"{status:8}{name:32}{n:8} rows {spent:6.2f}s {note}", flush=True)
    print("not matching:", bad)


if __name__ == "__main__":
    main()
