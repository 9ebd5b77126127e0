"""Compare registered queries with their SQL form on DuckDB."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, fn, sql):
    """None if equal, otherwise what differs."""
    df = fn(spark, sf_dir)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    types = dict(zip(names, [str(d[1]) for d in rel.description]))
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    wrong = [f"{c}: {t} vs {types[c]}" for c, t in df.dtypes if TYPES.get(t, t) != types[c]]
    a, b = canonical(got, df.columns), canonical(want, names)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; types {wrong}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"{len(diff)} of {len(a)} rows differ; spark {only_a} sql {only_b}; types {wrong}"
    if wrong:
        return f"types {wrong}"
    return None


def main(names, sf_dir="/root/testdata/sf0.01"):
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from tests.conftest import make_spark

    spark, con = make_spark(), connect(sf_dir)
    queries, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, sf_dir, name, fn, sqls[name])
            else:
                problem = None if fn(spark, sf_dir).count() >= 0 else "?"
        except Exception as err:  # report and go on
            problem = f"{type(err).__name__}: {str(err)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:28s} {time.time() - start:6.2f}s "
              f"{'' if name in sqls else '(rows only) '}{problem or ''}", flush=True)
    print("bad:", bad, "of", len(queries))
    return bad


if __name__ == "__main__":
    main(sys.argv[1:])
