"""Spark-vs-DuckDB comparison used by the tests and by ``python -m tests.oracle``."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 12))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return repr(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), sorted(columns)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows, s_names = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows, d_names = rows_of(d_cols, res.fetchall())
    problems = []
    if s_names != d_names:
        problems.append(f"columns {s_names} != {d_names}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} != {len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)


if __name__ == "__main__":
    import sys
    import time

    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from clickrate.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        df = fn(spark, sf_dir)
        if name not in oracles:
            print(f"{name:32s} rows={df.count()} (no oracle) {time.time() - t:.1f}s")
            continue
        problems, n = compare(df, con, oracles[name])
        bad += bool(problems)
        print(f"{name:32s} {'OK ' if not problems else 'BAD'} rows={n} {time.time() - t:.1f}s {'; '.join(problems)}")
    sys.exit(1 if bad else 0)
