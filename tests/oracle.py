"""Compare the Spark queries with their SQL in DuckDB.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


TIMES = {"sql": 0.0}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}") + 0.0
    return value


def canonical(columns, rows):
    """Rows with columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql):
    """None if both give the same, else what differs; and the number of rows."""
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    start = time.time()
    result = con.execute(sql)
    want = canonical([d[0] for d in result.description], result.fetchall())
    TIMES["sql"] = time.time() - start
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1])
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}", len(got[1])
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"spark {a} != sql {b}", len(got[1])
    kinds = [
        (f.name, f.dataType.simpleString(), str(t))
        for f, t in zip(
            sorted(spark_df.schema.fields, key=lambda f: f.name),
            [d[1] for d in sorted(result.description, key=lambda d: d[0])],
        )
    ]
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "timestamp": "TIMESTAMP", "float": "FLOAT"}
    odd = [k for k in kinds if same.get(k[1], k[1]) != k[2]]
    return (f"types {odd}" if odd else None), len(got[1])


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from assayframe.runtime import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if len(argv) > 1 and name not in argv[1:]:
            continue
        start, TIMES["sql"] = time.time(), 0.0
        try:
            if name in sqls:
                problem, n = compare(fn(spark, sf_dir), con, sqls[name])
            else:
                problem, n = None, len(fn(spark, sf_dir).collect())
        except Exception as e:  # a broken query should not hide the others
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        bad += problem is not None
        kind = "" if name in sqls else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {n:8d} rows {time.time() - start:6.2f}s (sql {TIMES['sql']:.2f}s){kind} {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
