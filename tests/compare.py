"""Run registered queries next to their SQL and report differences.

Usage: python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return repr(value)


def compare(spark, con, name, query, sql, folder):
    """None when equal, else a short text."""
    df = query(spark, folder)
    cols = sorted(df.columns)
    left = [tuple(_norm(row[c]) for c in cols) for row in df.collect()]
    if sql is None:
        return None if left else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} / {sorted(names)}"
    order = [names.index(c) for c in cols]
    right = [tuple(_norm(row[i]) for i in order) for row in cur.fetchall()]
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    left.sort()
    right.sort()
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ\n     {cols}\n" + "\n".join(f"     spark {a}\n     sql   {b}" for a, b in bad[:3])
    return None if left else "no rows"


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--plain", action="store_true", help="a session with Spark's defaults")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from loomwork.session import get_session

    if args.plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                                  "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args.names or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    failed = []
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, queries[name], sqls.get(name), args.sf)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        took = time.time() - start
        print(f"{'ok  ' if problem is None else 'BAD '} {took:6.2f}s {'sql ' if name in sqls else 'rows'} {name}", flush=True)
        if problem:
            failed.append(name)
            print(f"     {problem}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
