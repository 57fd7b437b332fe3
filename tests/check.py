"""Run registered queries next to their SQL and compare: ``python tests/check.py [folder] [name ...]``."""

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def sql_rows(folder, sql):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    result = con.sql(sql)
    return comparable(result.columns, result.fetchall())


def spark_rows(df):
    return comparable(df.columns, [tuple(r) for r in df.collect()])


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def main(folder, names):
    import __spark_entry__ as e
    from postwave.session import build_session

    cores = os.environ.get("CHECK_CPUS", "8")
    spark = build_session(f"local[{cores}]", shuffle_partitions=8, driver_memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    queries, sql = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or queries:
        began = time.time()
        try:
            got = spark_rows(queries[name](spark, folder))
            took, began = time.time() - began, time.time()
            if name not in sql:
                print(f"{name:32} rows={len(got[1])} spark={took:.1f}s no sql", flush=True)
                continue
            want = sql_rows(folder, sql[name])
        except Exception as error:
            print(f"{name:32} ERROR {str(error)[:700]}", flush=True)
            bad += 1
            continue
        same = got == want
        print(f"{name:32} {'ok ' if same else 'DIFF'} rows={len(got[1])}/{len(want[1])} "
              f"spark={took:.1f}s sql={time.time() - began:.1f}s", flush=True)
        if not same:
            bad += 1
            shown = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]
            print("   ", got[0], want[0], str(shown)[:900], flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*(sys.argv[1:2] or ["/root/testdata/sf0.01"]), sys.argv[2:]) else 0)
