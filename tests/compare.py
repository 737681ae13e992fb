"""Runs the registered queries next to their SQL and reports every difference.

    python tests/compare.py [sf_dir] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a description of the first differences."""
    df = query(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = _rows(names, rel.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), entry.oracle_sql()
    failed = []
    for name, q in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, q, sqls.get(name), sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        kind = "SQL" if name in sqls else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind:4} {name:28} {time.time() - start:6.2f}s "
              f"{(problem or '')[:900]}", flush=True)
        failed += [name] if problem else []
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
