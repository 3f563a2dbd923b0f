"""Runs registered queries against their SQL: ``python -m tests.compare sf0.01 [name ...]``."""

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    if isinstance(value, Decimal):
        return value.normalize() + 0
    return value


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def compare(spark, con, query, sql, sf_dir):
    """None when equal, else a text that shows the difference."""
    frame = query(spark, sf_dir)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if ours == theirs:
        return None if ours else "no rows"
    only = [r for r in ours if r not in set(theirs)][:3], [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} rows against {len(theirs)}; only ours {only[0]}; only SQL {only[1]}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from sunledger.session import build_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), oracle_sql()
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.monotonic()
        try:
            problem = compare(spark, con, run, sql[name], sf_dir) if name in sql else "no SQL"
        except Exception as error:  # show every query's state, whatever fails
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.monotonic() - started:6.1f}s {problem or 'equal'}", flush=True)
