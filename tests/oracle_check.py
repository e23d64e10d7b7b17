"""Compare the queries with their SQL: ``python tests/oracle_check.py <sf_dir> [name ...]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name):
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, res.fetchall())
    if got == want:
        return None if got else "both empty"
    extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return f"{len(got)} rows != {len(want)}; spark only {extra}; sql only {missing}; columns {sorted(names)}"


if __name__ == "__main__":
    from orderloom.session import build_session
    sf_dir = sys.argv[1]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            verdict = compare(spark, con, sf_dir, name) or "ok"
        except Exception as e:  # report and go on with the next query
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s  {verdict[:1500]}", flush=True)
