"""Run every registered query against its SQL: python tests/check_queries.py [sf_dir] [names...]."""

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def kinds(con, sql):
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    return {r[0]: r[1] for r in described}


SAME_KIND = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT"}


def compare(spark, con, sf_dir, name):
    """None if the query matches its SQL, else what differs."""
    df = queries()[name](spark, sf_dir)
    got_columns, got = rows_of(df.columns, df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} vs {want_columns}"
    want_kinds = kinds(con, sql)
    for column, kind in df.dtypes:
        if SAME_KIND.get(kind) != want_kinds[column]:
            return f"type of {column}: {kind} vs {want_kinds[column]}"
    if got != want:
        only = [r for r in set(got) - set(want)][:3], [r for r in set(want) - set(got)][:3]
        return f"{len(got)} vs {len(want)} rows; only here {only[0]}; only there {only[1]}"
    return None if got else "no rows"


if __name__ == "__main__":
    from millrace.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    extra = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"}
    if os.environ.get("ROWS_PER_TASK"):
        extra["spark.millrace.rowsPerTask"] = os.environ["ROWS_PER_TASK"]
    session = build_session("check", "local[8]", extra)
    session.sparkContext.setLogLevel("ERROR")
    db, bad = database(sf), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(session, db, sf, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
