"""Compare registered queries with their oracle SQL; also runs as a script.

python tests/compare.py FOLDER [QUERY ...]
"""

from __future__ import annotations

import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(folder, f"{t}.parquet")
        if os.path.isdir(path):
            path = os.path.join(path, "*.parquet")
        if os.path.exists(os.path.join(folder, f"{t}.parquet")):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, folder: str, name: str, query, sql: str) -> str:
    """``""`` if equal, else what differs."""
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    cur = connect(folder).execute(sql)
    want_names = [d[0] for d in cur.description]
    want = rows_of(want_names, cur.fetchall())
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} / {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else ""


if __name__ == "__main__":
    import time

    import __spark_entry__ as entry
    from packwatch.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            **dict(kv.split("=") for kv in os.environ.get("SPARK_SETTINGS", "").split() if kv),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            verdict = compare(spark, folder, name, query, oracles[name]) or "same"
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{name:26s} {time.time() - start:6.2f}s {verdict}", flush=True)
