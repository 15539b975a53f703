"""Compare registered queries with their SQL: ``python -m tests.oracle_check [sf] [key ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)
    return round(float(v), 6)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, query, sql: str) -> str | None:
    """None when equal, else what differs first."""
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{str(g)[:300]} != {str(w)[:300]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from ticket_topics.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"/root/testdata/{sf}"
    spark = build_session(
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": "8",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(folder), oracle_sql(), 0
    for key, query in queries().items():
        if sys.argv[2:] and key not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if key in oracle:
                diff = compare(spark, con, folder, query, oracle[key])
                state = "equal" if diff is None else f"DIFF {diff}"
            else:
                df = query(spark, folder)
                rows = df.collect()
                state = f"rows {len(rows)} {str(rows[:2])[:300]}"
        except Exception as e:  # report and go on with the other keys
            state = f"ERROR {type(e).__name__} {str(e)[:600]}"
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{key:24s} {time.time() - start:6.1f}s {state}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
