"""Compares a registered query with its SQL on DuckDB, column by column, ignoring row order."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql: str) -> tuple[int, str | None]:
    """Row count and, when they differ, how."""
    want = con.execute(sql)
    want_cols = [d[0] for d in want.description]
    want_types = {d[0]: str(d[1]) for d in want.description}
    want_rows = _rows(want_cols, want.fetchall())
    got_rows = _rows(spark_df.columns, spark_df.collect())
    if sorted(spark_df.columns) != sorted(want_cols):
        return len(got_rows), f"columns {sorted(spark_df.columns)} vs {sorted(want_cols)}"
    if len(got_rows) != len(want_rows):
        return len(got_rows), f"rows {len(got_rows)} vs {len(want_rows)}"
    for g, w in zip(got_rows, want_rows):
        if g != w:
            return len(got_rows), f"columns {sorted(want_cols)}\n   got  {g}\n   want {w}"
    names = {"BIGINT": "bigint", "NUMBER": None, "INTEGER": "int", "VARCHAR": "string", "STRING": "string",
             "DATE": "date", "TIMESTAMP": "timestamp_ntz", "DATETIME": "timestamp_ntz", "DOUBLE": "double"}
    odd = [(c, t, want_types[c]) for c, t in spark_df.dtypes if names.get(want_types[c], t) not in (None, t)]
    return len(got_rows), f"types {odd}" if odd else None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from conftest import make_session

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = make_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls = e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            n, diff = compare(df, con, sqls[name]) if name in sqls else (df.count(), None)
        except Exception as err:  # noqa: BLE001
            n, diff = -1, f"{type(err).__name__}: {str(err)[:600]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name:32s} {n:8d} rows {time.time() - t0:6.2f}s {'' if name in sqls else '(rows only)'} {diff or ''}", flush=True)
    print("mismatches:", bad)
