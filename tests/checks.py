"""Run registered queries next to their SQL and compare the rows."""

import glob
import os
import threading

import duckdb
import pandas as pd


def sql_rows(sql, sf_dir, limit=60):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    timer = threading.Timer(limit, con.interrupt)
    timer.start()
    try:
        return con.execute(sql).df()
    finally:
        timer.cancel()


def normal_form(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = []
    for row in df[cols].itertuples(index=False):
        rows.append(tuple(_value(v) for v in row))
    return cols, sorted(rows, key=repr)


def _value(v):
    if v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if isinstance(v, float) and v == int(v):
        return int(v)
    return v


def compare(spark_df, sql, sf_dir):
    """An empty text when the results agree, else what differs."""
    mine = normal_form(spark_df.toPandas())
    theirs = normal_form(sql_rows(sql, sf_dir))
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if mine[1] != theirs[1]:
        a, b = set(map(repr, mine[1])), set(map(repr, theirs[1]))
        return (
            f"rows {len(mine[1])} vs {len(theirs[1])}; only here {sorted(a - b)[:3]}; "
            f"only in SQL {sorted(b - a)[:3]}"
        )
    return ""
