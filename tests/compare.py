"""Compare a Spark query with its SQL on the same parquet tables."""

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]")
        elif frame[name].dtype == object:
            frame[name] = frame[name].where(frame[name].notna(), None)
    return frame.sort_values(list(frame.columns), ignore_index=True)


def assert_same(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> None:
    left, right = canonical(spark_frame), canonical(sql_frame)
    assert list(left.columns) == list(right.columns)
    assert len(left) == len(right), (len(left), len(right))
    pd.testing.assert_frame_equal(left, right, check_dtype=True)
