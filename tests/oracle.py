"""Comparison of a query's rows with its DuckDB SQL."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(map(repr, frame[columns].itertuples(index=False, name=None)))


def assert_same(spark_frame, sql, sf_dir):
    assert rows(spark_frame.toPandas()) == rows(connect(sf_dir).execute(sql).df())
