"""Runs queries next to their SQL counterparts and reports every difference.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.registry import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def in_order(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), kind="stable", na_position="first").reset_index(drop=True)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """What differs, or None. Values must be exactly equal, doubles included."""
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = connection.execute(ORACLES[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)} rows"
    if ours.empty:
        return "no rows"
    left, right = in_order(ours), in_order(theirs)
    for column in left.columns:
        if left[column].dtype.kind != right[column].dtype.kind:
            return f"{column}: {left[column].dtype} and {right[column].dtype}"
        unequal = ~((left[column] == right[column]) | (left[column].isna() & right[column].isna()))
        if unequal.any():
            at = unequal.idxmax()
            return f"{column}: {unequal.sum()} values, first {left.loc[at].to_dict()} and {right.loc[at].to_dict()}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from kerbside.session import build_session

    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("compare", "local[8]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        began = time.time()
        try:
            found = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:22s} {time.time() - began:6.1f}s  {found or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
