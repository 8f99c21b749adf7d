"""Batch job: trip text in, hotspot table out.

    spark-submit kerbside/plans/hotspot_job.py --input 'trips/*.csv' --output hotspots
    spark-submit kerbside/plans/hotspot_job.py --input 'trips/*.csv' \\
        --output jdbc:postgresql://host/fleet --table hotspots --properties connection.properties
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.cleaning import CELL_KEYS
from kerbside.operators.ranking import hotspots
from kerbside.params import TOP_N
from kerbside.session import build_session
from kerbside.sources.tables import Table, add_table_options, named_table, write_table
from kerbside.sources.text import read_lines, trips_from_lines


def hotspots_from_text(spark: SparkSession, paths: str | list[str], n: int = TOP_N) -> DataFrame:
    return hotspots(trips_from_lines(read_lines(spark, paths)), n)


def run(
    spark: SparkSession, paths: str | list[str], target: Table, n: int = TOP_N, mode: str = "overwrite"
) -> dict[str, int]:
    """Runs the job and returns how many rows and spots were written, counted while writing."""
    written = Observation("hotspots")
    rows = hotspots_from_text(spark, paths, n)
    counted = rows.observe(
        written, F.count("*").alias("rows"), F.coalesce(F.sum(F.size("passengers")), F.lit(0)).alias("spots")
    )
    write_table(counted, target, mode, sort_by=CELL_KEYS)
    return written.get


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True)
    args.add_argument("--output", required=True, help="a folder or a jdbc: address")
    add_table_options(args)
    args.add_argument("--top", type=int, default=TOP_N)
    given = args.parse_args()
    print(run(build_session("hotspots"), given.input, named_table(given.output, given), given.top))


if __name__ == "__main__":
    main()
