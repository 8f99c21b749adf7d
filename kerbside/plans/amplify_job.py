"""Amplification job: trip text in, noisy copies out, one folder per month, all months in one job.

    spark-submit kerbside/plans/amplify_job.py --input 'trips/*.csv' --output copies
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from kerbside.operators.amplification import amplify_lines
from kerbside.session import build_session
from kerbside.sources.periods import write_csv_period
from kerbside.sources.text import read_lines


def run(spark: SparkSession, paths: str | list[str], target: str, seed: int = 0) -> None:
    write_csv_period(amplify_lines(read_lines(spark, paths), seed=seed), target)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--seed", type=int, default=0)
    given = args.parse_args()
    run(build_session("amplify"), given.input, given.output, given.seed)


if __name__ == "__main__":
    main()
