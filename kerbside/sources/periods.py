"""Amplified lines as text, one folder per month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbside.sources.tables import cluster_by

PERIOD = ("period_year", "period_month")


def write_csv_period(lines: DataFrame, path: str, mode: str = "overwrite", gather: bool = False) -> None:
    """Writes column ``value`` below ``period_year=.../period_month=...`` in one job for all months.

    Input files usually hold a month each, so a task writes to one or two folders as it is, without a shuffle.
    ``gather`` brings the rows of a month together first, for input in which months are mixed; a large
    month is still split so that no task holds a whole one.
    """
    rows = lines.select("value", *PERIOD)
    laid_out = cluster_by(rows, PERIOD) if gather else rows
    laid_out.write.mode(mode).partitionBy(*PERIOD).text(path)
