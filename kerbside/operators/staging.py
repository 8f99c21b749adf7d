"""Work that must be done once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds columns that later filters read instead of computing them again.

    A filter on a plain computed column is pushed below it with the whole expression copied in, so
    costly text parsing would run once per use. The optimizer leaves the output of a generator alone;
    one row in, one row out, this one costs next to nothing and stays in generated code.
    """
    fields = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(fields)))
