"""Helpers of the text operators: staged tables, clash-free columns, tokens, distinct numbering."""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.session import scratch_dir

# The white space that separates words, and the words between it.
SPACE = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))  # A-Z only

ROWS_PER_BATCH = 1000  # rows that a Python worker holds at once; a row is one text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ready(spark: SparkSession) -> None:
    """Before Python runs in tasks: bounds the rows a worker holds, as single texts may be long, and sends this
    package to the executors, which need not have it installed."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))
    context = spark.sparkContext
    if not getattr(context, "_kerbside_sent", False):
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="kerbside-code-")) / "kerbside.zip"  # served by the driver
        with zipfile.ZipFile(target, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(target))
        context._kerbside_sent = True


def fold(column: str, folds: int) -> Column:
    """crc32 of an id as text, modulo the number of folds; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def order_key(*columns: str) -> Column:
    """A 60-bit digest of columns as a whole number, which SQL engines repeat alike."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, 15), 16, 10).cast("bigint")


def ranked(values: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values with their 0-based place in ascending order, nulls last, as ``name``.

    The values are range-partitioned and written in order; a place is the count of rows in the files
    before plus the row's own place. Only the row counts of the files meet in one task.
    """
    spark = values.sparkSession
    path = scratch_dir(spark, "ranked")
    order = F.col(column).asc_nulls_last()
    spread = values.select(column).distinct().repartitionByRange(order).sortWithinPartitions(order)
    spread.write.option("maxRecordsPerFile", 0).parquet(path)
    # One file per task: the part number orders the files as the ranges are ordered.
    stored = spark.read.schema(spread.schema).parquet(path).select(
        column,
        F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("_file"),
        F.col("_metadata.row_index").alias("_at"),
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("_file")
        .agg(F.count("*").alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return stored.join(starts, "_file").select(column, (F.col("_start") + F.col("_at")).alias(name))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, as UTF-8. bytes.split() cuts at exactly the six characters of SPACE."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def chunks(values: list, size: int) -> Iterable[list]:
    for start in range(0, len(values), size):
        yield values[start : start + size]


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places start, start + 1, ... of several ranges, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def quantile_bounds(df: DataFrame, column: str, parts: int) -> list:
    """At most ``parts`` - 1 rising cut points of a numeric column; their number does not grow with the data."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    accuracy = max(10_000, 20 * parts)
    found = df.select(F.percentile_approx(column, shares, accuracy)).first()[0]
    return sorted(set(found or []))


def parts_for(rows: int, per_part: int, most: int) -> int:
    return max(1, min(most, math.ceil(rows / per_part)))
