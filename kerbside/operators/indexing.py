"""A dense 0-based number for every row of a distinct column, without one global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import hashing

BUCKET_DIGITS = 3  # 16^3 = 4096 buckets, an upper bound for the broadcast table below


def hash_index(ids: DataFrame, column: str, seed: int = 0) -> DataFrame:
    """Numbers distinct ids in digest order, as column ``place``.

    Ids are numbered inside 4096 even buckets, made of the first digits of the digest, and every bucket
    starts where the one before ends. Only the bucket sizes, at most 4096 rows, meet in one task.
    """
    hashed = ids.select(column, hashing.digest(F.lit(seed), F.col(column)).alias("digest")).withColumn(
        "bucket", F.substring("digest", 1, BUCKET_DIGITS)
    )
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("bucket")
        .agg(F.count("*").alias("members"))
        .select("bucket", F.coalesce(F.sum("members").over(before), F.lit(0)).alias("start"))
    )
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("digest", column)) - 1
    numbered = hashed.withColumn("inside", inside).join(F.broadcast(starts), "bucket")
    return numbered.select(column, (F.col("start") + F.col("inside")).alias("place"))
