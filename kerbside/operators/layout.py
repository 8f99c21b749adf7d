"""Positions and hotspots kept in the same buckets, so that joining them moves no row.

Both tables are written once with ``bucketBy`` on the keys of the match. The join of a bucket needs that bucket of either table
only: no exchange, whatever the size of the tables and without any broadcast. The cost of laying the positions out is
paid once and serves every later match, such as after each update of the hotspots. Inside a bucket rows are sorted by the
keys, and with one file a bucket the join needs no sort either.

A bucket with a busy cell stays one task here. Heavy keys are therefore cut into shares before the rows are laid out, by the
summary that is taken while they are staged (see ``matching.stage_with_heavy``); the offers of these keys are
repeated for each share, as in ``matching.split_heavy``. The shares are stored in a table of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.cleaning import SPOT_KEYS
from kerbside.operators.matching import HEAVY_ROWS, offers_of, stage_with_heavy

BUCKETS = 512  # of both tables; a bucket of 100 TB of positions is 200 GB, so set more there
KEYS = [*SPOT_KEYS, "share"]


def _write(rows: DataFrame, name: str, buckets: int) -> None:
    # One task for each bucket, so that a bucket is one sorted file.
    spread = rows.repartition(buckets, *KEYS)
    spread.write.mode("overwrite").format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(name)


def store_positions(positions: DataFrame, name: str, buckets: int = BUCKETS, rows: int = HEAVY_ROWS) -> None:
    """Writes cleaned positions as the bucketed table ``name``, and the shares of their heavy keys as ``name``_shares."""
    staged, heavy = stage_with_heavy(positions, rows)
    heavy.write.mode("overwrite").format("parquet").saveAsTable(f"{name}_shares")
    shares = F.coalesce("shares", F.lit(1))
    # Row hash and input partition are both stable under task retries, as in matching.split_heavy.
    spread = F.xxhash64("vehicle_id", "datetime") + F.spark_partition_id()
    dealt = staged.join(F.broadcast(heavy), list(SPOT_KEYS), "left").withColumn("share", F.pmod(spread, shares).cast("int"))
    _write(dealt.drop("shares"), name, buckets)


def store_offers(spark: SparkSession, hotspots: DataFrame, name: str, positions: str, buckets: int = BUCKETS) -> None:
    """Writes hotspots as the bucketed table ``name``, ready to be matched with the table ``positions``."""
    heavy = spark.read.table(f"{positions}_shares")  # at most matching.MOST_HEAVY rows
    shares = F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("share")
    repeated = offers_of(hotspots).join(F.broadcast(heavy), list(SPOT_KEYS), "left").select("*", shares).drop("shares")
    _write(repeated, name, buckets)


def match_stored(spark: SparkSession, positions: str, offers: str) -> DataFrame:
    """The same rows as ``matching.match_spots``, from the two tables, without an exchange."""
    joined = spark.read.table(positions).join(spark.read.table(offers).hint("merge"), KEYS, "inner")
    return joined.withColumn("vehicle_pos", F.array("longitude", "latitude")).drop("share", "longitude", "latitude")
