"""Positions meet hotspots on (time_slot, block_latid, block_lonid)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.operators.cleaning import SPOT_KEYS
from kerbside.params import MOST_WEIGHT
from kerbside.session import scratch_dir

HEAVY_ROWS = 100_000  # positions of one slot and cell that one task takes
MOST_HEAVY = 10_000  # keys that may be cut into shares
TRACKED = 65_536  # keys that the summary of frequent ones follows


def to_spots(lon: Column, lat: Column) -> Column:
    """Parallel coordinate arrays as one array of pairs."""
    return F.transform(
        F.arrays_zip(lon.alias("longitude"), lat.alias("latitude")),
        lambda pair: F.struct(pair["longitude"].alias("longitude"), pair["latitude"].alias("latitude")),
    )


def from_spots(spots: Column) -> tuple[Column, Column]:
    """An array of pairs as parallel arrays again."""
    return spots["longitude"], spots["latitude"]


def slots_present(df: DataFrame) -> list[int]:
    """The slots a batch mentions: one short list, never more than the slots of a day."""
    return sorted(row[0] for row in df.select("time_slot").distinct().collect())


def prune_slots(hotspots: DataFrame, slots: list[int]) -> DataFrame:
    """Only the given slots. As literals on the partition column they prune whole folders."""
    return hotspots.filter(F.col("time_slot").isin(slots)) if slots else hotspots.limit(0)


def key_summary() -> list[Column]:
    """Aggregates for the rows and the frequent keys of positions, in one pass and bounded space.

    The summary follows ``TRACKED`` keys at once and is merged over tasks. It cannot miss a key with more than 3.5 rows in
    ``TRACKED``, and each key that passes ``least_heavy`` has more than that.
    """
    keys = ", ".join(SPOT_KEYS)
    top = F.expr(f"approx_top_k(concat_ws(':', {keys}), {MOST_HEAVY}, {TRACKED})")
    return [F.count(F.lit(1)).alias("total"), top.alias("top")]


def least_heavy(total: int, rows: int) -> int:
    """Rises with the table, so that at most ``MOST_HEAVY`` keys pass it and their list may be sent to all tasks."""
    return max(rows, -(-total // MOST_HEAVY))


def heavy_keys(spark: SparkSession, total: int, top: Sequence[Row] | None, rows: int) -> DataFrame:
    """The keys with more than ``rows`` positions by the summary, and the number of ``shares`` to cut them into."""
    limit = least_heavy(total, rows)
    found = [(*map(int, row["item"].split(":")), -(-row["count"] // limit)) for row in top or [] if row["count"] > limit]
    return spark.createDataFrame(found, ", ".join(f"{key} bigint" for key in SPOT_KEYS) + ", shares int")


def stage_with_heavy(positions: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """The positions written to the shared scratch folder and read again, and their heavy keys, found while they were
    written: whatever they are parsed from is gone through once."""
    spark, seen = positions.sparkSession, Observation("keys of positions")
    path = scratch_dir(spark, "positions")
    positions.observe(seen, *key_summary()).write.parquet(path)
    found = seen.get
    return spark.read.schema(positions.schema).parquet(path), heavy_keys(spark, found["total"], found["top"], rows)


def split_heavy(positions: DataFrame, offers: DataFrame, rows: int = HEAVY_ROWS) -> tuple[DataFrame, DataFrame]:
    """Adds a ``share`` to both sides: rows of a heavy key are dealt over its shares, and only its offers repeated."""
    positions, found = stage_with_heavy(positions, rows)
    heavy = F.broadcast(found)
    keys = list(SPOT_KEYS)
    shares = F.coalesce("shares", F.lit(1))
    # Row hash and input partition are both stable under task retries; the partition number
    # also spreads exact copies of one row.
    spread = F.xxhash64("vehicle_id", "datetime") + F.spark_partition_id()
    dealt = positions.join(heavy, keys, "left").withColumn("share", F.pmod(spread, shares).cast("int")).drop("shares")
    repeated = offers.join(heavy, keys, "left").withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return dealt, repeated.drop("shares")


def draw_columns(weights: Column) -> dict[str, Column]:
    """What draws need of a list of spots: the running ``totals`` of its weights, from 0 on, and how many are ``drawable``.

    No totals if a weight is negative or missing. A weight counts up to ``MOST_WEIGHT``, so that totals are exact as doubles.
    """
    allowed = ~F.exists(weights, lambda weight: F.coalesce(weight, F.lit(-1)) < 0)

    def add(totals: Column, weight: Column) -> Column:
        return F.concat(totals, F.array(F.element_at(totals, -1) + F.least(weight, F.lit(MOST_WEIGHT)).cast("double")))

    totals = F.when(allowed, F.aggregate(weights, F.array(F.lit(0.0)), add))
    return {"totals": totals, "drawable": F.size(F.filter(weights, lambda weight: weight > 0))}


def with_draws(hotspots: DataFrame) -> DataFrame:
    """Hotspots with ``draw_columns``. Worth keeping with hotspots that many batches are answered from."""
    return hotspots if "totals" in hotspots.columns else hotspots.withColumns(draw_columns(F.col("passengers")))


def offers_of(hotspots: DataFrame) -> DataFrame:
    """Stored hotspots under the names that a match gives them, with what draws need, unless they have it already."""
    return with_draws(hotspots).select(
        *SPOT_KEYS,
        F.col("longitude").alias("offer_lon"),
        F.col("latitude").alias("offer_lat"),
        F.col("passengers").alias("weights"),
        "totals",
        "drawable",
    )


def match_spots(
    positions: DataFrame, hotspots: DataFrame, broadcast: str | None = None, salt: int = 1, heavy: int | None = None
) -> DataFrame:
    """Every position with the spots of its slot and cell; a position without spots gives no row.

    The spots stay the parallel arrays ``offer_lon``, ``offer_lat`` and ``weights`` they are stored as; ``totals`` and ``drawable``
    (see ``draw_columns``) serve draws, and cost nothing where they are not selected.

    Neither side is broadcast unless the caller has checked its size and says which (``"positions"``
    or ``"hotspots"``). Otherwise this is a plain equi join: adaptive execution turns it into a
    broadcast if a side proves small, and splits the partition of a busy cell if not. ``salt`` > 1
    spreads every key over that many tasks beforehand, repeating the (small) hotspot rows; it works on
    streams too. ``heavy`` stages the positions, finds frequent keys on the way and spreads just those with more rows than that.
    """
    if broadcast not in (None, "positions", "hotspots"):
        raise ValueError(f"broadcast must be 'positions', 'hotspots' or None, not {broadcast!r}")
    offers = offers_of(hotspots)
    keys = list(SPOT_KEYS)
    if broadcast == "positions":
        positions = F.broadcast(positions)
    elif broadcast == "hotspots":
        offers = F.broadcast(offers)
    elif heavy is not None:
        positions, offers = split_heavy(positions, offers, heavy)
        keys.append("share")
    elif salt > 1:
        spread = F.xxhash64("vehicle_id", "datetime") + F.spark_partition_id()
        positions = positions.withColumn("salt", F.pmod(spread, F.lit(salt)).cast("int"))
        offers = offers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        keys.append("salt")
    joined = positions.join(offers, keys, "inner")
    return joined.withColumn("vehicle_pos", F.array("longitude", "latitude")).drop("salt", "share", "longitude", "latitude")


def arrivals(positions: DataFrame) -> DataFrame:
    """Cleaned positions with ``arrival_no``, their place by time in the list of their slot and cell.

    Positions of the same second share a place. The lists themselves can be huge, so none is built:
    positions are counted per second first, the running total runs over those counts (their number is
    bounded by the calendar), and a join, which adaptive execution may split, hands it back.
    """
    moments = [*SPOT_KEYS, "datetime"]
    before = Window.partitionBy(*SPOT_KEYS).orderBy("datetime").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        positions.groupBy(*moments)
        .agg(F.count("*").alias("together"))
        .withColumn("arrival_no", F.coalesce(F.sum("together").over(before), F.lit(0)) + 1)
        .drop("together")
    )
    return positions.join(starts, moments, "inner")
