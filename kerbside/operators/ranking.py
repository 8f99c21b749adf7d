"""Hotspots: the best pick-up sub-cells per cell and slot, neighbouring cells included.

The plan has three exchanges and no join. Shuffle 1 sums per sub-cell after a map-side sum, so a busy
corner costs one row per task. Shuffles 2 and 3 rank within (cell, slot): ``row_number() <= n`` lets
Spark cut every group to n rows before it is shuffled. No group can grow with the data: a cell has
400 sub-cells, and the second ranking sees at most nine lists of n rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import clock, grid
from kerbside.operators.cleaning import CELL_KEYS, clean_trips
from kerbside.params import GRID, SLOTS, TOP_N, Grid, Slots

LARGEST = 2**63 - 1  # the largest bigint
GROUP = ("cell_x", "cell_y", "time_slot")


def count_pickups(cleaned: DataFrame, cells: Grid = GRID) -> DataFrame:
    """Passengers per sub-cell and slot. The cell follows from the sub-cell, so it is no key.

    One damaged line may claim any number of passengers: a sum that passes the largest bigint stays there.
    """
    total = F.coalesce(F.try_sum(F.col("passengers").cast("bigint")), F.lit(LARGEST))
    sums = cleaned.groupBy("sub_x", "sub_y", "time_slot").agg(total.alias("passengers"))
    return sums.select(
        grid.cell_of(F.col("sub_x"), cells).alias("cell_x"),
        grid.cell_of(F.col("sub_y"), cells).alias("cell_y"),
        "time_slot",
        "sub_x",
        "sub_y",
        "passengers",
    )


def top_spots(counts: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n best sub-cells of every cell and slot, as rank ``rn``. Equal sums go by sub_x, sub_y."""
    best_first = Window.partitionBy(*GROUP).orderBy(F.desc("passengers"), "sub_x", "sub_y")
    return counts.withColumn("rn", F.row_number().over(best_first)).filter(F.col("rn") <= n)


def expand_neighbours(spots: DataFrame, slots: Slots = SLOTS) -> DataFrame:
    """Every spot once for its own cell and slot, and once for each neighbour in the slot before.

    A driver next door needs some minutes to get there, so a neighbour offers its next slot. Each row
    is sent to nine fixed places: a narrow step, never a join.
    """
    targets = F.array(
        *[
            F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(bool(dx or dy)).alias("moved"))
            for dx, dy in grid.surroundings(own=True)
        ]
    )
    slot = F.col("time_slot")
    return spots.withColumn("to", F.explode(targets)).select(
        (F.col("cell_x") + F.col("to.dx")).alias("cell_x"),
        (F.col("cell_y") + F.col("to.dy")).alias("cell_y"),
        F.when(F.col("to.moved"), clock.previous_slot(slot, slots)).otherwise(slot).alias("time_slot"),
        "sub_x",
        "sub_y",
        "passengers",
    )


def merge_neighbours(own: DataFrame, n: int = TOP_N, slots: Slots = SLOTS) -> DataFrame:
    """Ranks every cell's own spots together with those its neighbours offer.

    Lists cut to n beforehand are enough, as a spot among the merged n best is among the n best of its
    own list. Sums are not added again: a sub-cell belongs to one cell and reaches a key once.
    """
    return top_spots(expand_neighbours(own, slots), n)


def fold_spots(ranked: DataFrame, cells: Grid = GRID) -> DataFrame:
    """One row per cell and slot, spots as parallel arrays, best first.

    The groups hold at most n rows and are already partitioned by the ranking: no exchange is added.
    """
    lon, lat = grid.sub_cell_centre(F.col("sub_x"), F.col("sub_y"), cells)
    spot = F.struct("rn", lon.alias("longitude"), lat.alias("latitude"), "passengers")
    folded = ranked.groupBy(*GROUP).agg(F.sort_array(F.collect_list(spot)).alias("spots"))
    return folded.select(
        F.col("cell_x").alias(CELL_KEYS[0]),
        F.col("cell_y").alias(CELL_KEYS[1]),
        "time_slot",
        F.col("spots.longitude").alias("longitude"),
        F.col("spots.latitude").alias("latitude"),
        F.col("spots.passengers").alias("passengers"),
    )


def hotspots(trips: DataFrame, n: int = TOP_N, cells: Grid = GRID, slots: Slots = SLOTS) -> DataFrame:
    """From typed trips (datetime, passengers, longitude, latitude) to the stored hotspot rows."""
    own = top_spots(count_pickups(clean_trips(trips, cells, slots), cells), n)
    return fold_spots(merge_neighbours(own.drop("rn"), n, slots), cells)


def explode_spots(folded: DataFrame) -> DataFrame:
    """Stored hotspot rows as one row per spot, with rank ``rn`` from 1."""
    spots = F.arrays_zip("longitude", "latitude", "passengers")
    return folded.select(*CELL_KEYS, "time_slot", F.posexplode(spots).alias("at", "spot")).select(
        *CELL_KEYS,
        "time_slot",
        (F.col("at") + 1).alias("rn"),
        "spot.longitude",
        "spot.latitude",
        "spot.passengers",
    )


def slot_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("time_slot").agg(F.count("*").alias("row_count"))
