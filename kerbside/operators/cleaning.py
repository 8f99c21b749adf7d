"""From typed records to rows with a place on the grid and in the day.

Works alike on batch and streaming DataFrames. A step that fails gives null, and one filter at the
end removes the row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import clock, grid
from kerbside.operators.staging import compute_once
from kerbside.params import GRID, SLOTS, Grid, Slots

CELL_KEYS = ("block_latid", "block_lonid")
SPOT_KEYS = ("time_slot", *CELL_KEYS)


def add_cells(df: DataFrame, cells: Grid = GRID) -> DataFrame:
    """Adds sub_x, sub_y, cell_x and cell_y; null where a coordinate is missing or not finite."""
    return df.withColumns(
        {
            "sub_x": grid.sub_cell_x(F.col("longitude"), cells),
            "sub_y": grid.sub_cell_y(F.col("latitude"), cells),
        }
    ).withColumns({"cell_x": grid.cell_of(F.col("sub_x"), cells), "cell_y": grid.cell_of(F.col("sub_y"), cells)})


def add_time_slot(df: DataFrame, slots: Slots = SLOTS) -> DataFrame:
    return df.withColumn("time_slot", clock.time_slot(F.col("datetime"), slots))


def place(df: DataFrame, cells: Grid = GRID, slots: Slots = SLOTS) -> DataFrame:
    """Adds sub_x, sub_y and time_slot, and drops the rows for which one of them is unknown."""
    known = drop_invalid(
        compute_once(
            df,
            {
                "sub_x": grid.sub_cell_x(F.col("longitude"), cells),
                "sub_y": grid.sub_cell_y(F.col("latitude"), cells),
                "moment": clock.parse_datetime(F.col("datetime")),
            },
        ),
        "sub_x",
        "sub_y",
        "moment",
    )
    return known.withColumn("time_slot", clock.slot_of(F.col("moment"), slots)).drop("moment")


def drop_invalid(df: DataFrame, *columns: str) -> DataFrame:
    """Keeps the rows in which every named column has a value. Unlike ``dropna`` it keeps NaN."""
    return df.filter(reduce(and_, [F.col(name).isNotNull() for name in columns]))


def valid_passengers(df: DataFrame) -> DataFrame:
    return df.filter(F.col("passengers") >= 1)


def clean_trips(trips: DataFrame, cells: Grid = GRID, slots: Slots = SLOTS) -> DataFrame:
    """Trips with at least one passenger, a known sub-cell and a known slot."""
    return place(valid_passengers(trips), cells, slots)


def clean_positions(positions: DataFrame, cells: Grid = GRID, slots: Slots = SLOTS) -> DataFrame:
    """Positions with the three keys under which hotspots are stored. Other columns stay."""
    keyed = place(positions, cells, slots).withColumns(
        {CELL_KEYS[0]: grid.cell_of(F.col("sub_x"), cells), CELL_KEYS[1]: grid.cell_of(F.col("sub_y"), cells)}
    )
    return keyed.drop("sub_x", "sub_y")
