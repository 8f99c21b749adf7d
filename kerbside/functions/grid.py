"""Grid arithmetic as column expressions.

A cell is named by (``cell_x``, ``cell_y``) and a sub-cell by (``sub_x``, ``sub_y``), x from the
longitude and y from the latitude. Stored tables use the public names ``block_latid`` (= cell_x)
and ``block_lonid`` (= cell_y), whose meaning is swapped for historical reasons.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.params import GRID, KEY_FACTOR, KEY_MODULUS, TILE_DEGREES, Grid

# Fixed value: doubles from here on have no bigint. Below it every floored number of steps has one, exactly.
BIGINT_LIMIT = float(2**63)


def sub_cell(degrees: Column, origin: float, grid: Grid = GRID) -> Column:
    """Number of steps from the origin; null for NaN, the infinities and what no bigint can hold."""
    steps = (degrees - F.lit(origin)) / F.lit(grid.sub_size)
    return F.when((steps >= F.lit(-BIGINT_LIMIT)) & (steps < F.lit(BIGINT_LIMIT)), F.floor(steps))


def sub_cell_x(lon: Column, grid: Grid = GRID) -> Column:
    return sub_cell(lon, grid.origin_lon, grid)


def sub_cell_y(lat: Column, grid: Grid = GRID) -> Column:
    return sub_cell(lat, grid.origin_lat, grid)


def cell_of(sub: Column, grid: Grid = GRID) -> Column:
    """Cell that holds a sub-cell; floors, so ids west or south of the origin stay right.

    Whole-number arithmetic, exact over the whole type.
    """
    size = F.lit(grid.subs_per_cell).cast("bigint")
    inside = F.pmod(sub, size)
    # The remainder of the smallest numbers would pass below the type if it were taken off first.
    return F.call_function("div", sub, size) - ((sub < 0) & (inside != 0)).cast("bigint")


def sub_cell_centre(x: Column, y: Column, grid: Grid = GRID) -> tuple[Column, Column]:
    """Longitude and latitude of the middle of a sub-cell."""
    half, size = F.lit(0.5), F.lit(grid.sub_size)
    return F.lit(grid.origin_lon) + (x + half) * size, F.lit(grid.origin_lat) + (y + half) * size


def surroundings(own: bool) -> list[tuple[int, int]]:
    """Offsets of the cells around a cell, with or without the cell itself."""
    return [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if own or dx or dy]


def neighbours(x: Column, y: Column) -> Column:
    """Array of the eight cells around a cell."""
    return F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in surroundings(own=False)])


def message_key(cell_x: Column, cell_y: Column) -> Column:
    """Key that keeps the messages of one cell in one topic partition; null without a cell."""
    # Reduced before they are multiplied, so that no cell id is too large.
    modulus = F.lit(KEY_MODULUS)
    return F.pmod(F.pmod(cell_y, modulus) * KEY_FACTOR + F.pmod(cell_x, modulus), modulus).cast("string")


def viewport_corner(degrees: Column) -> Column:
    """Coordinate snapped down to the tile grid."""
    per_degree = F.lit(float(round(1 / TILE_DEGREES)))
    return F.floor(degrees * per_degree) / per_degree
