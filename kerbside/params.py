"""Parameters shared by the batch and the streaming side.

Both sides must agree on the grid and on the slots, or live positions would look up the wrong
hotspots, so they travel together in two small frozen objects.
"""

from __future__ import annotations

from dataclasses import dataclass

# They decide which results come out, so they must not drift.
TOP_N = 10  # spots kept per cell and slot
PICKS = 3  # spots suggested to one vehicle
SEED_BASE = 4040  # added to the vehicle id before drawing
MOST_WEIGHT = 2**40  # a larger weight, which only a damaged line can cause, counts as this in a draw
MAX_SEED = 2**32 - 1  # a draw with a seed outside 0..MAX_SEED gives no suggestion
KEY_FACTOR = 137  # message key = (row * KEY_FACTOR + column) mod KEY_MODULUS
KEY_MODULUS = 77703
TILE_DEGREES = 0.005  # side of one map tile
PLAYBACK_START = 590  # minutes: 09:50
PLAYBACK_END = 1320  # minutes: 22:00
CLOCK_BUCKET = 360  # minutes of the month that one task looks through for one vehicle
MONTH_MINUTES = 31 * 1440
YEARS_PER_COPY = 7
JITTER_SECONDS = 250  # pick-up time moves by [-250, 250) seconds
JITTER_STEPS = 10  # coordinates move by [-10, 10) steps
STEPS_PER_DEGREE = 100000  # one step is 1e-5 degrees
EXTRA_PASSENGER_ONE_IN = 4  # one copy in four gets one passenger more


@dataclass(frozen=True)
class Grid:
    """A square grid of cells, each made of ``subs_per_cell`` x ``subs_per_cell`` sub-cells."""

    origin_lon: float = -74.25
    origin_lat: float = 40.5
    sub_size: float = 0.00025
    subs_per_cell: int = 20


@dataclass(frozen=True)
class Slots:
    """Equal slots of the day. Their length must divide the day, or the last one would be another."""

    minutes: int = 10

    def __post_init__(self) -> None:
        if self.minutes < 1 or 24 * 60 % self.minutes:
            raise ValueError(f"slots of {self.minutes} minutes do not divide a day")

    @property
    def count(self) -> int:
        return 24 * 60 // self.minutes


GRID = Grid()
SLOTS = Slots()
