"""More trips from given ones: copies moved back by whole years, with small controlled noise.

Each row is read once and exploded into its copies; nothing is shuffled. One digest per copy is dealt
into four draws: seconds, extra passenger, steps east, steps north.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import hashing
from kerbside.functions.clock import parse_datetime
from kerbside.functions.numbers import parse_float, parse_int
from kerbside.operators.cleaning import drop_invalid
from kerbside.operators.staging import compute_once
from kerbside.params import (
    EXTRA_PASSENGER_ONE_IN,
    JITTER_SECONDS,
    JITTER_STEPS,
    STEPS_PER_DEGREE,
    YEARS_PER_COPY,
)

COPIES = (1, 2)
FIRST_YEAR = 1900  # fixed value: earlier dates cannot be written and drop the row
# Positions of the changed fields in a trip line.
PICKUP, DROPOFF, PASSENGERS, LONGITUDE, LATITUDE = 1, 2, 3, 5, 6
BLANKS = " \t\n\x0b\f\r"


def years_back(moment: Column, years: Column) -> Column:
    """The same day and time some years earlier; null for a 29 February that does not exist."""
    earlier = moment - F.make_ym_interval(years)
    # Interval arithmetic would settle for the 28th.
    return F.when(F.dayofmonth(earlier) == F.dayofmonth(moment), earlier)


def move_coordinate(degrees: Column, steps: Column) -> Column:
    """Moves a coordinate by whole steps, kept to twelve significant digits."""
    moved = degrees + steps / F.lit(float(STEPS_PER_DEGREE))
    return (
        F.when(F.abs(moved) < 10, F.round(moved, 11))
        .when(F.abs(moved) < 100, F.round(moved, 10))
        .otherwise(F.round(moved, 9))
    )


def copies_of(df: DataFrame, key: Sequence[Column], copies: Sequence[int], seed: int) -> DataFrame:
    """One row per copy with its noise: ``seconds``, ``extra``, ``east`` and ``north``."""
    each = df.withColumn("copy", F.explode(F.array(*[F.lit(copy) for copy in copies])))
    number = hashing.leading(hashing.digest(F.lit(seed), F.col("copy"), *key), 15)
    sizes = (2 * JITTER_SECONDS, EXTRA_PASSENGER_ONE_IN, 2 * JITTER_STEPS, 2 * JITTER_STEPS)
    seconds, extra, east, north = hashing.deal(F.col("number"), sizes)
    return (
        compute_once(each, {"number": number})
        .withColumns(
            {
                "seconds": seconds - JITTER_SECONDS,
                "extra": extra == EXTRA_PASSENGER_ONE_IN - 1,
                "east": east - JITTER_STEPS,
                "north": north - JITTER_STEPS,
            }
        )
        .drop("number")
    )


def shift_trip(df: DataFrame) -> DataFrame:
    """Moves ``pickup_at`` by 7 years back per ``copy`` and by ``seconds``, and ``dropoff_at`` with it.

    Adds ``period_year`` and ``period_month``, the moved period before the noise, under which the copy
    is filed. Impossible dates drop the row.
    """
    moved = compute_once(df, {"moved": years_back(F.col("pickup_at"), F.col("copy") * YEARS_PER_COPY)})
    start = F.col("moved") + F.make_dt_interval(secs=F.col("seconds"))
    timed = compute_once(
        moved.withColumnsRenamed({"pickup_at": "old_pickup_at", "dropoff_at": "old_dropoff_at"}),
        {"pickup_at": start, "dropoff_at": start + (F.col("old_dropoff_at") - F.col("old_pickup_at"))},
    )
    possible = timed.filter((F.year("pickup_at") >= FIRST_YEAR) & (F.year("dropoff_at") >= FIRST_YEAR))
    periods = {"period_year": F.year("moved"), "period_month": F.month("moved")}
    return possible.withColumns(periods).drop("moved", "old_pickup_at", "old_dropoff_at")


def amplify(trips: DataFrame, key: Sequence[str], copies: Sequence[int] = COPIES, seed: int = 0) -> DataFrame:
    """Noisy copies of typed trips; ``key`` names the columns that tell trips apart.

    Every column is kept. ``copy``, ``period_year`` and ``period_month`` are added.
    """
    times = {"pickup_at": parse_datetime(F.col("datetime")), "dropoff_at": parse_datetime(F.col("dropoff"))}
    timed = copies_of(compute_once(trips, times), [F.col(name) for name in key], copies, seed)
    whole = drop_invalid(shift_trip(timed), "passengers", "longitude", "latitude")
    passengers = F.col("passengers")
    noisy = whole.withColumns(
        {
            "datetime": F.col("pickup_at").cast("string"),
            "dropoff": F.col("dropoff_at").cast("string"),
            "passengers": F.when(F.col("extra"), F.coalesce(F.try_add(passengers, F.lit(1)), passengers)).otherwise(passengers),
            "longitude": move_coordinate(F.col("longitude"), F.col("east")),
            "latitude": move_coordinate(F.col("latitude"), F.col("north")),
        }
    )
    return noisy.drop("pickup_at", "dropoff_at", "seconds", "extra", "east", "north")


def amplify_lines(lines: DataFrame, copies: Sequence[int] = COPIES, seed: int = 0) -> DataFrame:
    """The same for comma text in column ``value``: all other fields of a line stay as they are.

    Gives ``value``, ``copy``, ``period_year`` and ``period_month``. As a passenger count is only read
    when it is raised, text that is no number drops a line only then.
    """
    field = [F.get(F.col("fields"), at) for at in range(LATITUDE + 1)]
    trimmed = compute_once(lines.select("value"), {"line": F.btrim(F.col("value"), F.lit(BLANKS))})
    split = compute_once(trimmed.select("line"), {"fields": F.split("line", ",")})
    # Everything that does not depend on the copy is read before the copies are made.
    read = compute_once(
        split,
        {
            "pickup_at": parse_datetime(field[PICKUP]),
            "dropoff_at": parse_datetime(field[DROPOFF]),
            "passengers": parse_int(field[PASSENGERS]),
            "longitude": parse_float(field[LONGITUDE]),
            "latitude": parse_float(field[LATITUDE]),
        },
    )
    usable = drop_invalid(read, "pickup_at", "dropoff_at", "longitude", "latitude")
    shifted = shift_trip(copies_of(usable, [F.col("line")], copies, seed))
    raised = (F.col("passengers").cast("decimal(20,0)") + 1).cast("string")  # may pass the largest bigint
    noisy = compute_once(
        shifted, {"carried": F.when(F.col("extra"), raised).otherwise(field[PASSENGERS])}
    )
    changed = {
        PICKUP: F.col("pickup_at").cast("string"),
        DROPOFF: F.col("dropoff_at").cast("string"),
        PASSENGERS: F.col("carried"),
        LONGITUDE: move_coordinate(F.col("longitude"), F.col("east")).cast("string"),
        LATITUDE: move_coordinate(F.col("latitude"), F.col("north")).cast("string"),
    }
    head = [changed.get(at, field[at]) for at in range(LATITUDE + 1)]
    tail = F.slice(F.col("fields"), F.lit(LATITUDE + 2), F.size("fields") - (LATITUDE + 1))
    return drop_invalid(noisy, "carried").select(
        F.array_join(F.concat(F.array(*head), tail), ",").alias("value"), "copy", "period_year", "period_month"
    )
