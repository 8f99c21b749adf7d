"""Questions about stored positions or suggestions: who is known, where was everyone, and when.

The clock counts minutes of the month (``functions.clock.minute_of_month``), so every question about the clock
is answered for one month, or for each month by itself. All times are ordered as text ``yyyy-MM-dd HH:mm:ss``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import clock, grid, hashing
from kerbside.operators.indexing import hash_index
from kerbside.operators.staging import compute_once
from kerbside.params import CLOCK_BUCKET, MONTH_MINUTES, PLAYBACK_END, PLAYBACK_START, TILE_DEGREES
from kerbside.session import scratch_dir


def known_vehicles(df: DataFrame) -> DataFrame:
    return df.select("vehicle_id").distinct()


def vehicle_history(df: DataFrame, vehicle_id: str | None = None, order: Sequence[str] = ("datetime",)) -> DataFrame:
    """One vehicle's rows by time, with their minute of the month; all vehicles if none is named."""
    rows = df if vehicle_id is None else df.filter(F.col("vehicle_id") == vehicle_id)
    keys = order if vehicle_id is not None else ("vehicle_id", *order)
    return rows.withColumn("minute", clock.minute_of_month(F.col("datetime"))).orderBy(*keys)


def resolve_ids(requested: DataFrame, known: DataFrame, tracked: DataFrame, seed: int = 0) -> DataFrame:
    """Each requested ``vehicle_id`` with the ``resolved_id`` to show for it.

    A known id stands for itself. An unknown one gets a random known id that is not tracked yet, drawn
    by the digest of the id; null if all are tracked. Draws are independent, so two may coincide.
    """
    # Stored, so that the positions are read once for the three uses below.
    spark = known.sparkSession
    path = scratch_dir(spark, "known-vehicles")
    known.select("vehicle_id").distinct().write.parquet(path)
    members = spark.read.schema("vehicle_id string").parquet(path)
    taken = tracked.select("vehicle_id").distinct()
    free = hash_index(members.join(taken, "vehicle_id", "left_anti"), "vehicle_id", seed)
    total = free.agg(F.count("*").alias("total")).scalar()

    found = requested.join(members, "vehicle_id", "left_semi").withColumn("resolved_id", F.col("vehicle_id"))
    drawn = hashing.leading(hashing.digest(F.lit(seed), F.lit("draw"), F.col("vehicle_id")), 15)
    unknown = requested.join(members, "vehicle_id", "left_anti").withColumn("place", drawn % F.nullif(total, F.lit(0)))
    replaced = unknown.join(free.withColumnRenamed("vehicle_id", "resolved_id"), "place", "left").drop("place")
    return found.unionByName(replaced)


def of_month(df: DataFrame, month: str | None) -> DataFrame:
    """Rows of a month ``yyyy-MM``. The range on the text reaches the scan, and prunes tables laid out by day."""
    if month is None:
        return df
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"a month is yyyy-MM, not {month!r}")
    text = F.col("datetime")
    # Single digits are allowed in a month's number (2008-5-3), and follow the two-digit months as text.
    year, number = month.split("-")
    wanted = text.between(f"{year}-{number}-", f"{year}-{number}-~")
    if number < "10":
        wanted = wanted | text.between(f"{year}-{number[1]}-", f"{year}-{number[1]}-~")
    return df.filter(wanted)


def with_minute(df: DataFrame) -> DataFrame:
    """Adds the month and its minute; a row without a readable time is dropped."""
    timed = compute_once(df, {"moment": clock.parse_datetime(F.col("datetime"))}).filter(F.col("moment").isNotNull())
    month = F.date_format("moment", "yyyy-MM")
    return timed.withColumns({"minute": clock.minute_of_month_at(F.col("moment")), "month": month}).drop("moment")


def record(df: DataFrame, order: Sequence[str]) -> Column:
    """All columns but the vehicle as one struct that sorts by ``order``, then by the rest."""
    rest = [name for name in df.columns if name not in (*order, "vehicle_id", "month")]
    return F.struct(*order, *rest)


def fleet_at(
    df: DataFrame, minute: float, order: Sequence[str] = ("datetime",), month: str | None = None
) -> DataFrame:
    """Where every vehicle is at a clock time: its first row at or after it, else its last row.

    With ``month`` (yyyy-MM) for that month alone, else for each month of the table, named in ``month``.
    One aggregation with a map-side part, so a vehicle with very many rows costs one row per task.
    """
    timed = with_minute(of_month(df, month))
    here = record(timed, order)
    shown = F.coalesce(F.min(F.when(F.col("minute") >= minute, here)), F.max(here))
    return timed.groupBy("vehicle_id", "month").agg(shown.alias("shown")).select("vehicle_id", "month", "shown.*")


def keep_vehicles(reduced: DataFrame, ids: DataFrame) -> DataFrame:
    """Reduced rows of the given vehicles. An inner join with distinct ids: as a semi join the optimizer would
    move it below the aggregation, and the raw rows of all vehicles would be shuffled by vehicle."""
    wanted = ids.select(F.col("vehicle_id").alias("wanted_id")).distinct()
    return reduced.join(wanted, F.col("vehicle_id") == F.col("wanted_id")).drop("wanted_id")


def playback(
    df: DataFrame,
    start: int = PLAYBACK_START,
    end: int = PLAYBACK_END,
    ticks_per_minute: int = 2,
    ids: DataFrame | None = None,
    order: Sequence[str] = ("datetime",),
    month: str | None = None,
) -> DataFrame:
    """``fleet_at`` for every tick from ``start`` to ``end``; ``tick`` counts parts of a minute.

    The opening tick shows the first row of each vehicle, as nothing has been advanced yet. A row is
    then shown from the tick after the previous minute's up to its own, and the last row to the end.
    Rows are first reduced, partly before the shuffle, to the earliest and latest of every vehicle, month and
    minute, with all minutes before or after the range as one each. That leaves at most
    ``end - start + 3`` rows per vehicle and month; only these are matched with ``ids`` and linked up by
    the window. There is no join with the ticks.
    """
    timed = with_minute(of_month(df, month))
    here = record(timed, order)
    reduced = (
        timed.withColumn("at", clamped(start, end))
        .groupBy("vehicle_id", "month", "at")
        .agg(F.min(here).alias("early"), F.max(here).alias("late"))
    )
    if ids is not None:
        reduced = keep_vehicles(reduced, ids)
    return linked(reduced, start, end, ticks_per_minute)


def clamped(start: int, end: int) -> Column:
    """The minute of a row, all before the range as one and all behind it as one."""
    return F.greatest(F.least(F.col("minute"), F.lit(end + 1)), F.lit(start - 1))


def linked(reduced: DataFrame, start: int, end: int, ticks_per_minute: int) -> DataFrame:
    """From the earliest and latest row of every vehicle, month and minute ``at`` to what is shown at each tick."""
    by_time = Window.partitionBy("vehicle_id", "month").orderBy("at")
    before, after = F.lag("at").over(by_time), F.lead("at").over(by_time)
    opening, first, last = (F.lit(tick * ticks_per_minute) for tick in (start, start, end))
    spans = reduced.select(
        "vehicle_id",
        "month",
        "early",
        "late",
        before.isNull().alias("is_first"),
        after.isNull().alias("is_last"),
        (F.greatest(F.coalesce(before * ticks_per_minute, first), first) + 1).alias("from_tick"),
        F.least(F.col("at") * ticks_per_minute, last).alias("to_tick"),
        (F.greatest(F.col("at") * ticks_per_minute, first) + 1).alias("tail_tick"),
        opening.alias("opening"),
        last.alias("last"),
    )

    def ticks(low: Column, high: Column, condition: Column) -> Column:
        return F.when(condition & (low <= high), F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    shown = F.array(
        F.struct(ticks(F.col("opening"), F.col("opening"), F.col("is_first")).alias("ticks"), F.col("early").alias("row")),
        F.struct(ticks(F.col("from_tick"), F.col("to_tick"), F.lit(True)).alias("ticks"), F.col("early").alias("row")),
        F.struct(ticks(F.col("tail_tick"), F.col("last"), F.col("is_last")).alias("ticks"), F.col("late").alias("row")),
    )
    parts = spans.select("vehicle_id", "month", F.explode(shown).alias("part"))
    return parts.select("vehicle_id", "month", F.explode("part.ticks").alias("tick"), F.col("part.row").alias("row")).select(
        "vehicle_id", "month", "tick", "row.*"
    )


def minutes(df: DataFrame, order: Sequence[str] = ("datetime",)) -> DataFrame:
    """The earliest and latest row of every vehicle, month and minute; ``playback_of_minutes`` needs no others."""
    timed = with_minute(df)
    here = record(timed, order)
    return timed.groupBy("vehicle_id", "month", "minute").agg(F.min(here).alias("early"), F.max(here).alias("late"))


def merge_minutes(parts: DataFrame) -> DataFrame:
    """``minutes`` of all rows, from those of parts of them. Parts that come twice change nothing."""
    return parts.groupBy("vehicle_id", "month", "minute").agg(F.min("early").alias("early"), F.max("late").alias("late"))


def playback_of_minutes(
    reduced: DataFrame, start: int = PLAYBACK_START, end: int = PLAYBACK_END, ticks_per_minute: int = 2
) -> DataFrame:
    """``playback`` of the rows that ``minutes`` was made of."""
    inside = reduced.withColumn("at", clamped(start, end)).groupBy("vehicle_id", "month", "at")
    return linked(inside.agg(F.min("early").alias("early"), F.max("late").alias("late")), start, end, ticks_per_minute)


def fleet_at_clocks(
    df: DataFrame, requests: DataFrame, order: Sequence[str] = ("datetime",), bucket: int = CLOCK_BUCKET
) -> DataFrame:
    """``fleet_at`` for many clocks in one pass. ``requests`` holds ``vehicle_id``, ``month`` (yyyy-MM) and ``clock`` (a minute of the month,
    parts of it allowed) and any other columns; each of its rows comes back with the row shown then. A vehicle
    without rows in the month gives none, and neither does a request without a vehicle, month or clock.

    Requests are reduced to distinct minutes. Positions are reduced, partly before the shuffle, once to the earliest and latest
    of each ``bucket`` minutes and once to the earliest of each minute. A first window, over a vehicle and month, takes the
    requests past the buckets: it finds what comes after a request's own bucket and the last row of all, and leaves out requests
    that have no rows. A second, over one bucket, takes them past its minutes. So the longest history is many tasks, no join
    compares a request with positions, and each reduction is alone in its stage: none waits in memory for a second one.
    """
    clock_at = F.col("clock").cast("double")
    inside = F.greatest(F.least(clock_at, F.lit(MONTH_MINUTES + 1.0)), F.lit(-1.0))
    asked = requests.withColumn("asked minute", F.when(clock_at.isNotNull() & ~F.isnan(clock_at), F.ceil(inside).cast("int")))
    distinct = asked.select("vehicle_id", "month", F.col("asked minute").alias("minute")).dropna().distinct()
    bucket_at = F.floor(F.col("minute") / F.lit(float(bucket))).cast("int").alias("bucket")
    timed = with_minute(df)
    here = record(timed, order)
    buckets = timed.groupBy("vehicle_id", "month", bucket_at).agg(F.min(here).alias("early"), F.max(here).alias("late"))
    absent = F.lit(None).cast(buckets.schema["early"].dataType)

    asking = distinct.select("vehicle_id", "month", bucket_at, "minute", absent.alias("early"), absent.alias("late"))
    line = buckets.withColumn("minute", F.lit(None).cast("int")).unionByName(asking)
    # Both windows run backwards: the first with later buckets only, the second with all rows of the request's own minute.
    back = Window.partitionBy("vehicle_id", "month").orderBy(F.desc("bucket"))
    later = F.min("early").over(back.rangeBetween(Window.unboundedPreceding, -1))
    last = F.max("late").over(back.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    passed = line.select("vehicle_id", "month", "bucket", "minute", absent.alias("early"), later.alias("later"), last.alias("last"))
    passed = passed.filter(F.col("minute").isNotNull() & F.col("last").isNotNull())

    # Only vehicles and months somebody asks for. An inner join with distinct keys, as in keep_vehicles.
    pairs = distinct.select(F.col("vehicle_id").alias("wanted_id"), F.col("month").alias("wanted_month")).distinct()
    same = (F.col("vehicle_id") == F.col("wanted_id")) & (F.col("month") == F.col("wanted_month"))
    records = minutes(df, order).join(pairs, same).select(
        "vehicle_id", "month", bucket_at, "minute", "early", absent.alias("later"), absent.alias("last")
    )
    ahead = Window.partitionBy("vehicle_id", "month", "bucket").orderBy(F.desc("minute"))
    ahead = ahead.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = records.unionByName(passed).withColumn("ahead", F.min("early").over(ahead)).filter(F.col("last").isNotNull())
    shown = F.coalesce(F.least("ahead", "later"), "last")
    answers = found.select(
        F.col("vehicle_id").alias("asked vehicle"), F.col("month").alias("asked month"), "minute", shown.alias("shown")
    )
    rows = (
        (F.col("vehicle_id") == F.col("asked vehicle"))
        & (F.col("month") == F.col("asked month"))
        & (F.col("asked minute") == F.col("minute"))
    )
    return asked.join(answers, rows).select(*[F.col(f"`{name}`") for name in requests.columns], "shown.*")


def viewport_tiles(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """The 3 x 3 map tiles around each position: ``tile`` 0..8, row by row, with north, south, east and west."""
    around = [(north, east) for north in range(3) for east in range(3)]
    tiles = F.array(
        *[
            F.struct(F.lit(nth).alias("tile"), F.lit(up).alias("up"), F.lit(right).alias("right"))
            for nth, (up, right) in enumerate(around)
        ]
    )
    corners = df.withColumns(
        {"corner_lon": grid.viewport_corner(F.col(lon)), "corner_lat": grid.viewport_corner(F.col(lat))}
    )
    placed = corners.select("*", F.inline(tiles))
    north, east, size = F.col("corner_lat"), F.col("corner_lon"), F.lit(TILE_DEGREES)
    return placed.withColumns(
        {
            "north": north + F.col("up") * size,
            "south": north + (F.col("up") - 1) * size,
            "east": east + F.col("right") * size,
            "west": east + (F.col("right") - 1) * size,
        }
    ).drop("up", "right")
