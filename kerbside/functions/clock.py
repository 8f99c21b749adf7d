"""Time of day, slots and clock labels. Nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.params import SLOTS, Slots

# The accepted date-time text. Single digits are fine; LOOSE also lets the gap be any
# white space and a blank stand for the leading zero of the day.
USUAL_TIME = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\z"
LOOSE_TIME = (
    r"^(?!0000)([0-9]{4}-[0-9]{1,2}-)(?: (?=[1-9]\s))?([0-9]{1,2})\s+([0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})\z"
)


def parse_datetime(text: Column) -> Column:
    """Text to a timestamp without zone; null if it is not a real date and time.

    The usual shape goes straight into Spark's own cast, which is far cheaper per row than a
    pattern-driven parser. Only odd lines pay for a rewrite.
    """
    return F.when(text.rlike(USUAL_TIME), text.try_cast("timestamp_ntz")).when(
        text.rlike(LOOSE_TIME),
        F.regexp_replace(text, LOOSE_TIME, "$1$2 $3").try_cast("timestamp_ntz"),
    )


def minute_of_day(moment: Column) -> Column:
    return F.hour(moment) * 60 + F.minute(moment)


def slot_of(moment: Column, slots: Slots = SLOTS) -> Column:
    return F.floor(minute_of_day(moment) / F.lit(float(slots.minutes))).cast("int")


def time_slot(text: Column, slots: Slots = SLOTS) -> Column:
    """Slot of the day of a date-time text, or null."""
    return slot_of(parse_datetime(text), slots)


def previous_slot(slot: Column, slots: Slots = SLOTS) -> Column:
    """The slot before; slot 0 wraps to the last one."""
    return F.pmod(slot - 1, F.lit(slots.count)).cast("int")


def minute_of_month_at(moment: Column) -> Column:
    return minute_of_day(moment) + (F.dayofmonth(moment) - 1) * 1440


def minute_of_month(text: Column) -> Column:
    """Minutes since the month of a date-time text began, or null."""
    return minute_of_month_at(parse_datetime(text))


def clock_label(minutes: Column) -> Column:
    """Minutes of the day as ``01:05 PM``; null outside one day. Parts of a minute are cut."""
    whole = F.floor(minutes.cast("double"))
    hour = F.floor(whole / F.lit(60.0))
    label = F.concat(
        F.lpad((F.pmod(hour + 11, F.lit(12)) + 1).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((whole - hour * 60).cast("string"), 2, "0"),
        F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )
    return F.when((minutes >= 0) & (minutes < 1440), label)


def slot_part(slot: Column, parts: int, slots: Slots = SLOTS) -> Column:
    """Number of the part, out of ``parts``, that holds a slot."""
    return F.floor(slot * parts / F.lit(float(slots.count))).cast("int")


def part_range(part: Column, parts: int, slots: Slots = SLOTS) -> tuple[Column, Column]:
    """First and last slot of a part."""
    width = F.lit(float(slots.count)) / F.lit(float(parts))
    return F.ceil(part * width).cast("int"), (F.ceil((part + 1) * width) - 1).cast("int")


def part_ranges(parts: int, slots: Slots = SLOTS) -> list[tuple[int, int]]:
    """The same ranges as plain numbers, to be pushed into a source."""
    edges = [-(-part * slots.count // parts) for part in range(parts + 1)]
    return [(low, high - 1) for low, high in zip(edges, edges[1:]) if low < high]
