"""Columns on single values: grid, clock, numbers, keys."""

import math

import pytest
from pyspark.sql import functions as F

from kerbside.functions import clock, grid, hashing
from kerbside.functions.numbers import parse_float, parse_int
from kerbside.operators.cleaning import add_cells, clean_trips
from kerbside.params import Slots


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    ("text", "slot"),
    [
        # Times whose slots must be these, the third without one.
        ("2008-05-13 15:26:35", 92),
        ("2020-07-23 06:23:15", 38),
        ("2008-05-13 15:62:35", None),
        # Forms of a time.
        ("2008-5-3 5:6:7", 30),
        ("2013-03-10 02:30:00", 15),
        ("2013-02-30 02:30:00", None),
        ("2013-03-10  02:30:00", 15),
        ("2013-03- 9 02:30:00", 15),
        ("2013-03- 19 02:30:00", None),
        ("2013-03-10T02:30:00", None),
        ("2013-03-10 02:30", None),
        ("2013-03-10 02:30:00.5", None),
        ("2013-03-10 02:30:00 UTC", None),
        ("2013-03-10 24:00:00", None),
        (" 2013-03-10 02:30:00", None),
        ("2013-03-10 02:30:00\n", None),
        ("0000-03-10 02:30:00", None),
        ("", None),
        (None, None),
    ],
)
def test_time_slot(spark, text, slot):
    assert one(spark, clock.time_slot(F.lit(text).cast("string"))) == (slot,)


def test_slot_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # This hour does not exist in New York.
        assert one(spark, clock.time_slot(F.lit("2013-03-10 02:30:00"))) == (15,)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def cells_of(spark, lon, lat):
    df = spark.createDataFrame([(lon, lat)], "longitude double, latitude double")
    return tuple(add_cells(df).select("cell_x", "cell_y", "sub_x", "sub_y").first())


def test_cell_ids(spark):
    # A place and the ids that it must have.
    assert cells_of(spark, -60.0008, 60.0008) == (2849, 3900, 56996, 78003)


def test_cells_west_and_south_of_the_origin_are_floored(spark):
    cell_x, cell_y, sub_x, sub_y = cells_of(spark, -74.2600, 40.4900)
    assert sub_x < 0 and sub_y < 0
    assert (cell_x, cell_y) == (sub_x // 20, sub_y // 20)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf"), 1e300, None])
def test_unusable_coordinates_have_no_cell(spark, bad):
    assert cells_of(spark, bad, 40.7)[0] is None


@pytest.mark.parametrize("lon", [1e12, -1e12, 2.3e15, -2.3e15, 4e11 + 0.3])
def test_huge_coordinates_keep_their_cell(spark, lon):
    cell_x, _, sub_x, _ = cells_of(spark, lon, 40.7)
    assert sub_x == math.floor((lon + 74.25) / 0.00025) and cell_x == sub_x // 20
    assert one(spark, grid.message_key(F.lit(cell_x), F.lit(cell_x))) == (str((cell_x * 138) % 77703),)


@pytest.mark.parametrize("sub", [0, -1, 19, 20, -20, -21, 2**63 - 1, -(2**63), 2**53 + 1])
def test_cells_are_exact_whole_numbers(spark, sub):
    assert one(spark, grid.cell_of(F.lit(sub).cast("bigint"))) == (sub // 20,)


@pytest.mark.parametrize("minutes", [7, 0, -10, 1441])
def test_slots_must_divide_a_day(minutes):
    with pytest.raises(ValueError):
        Slots(minutes)


def test_unusable_trips_are_dropped(spark):
    rows = [
        ("2013-01-01 00:00:00", 1, -73.9, 40.7),
        ("2013-01-01 00:00:00", 0, -73.9, 40.7),
        ("2013-01-01 00:00:00", None, -73.9, 40.7),
        ("2013-01-01 00:00:00", 1, float("nan"), 40.7),
        ("2013-01-01 00:00:00", 1, None, 40.7),
        ("soon", 1, -73.9, 40.7),
    ]
    trips = spark.createDataFrame(rows, "datetime string, passengers int, longitude double, latitude double")
    assert clean_trips(trips).count() == 1


def test_neighbours(spark):
    x, y = 17, -3
    (around,) = one(spark, grid.neighbours(F.lit(x), F.lit(y)))
    square = {(x + dx, y + dy) for dx in range(-1, 2) for dy in range(-1, 2)}
    assert len(around) == 8 and {(cell.x, cell.y) for cell in around} == square - {(x, y)}


def test_sub_cell_centre_is_exact(spark):
    assert one(spark, *grid.sub_cell_centre(F.lit(83745), F.lit(2304))) == (-53.313625, 41.076125)


def test_message_key(spark):
    assert one(spark, grid.message_key(F.lit(2849), F.lit(3900))) == (str((3900 * 137 + 2849) % 77703),)
    assert one(spark, grid.message_key(F.lit(-5), F.lit(-2))) == (str((-2 * 137 - 5) % 77703),)
    assert one(spark, grid.message_key(F.lit(None).cast("bigint"), F.lit(1))) == (None,)


@pytest.mark.parametrize(
    ("minutes", "label"),
    [(0, "12:00 AM"), (590, "09:50 AM"), (683.5, "11:23 AM"), (720, "12:00 PM"), (785, "01:05 PM"), (1439, "11:59 PM"), (1440, None)],
)
def test_clock_label(spark, minutes, label):
    assert one(spark, clock.clock_label(F.lit(minutes))) == (label,)


def test_minute_of_month(spark):
    assert one(spark, clock.minute_of_month(F.lit("2014-08-02 01:05:59"))) == (1440 + 65,)


@pytest.mark.parametrize("parts", [1, 7, 18, 100, 144])
def test_slot_parts_cover_every_slot_once(spark, parts):
    ranges = clock.part_ranges(parts)
    assert [slot for low, high in ranges for slot in range(low, high + 1)] == list(range(144))
    slots = spark.range(144).select(F.col("id").cast("int").alias("slot"))
    part = clock.slot_part(F.col("slot"), parts)
    low, high = clock.part_range(part, parts)
    assert slots.filter(~F.col("slot").between(low, high)).count() == 0


@pytest.mark.parametrize(
    ("text", "value"), [("3", 3), (" 3 ", 3), ("+3", 3), ("-3", -3), ("3.0", None), ("x", None), ("", None), ("3L", None), ("1_0", None)]
)
def test_parse_int(spark, text, value):
    assert one(spark, parse_int(F.lit(text))) == (value,)


@pytest.mark.parametrize(
    ("text", "value"),
    [("3", 3.0), (" -73.5 ", -73.5), (".5", 0.5), ("5.", 5.0), ("1e2", 100.0), ("3d", None), ("3f", None), ("0x1p3", None), ("", None), ("a", None)],
)
def test_parse_float(spark, text, value):
    assert one(spark, parse_float(F.lit(text))) == (value,)


def test_parse_float_reads_special_numbers(spark):
    nan, inf = one(spark, parse_float(F.lit("NaN")), parse_float(F.lit("-Infinity")))
    assert nan != nan and inf == float("-inf")


def test_deal_reads_independent_digits(spark):
    number = 3 + 500 * (2 + 4 * (7 + 20 * 11))
    assert one(spark, *hashing.deal(F.lit(number), (500, 4, 20, 20))) == (3, 2, 7, 11)
