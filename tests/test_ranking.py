"""Hotspots against plain Python, and their edge cases."""

import math
import random
from collections import defaultdict
from datetime import datetime

import pytest

from kerbside.operators import ranking
from kerbside.operators.cleaning import clean_trips

SCHEMA = "datetime string, passengers int, longitude double, latitude double"


def at(x, y):
    """Coordinates inside a sub-cell."""
    return -74.25 + (x + 0.5) * 0.00025, 40.5 + (y + 0.5) * 0.00025


def trip(x, y, time="00:05:00", passengers=1):
    return (f"2013-01-01 {time}", passengers, *at(x, y))


def brute_force(rows, n):
    sums = defaultdict(int)
    for text, passengers, lon, lat in rows:
        if passengers >= 1:
            moment = datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
            sub = math.floor((lon + 74.25) / 0.00025), math.floor((lat - 40.5) / 0.00025)
            sums[sub, (moment.hour * 60 + moment.minute) // 10] += passengers
    lists = defaultdict(list)
    for (sub, slot), total in sums.items():
        lists[sub[0] // 20, sub[1] // 20, slot].append((-total, *sub))
    merged = defaultdict(list)
    for (x, y, slot), spots in lists.items():
        for dx in (-1, 0, 1):
            for dy in (-1, 0, 1):
                merged[x + dx, y + dy, (slot - 1) % 144 if dx or dy else slot] += spots
    return {key: sorted(spots)[:n] for key, spots in merged.items()}


def result(df):
    found = {}
    for row in df.collect():
        subs = [(round((lon + 74.25) / 0.00025 - 0.5), round((lat - 40.5) / 0.00025 - 0.5)) for lon, lat in zip(row.longitude, row.latitude)]
        found[row.block_latid, row.block_lonid, row.time_slot] = [(-p, *s) for p, s in zip(row.passengers, subs)]
    return found


@pytest.fixture(scope="module")
def many():
    draw = random.Random(7)
    return [
        trip(draw.randrange(-30, 60), draw.randrange(-30, 60), f"{draw.choice([0, 11, 23]):02d}:{draw.randrange(60):02d}:00", draw.randrange(4))
        for _ in range(3000)
    ]


@pytest.mark.parametrize("n", [1, 3, 10])
def test_equals_brute_force(spark, many, n):
    assert result(ranking.hotspots(spark.createDataFrame(many, SCHEMA), n)) == brute_force(many, n)


def test_order_and_partitions_of_the_input_do_not_matter(spark, many):
    plain = result(ranking.hotspots(spark.createDataFrame(many, SCHEMA)))
    shuffled = random.Random(1).sample(many, len(many))
    assert result(ranking.hotspots(spark.createDataFrame(shuffled, SCHEMA).repartition(13))) == plain


def test_one_hot_corner_is_summed_before_the_shuffle(spark, many):
    rows = many + [trip(5, 5, "11:00:00", 2)] * 2000
    assert result(ranking.hotspots(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows, 10)


def test_slot_zero_reaches_the_last_slot_of_the_neighbours(spark):
    found = result(ranking.hotspots(spark.createDataFrame([trip(25, 25)], SCHEMA)))
    assert found[1, 1, 0] == [(-1, 25, 25)]
    assert found[2, 2, 143] == [(-1, 25, 25)]
    assert len(found) == 9 and (1, 1, 143) not in found


def test_equal_sums_go_by_sub_cell(spark):
    rows = [trip(x, y) for x in (3, 1, 2) for y in (9, 8)]
    assert result(ranking.hotspots(spark.createDataFrame(rows, SCHEMA), 3))[0, 0, 0] == [(-1, 1, 8), (-1, 1, 9), (-1, 2, 8)]


def test_explode_is_the_inverse_of_fold(spark, many):
    folded = ranking.hotspots(spark.createDataFrame(many, SCHEMA))
    rows = ranking.explode_spots(folded).collect()
    assert len(rows) == sum(len(row.passengers) for row in folded.collect())
    assert min(row.rn for row in rows) == 1 and max(row.rn for row in rows) == 10


def test_plan(spark, plan, many):
    text = plan(ranking.hotspots(spark.createDataFrame(many, SCHEMA)))
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("WindowGroupLimit") == 4
    assert "Join" not in text and "Python" not in text and "partial_try_sum" in text


def test_clean_parses_each_time_once(spark, plan, many):
    text = plan(clean_trips(spark.createDataFrame(many, SCHEMA)))
    assert text.count("RLIKE") == 2  # the usual and the loose shape


def test_a_damaged_line_does_not_stop_the_sums(spark):
    big = 2**63 - 1
    rows = [trip(3, 4, passengers=big), trip(3, 4), trip(3, 5, passengers=big), trip(3, 6, passengers=7)]
    trips = spark.createDataFrame(rows, SCHEMA.replace("passengers int", "passengers bigint")).repartition(3)
    counts = {(r.sub_x, r.sub_y): r.passengers for r in ranking.count_pickups(clean_trips(trips)).collect()}
    assert counts == {(3, 4): big, (3, 5): big, (3, 6): 7}
