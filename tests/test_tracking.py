"""Tracking queries against the plain walk through each vehicle's rows."""

import random
from collections import Counter, defaultdict
from datetime import datetime

import pytest

from kerbside.operators import tracking
from kerbside.operators.indexing import hash_index
from kerbside.plans import tracking_plan

SCHEMA = "vehicle_id string, datetime string, row int"


@pytest.fixture(scope="module")
def moves():
    draw = random.Random(3)
    rows = [
        (f"v{draw.randrange(12)}", f"2014-08-{draw.choice([1, 1, 1, 2]):02d} {draw.choice([0, 9, 10, 12, 21, 22, 23]):02d}:{draw.randrange(60):02d}:{draw.randrange(60):02d}", i)
        for i in range(300)
    ]
    rows += [("early", "2014-08-01 03:00:00", 1000), ("early", "2014-08-01 04:00:00", 1001), ("late", "2014-08-02 23:00:00", 1002)]
    # One vehicle holds a third of all rows, most of them at the same second.
    return rows + [("hot", "2014-08-01 10:00:00", 2000 + i) for i in range(150)] + [("hot", "2014-08-01 11:00:00", 1999)]


def minute(text):
    moment = datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
    return moment.hour * 60 + moment.minute + (moment.day - 1) * 1440


def walk(rows, clocks):
    """Steps forward through the rows of each vehicle as the clock advances."""
    vehicles = defaultdict(list)
    for vehicle, text, number in sorted(rows, key=lambda r: (r[1], r[2])):
        vehicles[vehicle].append((minute(text), number))
    shown = {}
    for vehicle, history in vehicles.items():
        at = 0
        for clock in clocks:
            while history[at][0] < clock and at + 1 < len(history):
                at += 1
            shown[vehicle, clock] = history[at][1]
    return shown


@pytest.mark.parametrize("clock", [0, 590, 600, 1320, 2000, 5000])
def test_fleet_at(spark, moves, clock):
    found = tracking.fleet_at(spark.createDataFrame(moves, SCHEMA).repartition(5), clock, order=("datetime", "row"))
    assert {(r.vehicle_id, clock): r.row for r in found.collect()} == walk(moves, [clock])


def test_playback(spark, moves):
    found = tracking.playback(spark.createDataFrame(moves, SCHEMA).repartition(5), order=("datetime", "row")).collect()
    assert len(found) == len({(r.vehicle_id, r.tick) for r in found})
    ticks = range(1181, 2641)
    expected = walk(moves, [tick / 2 for tick in ticks])
    assert {(r.vehicle_id, r.tick / 2): r.row for r in found if r.tick > 1180} == expected
    # The pass opens with the very first row of each vehicle.
    assert {(r.vehicle_id, -1): r.row for r in found if r.tick == 1180} == walk(moves, [-1])


def test_playback_of_chosen_vehicles(spark, moves):
    ids = spark.createDataFrame([("early",), ("late",), ("nobody",)], "vehicle_id string")
    found = tracking.playback(spark.createDataFrame(moves, SCHEMA), 600, 610, 1, ids).collect()
    assert Counter(r.vehicle_id for r in found) == {"early": 11, "late": 11}
    assert {r.row for r in found if r.vehicle_id == "early" and r.tick > 600} == {1001}


def test_aggregation_before_the_shuffle(spark, moves, plan):
    df = spark.createDataFrame(moves, SCHEMA)
    assert "partial_min" in plan(tracking.fleet_at(df, 600)) and "partial_max" in plan(tracking.fleet_at(df, 600))
    text = plan(tracking.playback(df))
    assert "partial_min" in text and "Join" not in text


def test_fleet_at_clocks(spark, moves, plan):
    """Every vehicle at many clocks, the one with a third of all rows most often; odd requests give nothing."""
    clocks = [-5.0, 0.0, 589.5, 600.0, 600.5, 1319.0, 1320.0, 2000.25, 44_640.0, 1e300]
    vehicles = sorted({row[0] for row in moves})
    asked = [(vehicle, "2014-08", clock, n) for n, (vehicle, clock) in enumerate((v, c) for v in vehicles for c in clocks)]
    asked += [("hot", "2014-08", 600.0, 1000 + n) for n in range(200)]
    odd = [("nobody", "2014-08", 5.0), (None, "2014-08", 5.0), ("hot", None, 5.0), ("hot", "2014-08", None), ("hot", "2014-09", 5.0)]
    odd = [(*row, 5000 + n) for n, row in enumerate([*odd, ("hot", "2014-08", float("nan"))])]
    requests = spark.createDataFrame(asked + odd, "vehicle_id string, month string, clock double, request int").repartition(4)
    df = spark.createDataFrame(moves, SCHEMA).repartition(5)
    for bucket in (1, 60, 360, 100_000):
        found = tracking.fleet_at_clocks(df, requests, ("datetime", "row"), bucket)
        expected = walk(moves, [min(clock, 1e6) for clock in clocks])
        rows = {r.request: (r.vehicle_id, r.month, r.clock, r.row) for r in found.collect()}
        assert rows == {n: (v, m, c, expected[v, min(c, 1e6)]) for v, m, c, n in asked}
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text and "partial_min" in text and "Python" not in text


def test_fleet_at_clocks_equals_fleet_at_on_odd_times(spark):
    """Loosely written times, which sort otherwise as text; empty tables."""
    df = spark.createDataFrame(MONTHS, SCHEMA)
    for clock in (0, 599, 600, 1200, 30_000):
        asked = [(v, m, float(clock)) for v in "ab" for m in ("2014-08", "2014-09")]
        requests = spark.createDataFrame(asked, "vehicle_id string, month string, clock double")
        found = {(r.vehicle_id, r.month): r.row for r in tracking.fleet_at_clocks(df, requests).collect()}
        expected = {(r.vehicle_id, r.month): r.row for r in tracking.fleet_at(df, clock).collect()}
        assert found == {key: expected[key] for key in expected if key[0] in "ab"}
    assert tracking.fleet_at_clocks(df, requests.limit(0)).count() == tracking.fleet_at_clocks(df.limit(0), requests).count() == 0


def most_reductions(node):
    """The largest number of aggregations that lie one behind the other in a stage at or below a node of a plan, and in its own stage."""
    children = [node.children().apply(n) for n in range(node.children().size())]
    below = [(most_reductions(child), "Exchange" in child.nodeName()) for child in children]
    own = max((here for (_, here), shuffled in below if not shuffled), default=0) + ("Aggregate" in node.nodeName())
    return max([own, *(most for (most, _), _ in below)]), own


def test_fleet_at_clocks_reduces_once_a_stage(spark, moves):
    """Distinct requests used to stay in memory while they were sorted for a second reduction of the same stage."""
    requests = spark.createDataFrame([("hot", "2014-08", 600.0)], "vehicle_id string, month string, clock double").repartition(4)
    df = spark.createDataFrame(moves, SCHEMA).repartition(5)
    before = {key: spark.conf.get(key) for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = tracking.fleet_at_clocks(df, requests, ("datetime", "row"))
        assert most_reductions(found._jdf.queryExecution().executedPlan())[0] == 1
        assert [r.row for r in found.collect()] == [walk(moves, [600])["hot", 600]]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_fleet_at_clocks_in_and_around_empty_buckets(spark):
    """Requests in buckets without rows, before, between and behind those with rows; rows and requests of nobody."""
    moves = [("a", "2014-08-01 00:30:00", 1), ("a", "2014-08-01 12:10:00", 2), ("a", "2014-08-01 12:10:30", 3), ("a", "2014-08-03 10:00:00", 4)]
    moves += [("b", "2014-08-02 05:00:00", 5), (None, "2014-08-01 00:00:00", 6), ("a", "2014-08-01 25:00:00", 7), ("c", "2014-08-01 00:00:00", 8)]
    asked = [(v, "2014-08", float(clock)) for v in ("a", "b", "nobody") for clock in range(-10, 4500, 45)]
    requests = spark.createDataFrame([*asked, (None, "2014-08", 0.0)], "vehicle_id string, month string, clock double").repartition(3)
    df = spark.createDataFrame(moves, "vehicle_id string, datetime string, bucket int").repartition(2)
    expected = walk([row for row in moves if row[0] in ("a", "b") and row[2] != 7], [float(clock) for clock in range(-10, 4500, 45)])
    for bucket in (7, 360, 720):
        found = tracking.fleet_at_clocks(df, requests, ("datetime", "bucket"), bucket).collect()
        assert len(found) == len(expected) and {(r.vehicle_id, r.clock): r.bucket for r in found} == expected


MONTHS = [
    ("a", "2014-08-01 10:00:00", 1), ("a", "2014-08-01 20:00:00", 2), ("a", "2014-09-01 10:00:00", 3), ("a", "2014-09-01 12:00:00", 4),
    ("b", "2014-8-1 10:00:00", 5), ("b", "2014-09-01 09:00:00", 6),
]


def test_months_are_kept_apart(spark):
    df = spark.createDataFrame(MONTHS, SCHEMA)
    found = {(r.vehicle_id, r.month): r.row for r in tracking.fleet_at(df, 700).collect()}
    assert found == {("a", "2014-08"): 2, ("a", "2014-09"): 4, ("b", "2014-08"): 5, ("b", "2014-09"): 6}
    one = {(r.vehicle_id, r.month): r.row for r in tracking.fleet_at(df, 700, month="2014-08").collect()}
    assert one == {key: row for key, row in found.items() if key[1] == "2014-08"}
    shown = {(r.vehicle_id, r.month, r.tick): r.row for r in tracking.playback(df).collect()}
    assert shown["a", "2014-08", 1201] == shown["a", "2014-08", 1440] == shown["a", "2014-08", 2640] == 2
    assert shown["a", "2014-09", 1201] == 4
    with pytest.raises(ValueError):
        tracking.fleet_at(df, 700, month="2014-8")


def test_a_month_prunes_the_folders_by_day(spark, plan, tmp_path):
    df = spark.createDataFrame(MONTHS, SCHEMA)
    df.write.parquet(str(tmp_path / "moves"))
    text = plan(tracking.fleet_at(spark.read.parquet(str(tmp_path / "moves")), 700, month="2014-10"))
    assert "GreaterThanOrEqual(datetime,2014-10-)" in text


def test_chosen_vehicles_are_joined_after_the_first_aggregation(spark, moves, plan, tmp_path):
    spark.createDataFrame(moves, SCHEMA).write.parquet(str(tmp_path / "moves"))
    chosen = ids(spark, "early", "late")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        text = plan(tracking.playback(spark.read.parquet(str(tmp_path / "moves")), ids=chosen))
    finally:
        spark.conf.set(key, before)
    lines = text.split("\n")
    at = {name: next(n for n, line in enumerate(lines) if name in line) for name in ("Join", "partial_min")}
    exchanges = [n for n, line in enumerate(lines) if "Exchange" in line]
    assert at["Join"] < at["partial_min"] and any(at["Join"] < n < at["partial_min"] for n in exchanges)


def test_history_of_one_vehicle(spark, moves, plan, tmp_path):
    spark.createDataFrame(moves, SCHEMA).write.parquet(str(tmp_path / "moves"))
    stored = spark.read.parquet(str(tmp_path / "moves"))
    one = tracking.vehicle_history(stored, "early")
    assert [(r.datetime, r.minute) for r in one.collect()] == [("2014-08-01 03:00:00", 180), ("2014-08-01 04:00:00", 240)]
    assert "EqualTo(vehicle_id,early)" in plan(one)


def test_known_vehicles(spark, moves):
    found = tracking.known_vehicles(spark.createDataFrame(moves, SCHEMA)).collect()
    assert sorted(r.vehicle_id for r in found) == sorted({m[0] for m in moves})


def ids(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "vehicle_id string")


def test_resolve_ids(spark):
    known = ids(spark, *[f"k{i}" for i in range(40)])
    tracked = ids(spark, *[f"k{i}" for i in range(20)])
    asked = ["k1", "k30", "k30", *[f"u{i}" for i in range(500)]]
    found = tracking.resolve_ids(ids(spark, *asked), known, tracked).collect()
    assert Counter(r.vehicle_id for r in found) == Counter(asked)
    assert all(r.resolved_id == r.vehicle_id for r in found if r.vehicle_id.startswith("k"))
    drawn = Counter(r.resolved_id for r in found if r.vehicle_id.startswith("u"))
    assert set(drawn) == {f"k{i}" for i in range(20, 40)} and max(drawn.values()) < 60
    again = tracking.resolve_ids(ids(spark, *reversed(asked)), known.repartition(7), tracked).collect()
    assert Counter(found) == Counter(again)


def test_nothing_left_to_draw(spark):
    known = ids(spark, "a", "b")
    found = tracking.resolve_ids(ids(spark, "a", "x"), known, known).collect()
    assert {r.vehicle_id: r.resolved_id for r in found} == {"a": "a", "x": None}


@pytest.mark.parametrize("count", [0, 1, 5000])
def test_index_is_dense(spark, count):
    names = spark.range(count).selectExpr("concat('v', id) AS vehicle_id")
    places = sorted(r.place for r in hash_index(names, "vehicle_id").collect())
    assert places == list(range(count))


def test_tiles(spark):
    df = spark.createDataFrame([(-73.9876, 40.7512)], "longitude double, latitude double")
    tiles = {r.tile: r for r in tracking.viewport_tiles(df).collect()}
    assert sorted(tiles) == list(range(9))
    assert tiles[0].corner_lat == 40.75 and tiles[0].corner_lon == -73.99
    for tile, row in tiles.items():
        column, line = tile % 3, tile // 3
        assert row.north == pytest.approx(40.75 + line * 0.005) and row.south == pytest.approx(40.75 + (line - 1) * 0.005)
        assert row.east == pytest.approx(-73.99 + column * 0.005) and row.west == pytest.approx(-73.99 + (column - 1) * 0.005)


def test_frames(spark):
    rows = [("7", [-73.9876, 40.7512], [1.0], [2.0], "2014-08-01 10:00:00")]
    schema = "vehicle_id string, vehicle_pos array<double>, spot_lon array<double>, spot_lat array<double>, datetime string"
    suggestions = spark.createDataFrame(rows, schema)
    chosen = tracking_plan.track(suggestions, ids(spark, "7"), ids(spark))
    shown = tracking_plan.frames(suggestions, chosen, 599, 601)
    assert [(r.tick, r.label) for r in shown.orderBy("tick").collect()] == [
        (1198, "09:59 AM"), (1199, "09:59 AM"), (1200, "10:00 AM"), (1201, "10:00 AM"), (1202, "10:01 AM")
    ]
    assert tracking_plan.tiles(shown).count() == 5 * 9
