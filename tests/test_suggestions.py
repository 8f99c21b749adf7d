"""Matching and sampling."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbside.operators import cleaning, layout, matching, ranking, sampling
from kerbside.plans import suggestion_job
from kerbside.sources.tables import ParquetTable, write_table

MATCHED = "vehicle_id string, vehicle_pos array<double>, offer_lon array<double>, offer_lat array<double>, weights array<bigint>, datetime string"


def matched(spark, ids, weights):
    lon, lat = [-74.0 + place for place in range(len(weights))], [40.0 + place for place in range(len(weights))]
    return spark.createDataFrame([(i, [0.0, 0.0], lon, lat, weights, "2014-08-01 10:00:00") for i in ids], MATCHED)


def picks(df, k=3):
    return {row.vehicle_id: [round(lon + 74) for lon in row.spot_lon] for row in sampling.suggest(df, k).collect()}


def test_at_most_k_different_spots(spark):
    for chosen in picks(matched(spark, [str(i) for i in range(200)], list(range(10, 0, -1)))).values():
        assert len(chosen) == len(set(chosen)) == 3


def test_fewer_spots_than_asked_for(spark):
    assert picks(matched(spark, ["5"], [4])) == {"5": [0]}
    assert sorted(picks(matched(spark, ["5"], [4, 1]))["5"]) == [0, 1]


def test_the_same_vehicle_gets_the_same_spots(spark):
    ids = [str(i) for i in range(50)]
    weights = [9, 7, 5, 3, 1]
    assert picks(matched(spark, ids, weights)) == picks(matched(spark, ids[::-1], weights).repartition(7))


@pytest.mark.parametrize(
    ("vehicle", "possible"),
    [("7", True), (" 7 ", True), ("-4040", True), ("4294963255", True), ("-4041", False), ("4294963256", False), ("abc", False), ("7.0", False), ("", False)],
)
def test_ids_without_a_seed_get_nothing_but_stay(spark, vehicle, possible):
    assert len(picks(matched(spark, [vehicle], [3, 2, 1]))[vehicle]) == (3 if possible else 0)


def test_weights_that_allow_no_draw(spark):
    assert picks(matched(spark, ["1"], [5, 0, 0])) == {"1": []}
    assert picks(matched(spark, ["1"], [5, 4, 3, -1])) == {"1": []}
    assert picks(matched(spark, ["1"], [])) == {"1": []}
    assert 1 not in picks(matched(spark, ["1"], [5, 0, 4, 3]))["1"]


def test_draws_follow_the_weights(spark):
    """Chances of being drawn first and at all, against the exact ones for two draws out of four."""
    weights = [1, 2, 3, 4]
    total, size = sum(weights), 4000
    chosen = picks(matched(spark, [str(i) for i in range(size)], weights), 2)
    first = Counter(spots[0] for spots in chosen.values())
    drawn = Counter(spot for spots in chosen.values() for spot in spots)
    for place, weight in enumerate(weights):
        chance = weight / total
        anywhere = chance + sum(w / total * weight / (total - w) for at, w in enumerate(weights) if at != place)
        for share, expected in ((first[place] / size, chance), (drawn[place] / size, anywhere)):
            assert abs(share - expected) < 4 * math.sqrt(expected * (1 - expected) / size)


def slow_draws(seed, weights, k):
    """One spot after the other; the spot drawn is taken out, and the totals of the rest are made anew."""
    words = "".join(hashlib.md5(f"{seed}:{block}".encode()).hexdigest() for block in range(-(-k // 4)))
    left, chosen = [(place, min(weight, 2**40)) for place, weight in enumerate(weights)], []
    for nth in range(min(k, len(weights))):
        at, total = (int(words[8 * nth : 8 * nth + 8], 16) + 0.5) / 2**32 * float(sum(w for _, w in left)), 0
        for place, weight in left:
            total += weight
            if total >= at:
                break
        chosen.append(place)
        left = [(p, w) for p, w in left if p != place]
    return chosen


@pytest.mark.parametrize("k", [1, 3, 7])
def test_draws_equal_slow_ones(spark, k):
    """Zero weights, equal ones, and weights that only a damaged line can cause."""
    draw = random.Random(k)
    lists = [[1], [3, 1], [5, 5, 5, 5], [0, 2, 0, 0, 9, 1, 0], [2**63 - 1] * 9, [1, 2**62, 7, 3, 2**63 - 1, 4, 5, 6]]
    lists += [[draw.choice([0, 1, 1, 2, 50, 1000]) for _ in range(draw.randint(1, 12))] for _ in range(12)]
    for weights in lists:
        found = picks(matched(spark, [str(i) for i in range(20)], weights), k)
        enough = sum(weight > 0 for weight in weights) >= min(k, len(weights))
        assert found == {str(i): slow_draws(4040 + i, weights, k) if enough else [] for i in range(20)}


def test_totals_come_with_the_hotspots(spark, sides, plan):
    """Computed below the join, once a row of hotspots; and not at all where nothing is drawn."""
    positions, hotspots = sides
    text = plan(sampling.suggestions(positions, hotspots, broadcast="positions"))
    assert text.count("aggregate(") == 1 and text.index("Join") < text.index("aggregate(")
    assert "aggregate(" not in plan(matching.match_spots(positions, hotspots, broadcast="positions").select("vehicle_id", "weights"))


@pytest.fixture(scope="module")
def sides(spark, sf):
    from checks import fixtures

    hotspots = ranking.hotspots(fixtures.trips(spark, sf)).persist()
    positions = cleaning.clean_positions(fixtures.positions(spark, sf)).persist()
    # A third of all rows are copies of one position in one cell.
    hot = positions.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(positions.count() // 2)))).drop("n")
    return positions.unionByName(hot), hotspots


def as_rows(df):
    return Counter(str(sorted(row.asDict(recursive=True).items())) for row in df.collect())


def test_every_way_to_join_gives_the_same_rows(spark, sides):
    positions, hotspots = sides
    plain = as_rows(matching.match_spots(positions, hotspots))
    assert sum(plain.values()) > 0
    assert as_rows(matching.match_spots(positions, hotspots, salt=8)) == plain
    assert as_rows(matching.match_spots(positions, hotspots, heavy=10)) == plain
    assert as_rows(matching.match_spots(positions, hotspots, broadcast="positions")) == plain
    assert as_rows(matching.match_spots(positions, hotspots, broadcast="hotspots")) == plain
    with pytest.raises(ValueError):
        matching.match_spots(positions, hotspots, broadcast="both")


def test_stored_tables_join_without_an_exchange(spark, sides, plan):
    positions, hotspots = sides
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layout.store_positions(positions, "laid_positions", 4, 10)
        layout.store_offers(spark, hotspots, "laid_offers", "laid_positions", 4)
        found = layout.match_stored(spark, "laid_positions", "laid_offers")
        text = plan(found)
        assert "Exchange" not in text and "SortMergeJoin" in text and "Broadcast" not in text
        assert as_rows(found) == as_rows(matching.match_spots(positions, hotspots))
        assert spark.read.table("laid_positions_shares").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("laid_positions", "laid_offers", "laid_positions_shares"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_positions_are_parsed_once(spark, sides, plan):
    """Heavy keys are found while the positions are staged; the join reads the staged ones."""
    positions, hotspots = sides
    text = plan(matching.match_spots(positions, hotspots, heavy=10))
    assert text.count("positions-") >= 1 and "split(" not in text


def test_only_heavy_keys_are_split(spark, sides):
    positions, hotspots = sides
    offers = hotspots.select(*cleaning.SPOT_KEYS)
    dealt, repeated = matching.split_heavy(positions, offers, 50)
    counts = {tuple(r)[:3]: r["count"] for r in positions.groupBy(*cleaning.SPOT_KEYS).count().collect()}
    shares = Counter(tuple(r)[:3] for r in repeated.collect())
    assert all(shares[key] == (-(-count // 50) if count > 50 else 1) for key, count in counts.items() if key in shares)
    assert max(shares.values()) > 1 and dealt.count() == positions.count()


def test_limit_for_broadcast_counts_rows_and_spots(spark, sides, plan, tmp_path, sf):
    """A table of one-spot rows is mostly rows: the estimate must say so."""
    _, hotspots = sides
    single = hotspots.withColumns({c: F.slice(c, 1, 1) for c in ("longitude", "latitude", "passengers")})
    table = ParquetTable(str(tmp_path / "single"))
    write_table(single, table, "overwrite")
    rows = single.count()
    from checks import fixtures

    positions = fixtures.positions(spark, sf)
    limit = int(rows * (suggestion_job.ROW_BYTES + suggestion_job.SPOT_BYTES))
    assert "share" in plan(suggestion_job.suggest_history(spark, positions, table, broadcast_bytes=limit - 1))
    assert "share" not in plan(suggestion_job.suggest_history(spark, positions, table, broadcast_bytes=limit + 1))


def test_salt_spreads_copies_of_one_position(spark):
    row = ("7", "2013-01-01 00:05:00", -73.9, 40.7)
    copies = spark.createDataFrame([row] * 64, "vehicle_id string, datetime string, longitude double, latitude double").repartition(8)
    spread = F.pmod(F.xxhash64("vehicle_id", "datetime") + F.spark_partition_id(), F.lit(4))
    assert copies.select(spread.alias("salt")).distinct().count() == 4


def test_suggested_spots_belong_to_the_cell(spark, sides):
    positions, hotspots = sides
    offered = matching.match_spots(positions, hotspots).select(
        "event_id", F.col("offer_lon").alias("offered"), "weights"
    )
    answers = sampling.suggestions(positions, hotspots, keep=("event_id",))
    joined = answers.join(offered, "event_id")
    wrong = (F.size(F.array_except("spot_lon", "offered")) > 0) | (F.size("spot_lon") != F.least(F.lit(3), F.size("weights")))
    assert joined.count() > 0
    assert joined.filter(wrong).count() == 0


def test_history_join_is_chosen_by_size(spark, plan, sides, tmp_path, sf):
    from checks import fixtures

    _, hotspots = sides
    table = ParquetTable(str(tmp_path / "hotspots"))
    write_table(hotspots, table, "overwrite")
    positions = fixtures.positions(spark, sf)
    small = suggestion_job.suggest_history(spark, positions, table)
    large = suggestion_job.suggest_history(spark, positions, table, broadcast_bytes=1000)
    assert "BroadcastHashJoin" in plan(small) and "Exchange hashpartitioning" not in plan(small)
    assert "share" in plan(large)
    assert as_rows(small) == as_rows(large)


def test_arrivals_equal_a_plain_rank(spark, sides):
    from pyspark.sql import Window

    positions, _ = sides
    expected = positions.withColumn(
        "arrival_no", F.rank().over(Window.partitionBy(*cleaning.SPOT_KEYS).orderBy("datetime")).cast("bigint")
    )
    found = matching.arrivals(positions)
    assert as_rows(found.select(*expected.columns)) == as_rows(expected)


def test_no_slots_no_rows(spark, sides):
    _, hotspots = sides
    assert matching.prune_slots(hotspots, []).count() == 0
    assert matching.slots_present(matching.prune_slots(hotspots, [3, 5])) == [3, 5]
