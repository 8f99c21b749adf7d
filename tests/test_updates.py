"""Tables that are kept up to date: hotspots by batches, live playback, stream batches in append-only tables, renewed history."""

import json
import re
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from kerbside.operators import ranking, tracking
from kerbside.operators.cleaning import clean_positions
from kerbside.operators.sampling import explode_picks, suggestions
from kerbside.plans.hotspot_update import GROUP, HotspotStore, fed_by, feeding
from kerbside.sources.messages import encode_positions, read_messages
from kerbside.sources.tables import ParquetTable
from kerbside.sources.versions import SlotStore, State
from kerbside.streaming import commits
from kerbside.streaming import suggestions as live
from kerbside.streaming import tracking as live_tracking


def rows(df):
    return Counter(json.dumps(row.asDict(recursive=True), sort_keys=True) for row in df.select(*sorted(df.columns)).collect())


# Slots that are renewed

SLOT_ROWS = "time_slot int, name string"


def slot_rows(spark, *pairs):
    return spark.createDataFrame(pairs, SLOT_ROWS)


def test_slots_are_replaced_one_by_one(spark, tmp_path):
    store = SlotStore(spark, str(tmp_path / "store"))
    first = store.replace(slot_rows(spark, (1, "a"), (1, "b"), (2, "c")), [1, 2])
    second = store.replace(slot_rows(spark, (2, "d"), (3, "e")), [2, 3])
    assert second.stamps[1] == first.stamps[1] and second.stamps[2] == second.stamps[3] != first.stamps[2]
    assert sorted(map(tuple, store.read().collect())) == [(1, "a"), (1, "b"), (2, "d"), (3, "e")]
    assert sorted(map(tuple, store.read([2, 9]).collect())) == [(2, "d")]
    store.replace(slot_rows(spark), [2, 3])  # emptied
    assert store.read([2]).count() == 0 and store.read().count() == 2
    assert store.read().schema == slot_rows(spark).schema


def test_a_reader_never_sees_half_of_a_change(spark, tmp_path, monkeypatch):
    store = SlotStore(spark, str(tmp_path / "store"))
    store.replace(slot_rows(spark, (1, "a"), (2, "b")), [1, 2])
    before = store.read()

    def crash(self, state):
        raise KeyboardInterrupt

    monkeypatch.setattr(SlotStore, "commit", crash)
    with pytest.raises(KeyboardInterrupt):
        store.replace(slot_rows(spark, (1, "x"), (2, "x")), [1, 2])
    assert rows(SlotStore(spark, store.path).read()) == rows(before)
    monkeypatch.undo()
    store.replace(slot_rows(spark, (1, "y")), [1])
    assert rows(before) == rows(slot_rows(spark, (1, "a"), (2, "b")))  # a reader that began earlier
    store.tidy()
    assert len(list(Path(store.path, "data").glob("stamp=*"))) == 2
    assert rows(store.read()) == rows(slot_rows(spark, (1, "y"), (2, "b")))


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    store = SlotStore(spark, str(tmp_path / "store"))
    store.replace(slot_rows(spark, (1, "a")), [1])
    with pytest.raises(RuntimeError):
        store.commit(State(1, None, {}, {}))
    assert store.read().count() == 1


# Hotspots by batches

def in_years(spark, sf, low, high):
    return fixtures.trips(spark, sf).filter(F.substring("datetime", 1, 4).between(f"{low:04d}", f"{high:04d}"))


@pytest.fixture(scope="module")
def store(spark, sf, tmp_path_factory):
    made = HotspotStore(spark, str(tmp_path_factory.mktemp("updated")))
    made.update("old", in_years(spark, sf, 0, 1995))
    made.update("new", in_years(spark, sf, 1996, 9999))
    return made


def test_batches_add_up(spark, sf, store):
    assert rows(store.hotspots.read()) == rows(ranking.hotspots(fixtures.trips(spark, sf)))


def test_a_batch_given_twice_changes_nothing(spark, sf, store):
    before = rows(store.hotspots.read())
    store.update("new", in_years(spark, sf, 1996, 9999))
    assert rows(store.hotspots.read()) == before and set(store.batches()) == {"old", "new"}


def test_only_touched_slots_are_written(spark, sf, store):
    """A few trips of one slot change that slot and the one before it."""
    few = in_years(spark, sf, 1996, 1996).withColumn("datetime", F.lit("2020-05-05 10:03:00")).limit(3).persist()
    before = store.hotspots.state().stamps
    written = store.update("few", few)
    after = store.hotspots.state().stamps
    assert written == [59, 60] == sorted(slot for slot in after if after[slot] != before.get(slot))
    everything = fixtures.trips(spark, sf).unionByName(few)
    assert rows(store.hotspots.read()) == rows(ranking.hotspots(everything))
    # Taken back: the groups of the version before are ranked anew, too.
    store.update("few", few.limit(0))
    assert rows(store.hotspots.read()) == rows(ranking.hotspots(fixtures.trips(spark, sf)))
    few.unpersist()


def test_an_update_reads_only_what_feeds_the_change(spark, store, plan):
    changed = fed_by(spark.createDataFrame([(10, 20, 5)], "cell_x bigint, cell_y bigint, time_slot int"))
    sources = feeding(changed)
    text = plan(store.ranked(list(store.batches().values()), changed, sources, [4, 5, 6]))
    assert "In(time_slot, [4,5,6])" in text and "Python" not in text


def test_who_feeds_whom(spark):
    """Straight from the ranking: a group's spots turn up in just the groups that it feeds."""
    spot = spark.createDataFrame([(5, 6, 0, 1, 2, 3)], "cell_x bigint, cell_y bigint, time_slot int, sub_x int, sub_y int, passengers int")
    offered = {tuple(r) for r in ranking.expand_neighbours(spot).select(*GROUP).collect()}
    assert {tuple(r) for r in fed_by(spot.select(*GROUP)).collect()} == offered
    targets = spark.createDataFrame(sorted(offered), "cell_x bigint, cell_y bigint, time_slot int")
    assert (5, 6, 0) in {tuple(r) for r in feeding(targets).collect()}
    for target in sorted(offered):
        back = feeding(spark.createDataFrame([target], "cell_x bigint, cell_y bigint, time_slot int"))
        assert (5, 6, 0) in {tuple(r) for r in back.collect()}


def test_compacted_sums_give_the_same(spark, sf, tmp_path):
    made = HotspotStore(spark, str(tmp_path))
    made.update("a", in_years(spark, sf, 0, 1996))
    made.update("b", in_years(spark, sf, 1997, 1997))
    made.compact()
    made.update("c", in_years(spark, sf, 1998, 9999))
    assert len(made.batches()) == 2
    assert rows(made.hotspots.read()) == rows(ranking.hotspots(fixtures.trips(spark, sf)))


def test_an_empty_first_batch(spark, sf, tmp_path):
    made = HotspotStore(spark, str(tmp_path))
    assert made.update("none", fixtures.trips(spark, sf).limit(0)) == []
    assert made.hotspots.read().count() == 0


# History renewed under a running stream

def test_only_changed_parts_are_read_again(spark, sf, store):
    history = live.load_hotspots(spark, store.hotspots)
    batch = clean_positions(fixtures.positions(spark, sf)).filter("time_slot in (3, 59, 100)").persist()
    live.answer_batch(batch, history).count()
    kept = dict(history.loaded)
    assert sorted(kept) == [(0, 7), (56, 63), (96, 103)]
    trips = in_years(spark, sf, 1997, 1997).withColumn("datetime", F.lit("2020-05-05 10:03:00"))
    store.update("renewed", trips)
    found = rows(live.answer_batch(batch, history))
    assert [edges for edges in kept if history.loaded[edges] is not kept[edges]] == [(56, 63)]
    assert found == rows(live.answer_batch(batch, store.hotspots.read()))
    assert history.renew() == []
    store.update("renewed", trips.limit(0))
    history.unpersist()
    batch.unpersist()


# Playback on a live table

@pytest.fixture
def moves(spark, tmp_path):
    start = datetime(2024, 1, 1, 9, 0, 0)
    given = [(f"v{n % 7}", str(start + timedelta(seconds=97 * n)), n) for n in range(900)] + [("bad", "no time", 9000), (None, str(start), 9001)]
    given += [("hot", str(start + timedelta(seconds=n // 3)), 10_000 + n) for n in range(500)]
    df = spark.createDataFrame(given, "vehicle_id string, datetime string, row int")
    df.repartition(3).write.parquet(str(tmp_path / "moves"))
    return spark.read.parquet(str(tmp_path / "moves"))


ORDER = ("datetime", "row")


def test_live_table_equals_playback(spark, moves, tmp_path):
    stream = spark.readStream.schema(moves.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "moves"))
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    live_tracking.run_tracking(stream, table, state, ORDER, available_now=True).awaitTermination()
    assert len(list(Path(table).glob("run=*/batch_id=*"))) == 3
    expected = rows(tracking.playback(moves.filter("vehicle_id is not null"), order=ORDER))
    assert rows(live_tracking.track_live(spark, table)) == expected
    # A batch that is sent again, under its own number or another one, changes nothing.
    for run, number in (("again", 0), ("again", 0), ("again", 1)):
        live_tracking.batch_writer(table, lambda run=run: run, ORDER)(moves.filter("vehicle_id is not null").limit(300), number)
    assert rows(live_tracking.track_live(spark, table)) == expected
    merged = str(tmp_path / "merged")
    live_tracking.compact_minutes(spark, merged, table)
    assert rows(live_tracking.track_live(spark, merged)) == rows(live_tracking.track_live(spark, table, merged)) == expected


def test_live_month_and_vehicles(spark, moves, tmp_path, plan):
    table, merged = str(tmp_path / "table"), str(tmp_path / "merged")
    live_tracking.batch_writer(table, lambda: "run", ORDER)(moves.filter("vehicle_id is not null"), 0)
    live_tracking.compact_minutes(spark, merged, table)
    ids = spark.createDataFrame([("v3",), ("nobody",)], "vehicle_id string")
    found = live_tracking.track_live(spark, merged, month="2024-01", ids=ids, start=590, end=640)
    assert rows(found) == rows(tracking.playback(moves, 590, 640, ids=ids, order=ORDER, month="2024-01"))
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ = 2024-01", plan(found))
    assert live_tracking.track_live(spark, merged, month="2024-02").count() == 0


# Exactly once into append-only tables

def test_batches_that_come_again_or_break_off(spark, sf, store, tmp_path):
    bodies = encode_positions(fixtures.positions(spark, sf)).select("value")
    bodies.repartition(3).write.text(str(tmp_path / "inbox"))
    hotspots = store.hotspots.read().persist()
    target, noted = ParquetTable(str(tmp_path / "picks"), ()), ParquetTable(str(tmp_path / "commits"), ())
    sink = commits.committed_sink(target, noted, explode_picks)
    failures = [0]

    def unsteady(answers, run, batch_id):
        if batch_id == 1 and not failures[0]:
            failures[0] = 1
            commits.stage(explode_picks(answers), target, run, batch_id)
            raise OSError("lost between rows and commit")
        sink(answers, run, batch_id)

    def start():
        incoming = read_messages(spark, "text", {"path": str(tmp_path / "inbox"), "maxFilesPerTrigger": "1"})
        query = live.run_suggestions(incoming, hotspots, unsteady, str(tmp_path / "state"), available_now=True)
        query.awaitTermination()

    with pytest.raises(Exception, match="lost between"):
        start()
    start()
    # As after a crash between the commit of a batch and its note in the checkpoint.
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
    last.unlink()
    Path(str(last.parent / f".{last.name}.crc")).unlink(missing_ok=True)
    start()
    answers = explode_picks(suggestions(clean_positions(fixtures.positions(spark, sf)), hotspots))
    assert rows(commits.read_committed(spark, target, noted)) == rows(answers)
    assert spark.read.parquet(target.path).count() > answers.count()  # the broken attempt is still there, unseen
    hotspots.unpersist()


def test_one_of_two_committed_attempts_counts(spark, tmp_path):
    target, noted = ParquetTable(str(tmp_path / "rows"), ()), ParquetTable(str(tmp_path / "commits"), ())
    two = spark.createDataFrame([(1,), (2,)], "n int")
    for _ in range(2):  # two drivers, neither of which saw the other's commit
        commits.commit(spark, noted, "run", 0, commits.stage(two, target, "run", 0))
    commits.committed_sink(target, noted)(two, "run", 0)
    commits.committed_sink(target, noted)(two, "run", 1)
    assert rows(commits.read_committed(spark, target, noted)) == rows(two.unionAll(two))


# One vehicle out of a large table

def read_rows(spark, path, vehicle):
    """Rows that the scan gives out: all of the row groups that it cannot rule out."""
    found = spark.read.parquet(path).filter(F.col("vehicle_id") == vehicle)
    found.collect()
    leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().get("numOutputRows").get().value()


def test_bloom_filters_rule_row_groups_out(spark, tmp_path):
    answers = spark.range(4000).selectExpr(
        "concat(if(id % 2 = 0, 'a', 'z'), id) as vehicle_id", "array(1D, 2D) as vehicle_pos", "array(1D) as spot_lon", "array(2D) as spot_lat",
        "'2024-01-01 10:00:00' as datetime",
    )
    answers.write.parquet(str(tmp_path / "answers" / "run=r" / "batch_id=0"))
    live.compact_suggestions(spark, str(tmp_path / "answers"), str(tmp_path / "table"))
    answers.sort("vehicle_id").write.parquet(str(tmp_path / "plain"))
    assert read_rows(spark, str(tmp_path / "table"), "m77") == 0 < read_rows(spark, str(tmp_path / "plain"), "m77")
    assert read_rows(spark, str(tmp_path / "table"), "a10") > 0
