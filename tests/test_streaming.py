"""The live side: same answers as the batch side, once each."""

import json
import re
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from kerbside.operators import ranking
from kerbside.operators.cleaning import clean_positions
from kerbside.operators.sampling import explode_picks, suggestions
from kerbside.plans import replay_job
from kerbside.session import scratch_dir
from kerbside.sources.messages import decode_positions, encode_positions, kafka_options, read_messages, write_messages
from kerbside.sources.tables import ParquetTable, read_table, write_table
from kerbside.streaming import replay, suggestions as live


@pytest.fixture(scope="module")
def table(spark, sf, tmp_path_factory):
    stored = ParquetTable(str(tmp_path_factory.mktemp("live") / "hotspots"), partition_by=())
    write_table(ranking.hotspots(fixtures.trips(spark, sf)), stored, "overwrite")
    return stored


@pytest.fixture
def inbox(spark, sf, tmp_path):
    bodies = encode_positions(fixtures.positions(spark, sf)).select("value")
    bodies.repartition(3).write.text(str(tmp_path / "inbox"))
    return tmp_path / "inbox"


def start(spark, inbox, table, tmp_path, hotspots=None):
    incoming = read_messages(spark, "text", {"path": str(inbox), "maxFilesPerTrigger": "1"})
    static = read_table(spark, table) if hotspots is None else hotspots
    query = live.run_suggestions(incoming, static, str(tmp_path / "answers"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination()
    return query


def rows(df):
    return Counter(json.dumps(row.asDict(), sort_keys=True) for row in df.collect())


def expected(spark, sf, table):
    return rows(suggestions(clean_positions(fixtures.positions(spark, sf)), read_table(spark, table)))


def test_stream_equals_batch(spark, sf, inbox, table, tmp_path):
    kept = live.load_hotspots(spark, table)
    start(spark, inbox, table, tmp_path, kept)
    kept.unpersist()
    assert rows(live.read_suggestions(spark, str(tmp_path / "answers"))) == expected(spark, sf, table)
    assert len(list((tmp_path / "answers").glob("run=*/batch_id=*"))) == 3


def test_a_second_checkpoint_loses_nothing(spark, sf, inbox, table, tmp_path):
    bodies = sorted(inbox.glob("part-*"))
    halves = []
    for nth, some in enumerate((bodies[:1], bodies[1:])):
        box = tmp_path / f"half{nth}"
        box.mkdir()
        for body in some:
            (box / body.name).write_bytes(body.read_bytes())
        (tmp_path / f"run{nth}").mkdir()
        incoming = read_messages(spark, "text", {"path": str(box), "maxFilesPerTrigger": "1"})
        state = str(tmp_path / f"run{nth}" / "state")
        query = live.run_suggestions(incoming, read_table(spark, table), str(tmp_path / "answers"), state, available_now=True)
        query.awaitTermination()
        halves.append(query.id)
    assert len(set(halves)) == 2
    assert rows(live.read_suggestions(spark, str(tmp_path / "answers"))) == expected(spark, sf, table)


def test_answers_go_to_any_target(spark, sf, inbox, table, tmp_path):
    target = ParquetTable(str(tmp_path / "picks"), partition_by=("run",))
    incoming = read_messages(spark, "text", {"path": str(inbox), "maxFilesPerTrigger": "1"})
    query = live.run_suggestions(
        incoming, read_table(spark, table), live.table_sink(target), str(tmp_path / "state"), available_now=True
    )
    query.awaitTermination()
    answers = suggestions(clean_positions(fixtures.positions(spark, sf)), read_table(spark, table))
    stored = spark.read.parquet(target.path).drop("run", "batch_id")
    assert rows(stored.select(*sorted(stored.columns))) == rows(explode_picks(answers).select(*sorted(stored.columns)))


def test_a_batch_touches_only_its_slots(spark, sf, tmp_path):
    table = ParquetTable(str(tmp_path / "hotspots"))
    write_table(ranking.hotspots(fixtures.trips(spark, sf)), table, "overwrite")
    kept = live.load_hotspots(spark, table)
    batch = clean_positions(fixtures.positions(spark, sf)).filter("time_slot in (3, 4, 50)").persist()
    found = rows(live.answer_batch(batch, kept))
    assert sorted(kept.loaded) == [(0, 7), (48, 55)]
    assert found == rows(live.answer_batch(batch, read_table(spark, table)))
    kept.unpersist()
    batch.unpersist()


def test_hotspots_are_read_anew_for_every_batch(spark, sf, inbox, table, tmp_path):
    reads = []
    start(spark, inbox, table, tmp_path, lambda: reads.append(1) or read_table(spark, table))
    assert len(reads) == 3
    assert rows(live.read_suggestions(spark, str(tmp_path / "answers"))) == expected(spark, sf, table)


def test_large_batches_split_their_hot_cell(spark, sf, inbox, table, tmp_path, monkeypatch, plan):
    monkeypatch.setattr(live, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(live, "HEAVY_ROWS", 5)
    cleaned = clean_positions(fixtures.positions(spark, sf))
    assert "share" in plan(live.answer_batch(cleaned, read_table(spark, table)))
    start(spark, inbox, table, tmp_path)
    assert rows(live.read_suggestions(spark, str(tmp_path / "answers"))) == expected(spark, sf, table)


def test_restart_adds_no_rows(spark, inbox, table, tmp_path):
    start(spark, inbox, table, tmp_path)
    before = rows(live.read_suggestions(spark, str(tmp_path / "answers")))
    start(spark, inbox, table, tmp_path)
    assert rows(live.read_suggestions(spark, str(tmp_path / "answers"))) == before


def test_a_repeated_batch_replaces_itself(spark, sf, inbox, table, tmp_path):
    start(spark, inbox, table, tmp_path)
    # As after a crash between writing the answers and noting the batch as done.
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
    last.unlink()
    Path(str(last.parent / f".{last.name}.crc")).unlink(missing_ok=True)
    start(spark, inbox, table, tmp_path)
    assert rows(live.read_suggestions(spark, str(tmp_path / "answers"))) == expected(spark, sf, table)


@pytest.mark.parametrize("salt", [1, 4])
def test_plain_stream_join(spark, sf, inbox, table, tmp_path, salt):
    incoming = read_messages(spark, "text", {"path": str(inbox)})
    answers = live.stream_join(incoming, read_table(spark, table), salt=salt)
    query = (
        answers.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "answers"))
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "answers"))) == expected(spark, sf, table)


def test_answer_batch_plan(spark, sf, tmp_path, plan):
    table = ParquetTable(str(tmp_path / "hotspots"))
    write_table(ranking.hotspots(fixtures.trips(spark, sf)), table, "overwrite")
    batch = clean_positions(fixtures.positions(spark, sf)).filter("time_slot < 3").persist()
    text = plan(live.answer_batch(batch, read_table(spark, table)))
    assert "BroadcastHashJoin" in text and re.search(r"PartitionFilters: \[[^\]]*time_slot#\d+ IN \(0,1,2\)", text)
    assert "Python" not in text
    assert live.answer_batch(batch.limit(0), read_table(spark, table)) is None
    batch.unpersist()


def test_compacted_answers_are_the_same(spark, inbox, table, tmp_path):
    start(spark, inbox, table, tmp_path)
    live.compact_suggestions(spark, str(tmp_path / "answers"), str(tmp_path / "table"))
    compacted = spark.read.parquet(str(tmp_path / "table"))
    assert rows(compacted.drop("day")) == rows(live.read_suggestions(spark, str(tmp_path / "answers")))


def test_errors_stop_the_query(spark, inbox, table, tmp_path, monkeypatch):
    def fail(*_):
        raise ValueError("broken")

    monkeypatch.setattr(live, "answer_batch", fail)
    with pytest.raises(Exception, match="broken"):
        start(spark, inbox, table, tmp_path)


def bodies(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_decode(spark):
    good = '{"latitude": 40.7, "longitude": -74, "datetime": "2014-08-01 10:00:00", "vehicle_id": "7"}'
    found = decode_positions(bodies(spark, good, "garbage", '{"latitude": 40.7}', good[:30], "", "[]", good.replace("40.7", '"x"')))
    assert [tuple(row) for row in found.collect()] == [(40.7, -74.0, "2014-08-01 10:00:00", "7")]


def test_encode(spark):
    rows = [(40.7, -74.0, "2014-08-01 10:00:00", "7", 1), (float("nan"), -74.0, "t", "8", 2)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, datetime string, vehicle_id string, other int")
    first, second = encode_positions(df).collect()
    assert json.loads(first.value) == {"latitude": 40.7, "longitude": -74.0, "datetime": "2014-08-01 10:00:00", "vehicle_id": "7"}
    assert first.key is not None and second.key is None and second.value is not None


def test_messages_to_files(spark, sf, tmp_path):
    sent = encode_positions(fixtures.positions(spark, sf))
    write_messages(sent, "json", {}, str(tmp_path / "sent"))
    assert rows(spark.read.schema("key string, value string").json(str(tmp_path / "sent"))) == rows(sent)


def test_kafka_options():
    options = kafka_options("a:1,b:2", "topic", 3, 5)
    assert json.loads(options["startingOffsets"]) == {"topic": {"0": 5, "1": 5, "2": 5}}
    assert "startingOffsets" not in kafka_options("a:1", "topic", 3, None)
    assert int(options["maxOffsetsPerTrigger"]) > 0


def test_replay_numbers_rows_in_time_order(spark, sf, tmp_path):
    positions = fixtures.positions(spark, sf)
    # Copies of one row, more than a third of everything.
    copies = positions.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(700)))).drop("n")
    everything = positions.unionByName(copies).repartition(6)
    replay.prepare_replay(everything, str(tmp_path / "replay"))
    stored = spark.read.parquet(str(tmp_path / "replay")).orderBy("seq").collect()
    assert [row.seq for row in stored] == list(range(positions.count() + 700))
    assert [row.datetime for row in stored] == sorted(row.datetime for row in everything.collect())


@pytest.mark.parametrize(("first", "last"), [(0, 2), (8, 12), (19, 20), (5, 40), (7, 7)])
def test_replay_wraps_round(spark, first, last):
    stored = spark.range(10).selectExpr("id AS seq", "concat('row', id) AS name", "id div 3 AS chunk")
    ticks = spark.range(first, last + 1).withColumnRenamed("id", "value")
    found = replay.replay_rows(ticks, stored, 10, 3)
    assert sorted((row.value, row.name) for row in found.collect()) == [(n, f"row{n % 10}") for n in range(first, last + 1)]


def test_replay_reads_only_what_is_due(spark, sf, tmp_path, plan):
    replay.prepare_replay(fixtures.positions(spark, sf), str(tmp_path / "replay"), 100)
    table = spark.read.parquet(str(tmp_path / "replay"))
    assert len(list((tmp_path / "replay").glob("chunk=*"))) == -(-table.count() // 100)
    ticks = spark.range(205, 209).withColumnRenamed("id", "value")
    text = plan(replay.replay_rows(ticks, table, table.count(), 100))
    assert "GreaterThanOrEqual(seq,205), LessThanOrEqual(seq,208)" in text
    assert re.search(r"PartitionFilters: \[[^\]]*chunk#\d+ >= 2[^\]]*chunk#\d+ <= 2", text)


def test_replay_numbers_do_not_depend_on_the_session(spark, sf, tmp_path):
    key = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(key)
    spark.conf.set(key, "100")
    try:
        replay.prepare_replay(fixtures.positions(spark, sf), str(tmp_path / "replay"))
    finally:
        spark.conf.set(key, before)
    stored = spark.read.parquet(str(tmp_path / "replay"))
    assert sorted(row.seq for row in stored.collect()) == list(range(stored.count()))
    # The copy that was staged on the way is gone.
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("replay-*"))


def test_replay_from_text(spark, sf, tmp_path):
    fixtures.position_lines(spark, sf).write.text(str(tmp_path / "lines"))
    replay_job.prepare(spark, str(tmp_path / "lines"), str(tmp_path / "replay"))
    stored = spark.read.parquet(str(tmp_path / "replay"))
    assert 0 < stored.count() < fixtures.positions(spark, sf).count()
    sent = replay.replay_rows(spark.range(3).withColumnRenamed("id", "value"), stored, stored.count())
    assert encode_positions(sent).count() == 3


def test_replay_runs_at_its_rate(spark, sf, tmp_path):
    replay.prepare_replay(fixtures.positions(spark, sf), str(tmp_path / "replay"))
    sent = []
    query = replay.replay(spark, str(tmp_path / "replay"), lambda df, _: sent.append(df.count()), str(tmp_path / "state"), rate=50)
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if sum(sent) >= 100:
                break
    finally:
        query.stop()
    assert sum(sent) >= 100 and all(count % 50 == 0 for count in sent)


def test_replay_keeps_its_rate_over_a_pause(spark, sf, tmp_path):
    """Stopped for some seconds and started again: numbers without a gap or a repeat, and no burst."""
    replay.prepare_replay(fixtures.positions(spark, sf), str(tmp_path / "replay"))
    batches = []

    def sink(df, batch_id):
        batches.append((batch_id, [row.value for row in df.collect()]))

    for wanted in (3, 6):
        query = replay.replay(spark, str(tmp_path / "replay"), sink, str(tmp_path / "state"), rate=20)
        for _ in range(120):
            query.awaitTermination(0.5)
            if len(dict(batches)) >= wanted:
                break
        query.stop()
        time.sleep(4)
    once = dict(batches)  # a batch that was cut off is sent again, the same
    assert len(once) >= 6 and sorted(once) == list(range(len(once)))
    assert all(len(sent) == 20 for sent in once.values())
    stored = spark.read.parquet(str(tmp_path / "replay"))
    total = stored.count()
    numbers = [n % total for n in range(20 * len(once))]
    expected = encode_positions(stored.filter(F.col("seq").isin(numbers))).select("value")
    assert Counter(row.value for row in expected.collect()) == Counter(v for sent in once.values() for v in sent)


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
