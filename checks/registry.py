"""The checked queries: every operator over the whole derived tables.

Names and columns match ``checks.oracles``. Arrays are spread into rows so both engines compare alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from kerbside.functions import clock, grid
from kerbside.operators import amplification, cleaning, layout, matching, ranking, sampling, tracking
from kerbside.plans import hotspot_job, replay_job, suggestion_job, tracking_plan
from kerbside.plans.hotspot_update import HotspotStore
from kerbside.session import scratch_dir
from kerbside.sources import messages, periods, tables, text
from kerbside.streaming import commits, replay
from kerbside.streaming import suggestions as live
from kerbside.streaming import tracking as live_tracking

Query = Callable[[SparkSession, str], DataFrame]

SLOT_PARTS = 18
VEHICLE = "7"
HEAVY = 20  # low, so that keys are split
BUCKETS = 16
CLOCK = 42000  # a minute late in the month: some vehicles still move, others have stopped


# Building blocks

def cleaned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_trips(fixtures.trips(spark, sf_dir))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.count_pickups(cleaned_trips(spark, sf_dir))


def own_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_spots(counts(spark, sf_dir))


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.hotspots(fixtures.trips(spark, sf_dir))


def cleaned_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_positions(fixtures.positions(spark, sf_dir))


def stored_hotspots(spark: SparkSession, sf_dir: str) -> tables.ParquetTable:
    table = tables.ParquetTable(scratch_dir(spark, "hotspots"))
    tables.write_table(folded(spark, sf_dir), table, "overwrite", sort_by=cleaning.CELL_KEYS)
    return table


# Sources and sinks

def parse_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    fixtures.trip_lines(spark, sf_dir).write.text(path)
    parsed = text.trips_from_lines(text.read_lines(spark, f"{path}/*.txt"))
    placed = cleaning.drop_invalid(cleaning.add_cells(parsed), "sub_x", "sub_y")
    return placed.select("datetime", "passengers", "longitude", "latitude", "sub_x", "sub_y")


def hotspots_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    fixtures.trip_lines(spark, sf_dir).write.text(path)
    return ranking.explode_spots(hotspot_job.hotspots_from_text(spark, path))


def read_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third part of the day, so ranges with gaps between them."""
    stored = stored_hotspots(spark, sf_dir)
    return ranking.explode_spots(tables.read_slots(spark, stored, clock.part_ranges(SLOT_PARTS)[::3]))


def parse_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "position-lines")
    fixtures.position_lines(spark, sf_dir).write.text(path)
    return text.positions_from_lines(text.read_lines(spark, path))


def message_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.encode_positions(fixtures.positions(spark, sf_dir))


def decode_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode_positions(fixtures.position_messages(spark, sf_dir))


def replay_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "replayed")
    replay.prepare_replay(fixtures.positions(spark, sf_dir), path)
    return spark.read.parquet(path).drop("chunk")


def replay_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, path = scratch_dir(spark, "position-lines"), scratch_dir(spark, "replayed")
    fixtures.position_lines(spark, sf_dir).write.text(lines)
    replay_job.prepare(spark, lines, path)
    return spark.read.parquet(path).drop("chunk")


def csv_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "periods")
    periods.write_csv_period(amplification.amplify_lines(fixtures.trip_lines(spark, sf_dir)), path)
    schema = "value string, period_year int, period_month int"
    return spark.read.schema(schema).text(path)


# Scalar functions

def time_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.trips(spark, sf_dir).select("trip_key", clock.time_slot(F.col("datetime")).alias("time_slot"))


def cell_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = cleaning.add_cells(fixtures.trips(spark, sf_dir))
    return placed.select("trip_key", "sub_x", "sub_y", "cell_x", "cell_y")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cleaning.add_cells(fixtures.trips(spark, sf_dir)).select("cell_x", "cell_y").distinct()
    around = grid.neighbours(F.col("cell_x"), F.col("cell_y"))
    return cells.withColumn("to", F.explode(around)).select(
        "cell_x", "cell_y", F.col("to.x").alias("to_x"), F.col("to.y").alias("to_y")
    )


def sub_cell_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = cleaning.add_cells(fixtures.trips(spark, sf_dir)).select("sub_x", "sub_y").distinct()
    lon, lat = grid.sub_cell_centre(F.col("sub_x"), F.col("sub_y"))
    return placed.select("sub_x", "sub_y", lon.alias("longitude"), lat.alias("latitude"))


def viewport_corner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.positions(spark, sf_dir).select(
        "event_id",
        grid.viewport_corner(F.col("longitude")).alias("corner_lon"),
        grid.viewport_corner(F.col("latitude")).alias("corner_lat"),
    )


def viewport_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = tracking.viewport_tiles(fixtures.positions(spark, sf_dir))
    return tiles.select("event_id", "tile", "north", "south", "east", "west")


def clock_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = clock.minute_of_day(clock.parse_datetime(F.col("datetime")))
    timed = fixtures.positions(spark, sf_dir).select("event_id", minutes.alias("minutes"))
    return timed.withColumn("label", clock.clock_label(F.col("minutes")))


def minute_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = clock.minute_of_month(F.col("datetime"))
    return fixtures.positions(spark, sf_dir).select("event_id", minute.alias("minute"))


def slot_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = cleaned_positions(spark, sf_dir).select("event_id", "time_slot")
    parts = slots.withColumn("part", clock.slot_part(F.col("time_slot"), SLOT_PARTS))
    low, high = clock.part_range(F.col("part"), SLOT_PARTS)
    return parts.withColumns({"first_slot": low, "last_slot": high})


def amplify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amplification.amplify(fixtures.trips(spark, sf_dir), key=["trip_key"])


def amplify_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amplification.amplify_lines(fixtures.trip_lines(spark, sf_dir))


# Filters and joins

def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_trips(spark, sf_dir).select("trip_key", "passengers", "sub_x", "sub_y", "time_slot")


def clean_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_positions(spark, sf_dir)


def clean_odd_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a cell or a time go."""
    cleaned = cleaning.clean_positions(fixtures.odd_positions(spark, sf_dir))
    return cleaned.select("event_id", "vehicle_id", "time_slot", "block_latid", "block_lonid")


def suggest_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions without hotspots give no row, vehicles without a seed a row without spots."""
    cleaned = cleaning.clean_positions(fixtures.odd_positions(spark, sf_dir))
    matched = matching.match_spots(cleaned, folded(spark, sf_dir), heavy=HEAVY)
    picks = sampling.explode_picks(sampling.suggest(matched)).fillna(0, ["pick_no"])
    return picks.select("event_id", "vehicle_id", "pick_no", "spot_lon", "spot_lat")


def match_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_spots(matching.match_spots(cleaned_positions(spark, sf_dir), folded(spark, sf_dir)))


def match_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same match from two tables laid out alike, with keys so busy that they are split."""
    names = [f"{name}_{uuid.uuid4().hex}" for name in ("positions", "offers")]
    layout.store_positions(cleaned_positions(spark, sf_dir), names[0], BUCKETS, HEAVY)
    layout.store_offers(spark, folded(spark, sf_dir), names[1], names[0], BUCKETS)
    return spread_spots(layout.match_stored(spark, *names))


def spread_spots(matched: DataFrame) -> DataFrame:
    spots = F.arrays_zip(matching.to_spots(F.col("offer_lon"), F.col("offer_lat")).alias("spots"), "weights")
    return matched.select("event_id", "vehicle_id", "datetime", F.posexplode(spots).alias("at", "spot")).select(
        "event_id",
        "vehicle_id",
        "datetime",
        (F.col("at") + 1).alias("rn"),
        F.col("spot.spots.longitude").alias("longitude"),
        F.col("spot.spots.latitude").alias("latitude"),
        F.col("spot.weights").alias("passengers"),
    )


def expand_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.expand_neighbours(own_spots(spark, sf_dir))


def prune_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For a batch of the morning hours."""
    morning = cleaned_positions(spark, sf_dir).filter(F.substring("datetime", 12, 2).between("06", "08"))
    slots = matching.slots_present(morning)
    hotspots = tables.read_table(spark, stored_hotspots(spark, sf_dir))
    return ranking.explode_spots(matching.prune_slots(hotspots, slots))


def resolve_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = fixtures.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("vehicle_id"))
    tracked = fixtures.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("vehicle_id"))
    return tracking.resolve_ids(requested, fixtures.positions(spark, sf_dir), tracked)


def fleet_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = tracking.fleet_at(fixtures.two_months(spark, sf_dir), CLOCK, order=("datetime", "event_id"), month="2024-01")
    return shown.drop("month")


def fleet_at_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.fleet_at(fixtures.two_months(spark, sf_dir), CLOCK, order=("datetime", "event_id"))


def fleet_at_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order asks where its customer's vehicle was, at a clock and in a month of its own."""
    requests = fixtures.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").cast("string").alias("vehicle_id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("2024-02")).otherwise(F.lit("2024-01")).alias("month"),
        ((F.col("o_orderkey") * 7919 % 89280) / F.lit(2.0)).alias("clock"),
    )
    return tracking.fleet_at_clocks(fixtures.two_months(spark, sf_dir), requests, order=("datetime", "event_id"))


def playback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.playback(fixtures.positions(spark, sf_dir), order=("datetime", "event_id")).drop("month")


def playback_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both months, for the vehicles that bear a supplier's number."""
    ids = fixtures.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("vehicle_id"))
    positions = fixtures.two_months(spark, sf_dir)
    return tracking.playback(positions, ids=ids, order=("datetime", "event_id"))


def track_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions of both months as a stream of several batches, one of them written twice, half of it compacted."""
    inbox, table, merged = (scratch_dir(spark, name) for name in ("moves", "minutes", "merged-minutes"))
    fixtures.two_months(spark, sf_dir).repartition(4, "event_id").write.parquet(inbox)
    stored = spark.read.parquet(inbox)
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    order = ("datetime", "event_id")
    live_tracking.run_tracking(stream, table, scratch_dir(spark, "state"), order, available_now=True).awaitTermination()
    again = stored.filter("event_id % 5 = 0")
    live_tracking.batch_writer(table, lambda: "again", order)(again, 0)
    live_tracking.compact_minutes(spark, merged, table)
    return live_tracking.track_live(spark, table, merged)


def vehicle_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.vehicle_history(fixtures.positions(spark, sf_dir), VEHICLE, order=("datetime", "event_id"))


def vehicle_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.vehicle_history(fixtures.positions(spark, sf_dir), order=("datetime", "event_id"))


# Aggregations

def count_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir)


def top_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return own_spots(spark, sf_dir)


def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.explode_spots(folded(spark, sf_dir))


def hotspots_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of trips one after the other, the second of them first without some of its rows."""
    trips = fixtures.trips(spark, sf_dir)
    year = F.substring("datetime", 1, 4).cast("int")
    store = HotspotStore(spark, scratch_dir(spark, "store"))
    store.update("early", trips.filter(year < 1995))
    store.update("middle", trips.filter((year == 1995) & (F.col("passengers") < 5)))
    store.update("late", trips.filter(year > 1995))
    store.update("middle", trips.filter(year == 1995))
    return ranking.explode_spots(store.hotspots.read())


def known_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.known_vehicles(fixtures.positions(spark, sf_dir))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.arrivals(cleaned_positions(spark, sf_dir))


def slot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.slot_counts(folded(spark, sf_dir))


# Suggestions

def suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = matching.match_spots(cleaned_positions(spark, sf_dir), folded(spark, sf_dir))
    picks = sampling.explode_picks(sampling.suggest(matched))
    return picks.select("event_id", "vehicle_id", "pick_no", "spot_lon", "spot_lat")


def suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stored_hotspots(spark, sf_dir)
    positions = fixtures.positions(spark, sf_dir)
    return sampling.explode_picks(suggestion_job.suggest_history(spark, positions, table, keep=("event_id",)))


def stream_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox, answers = scratch_dir(spark, "messages"), scratch_dir(spark, "answers")
    fixtures.position_messages(spark, sf_dir).select("value").repartition(4, "value").write.text(inbox)
    incoming = messages.read_messages(spark, "text", {"path": inbox, "maxFilesPerTrigger": "2"})
    table = stored_hotspots(spark, sf_dir)
    query = live.run_suggestions(
        incoming, lambda: tables.read_table(spark, table), answers, scratch_dir(spark, "state"), available_now=True
    )
    query.awaitTermination()
    return sampling.explode_picks(live.read_suggestions(spark, answers))


def stream_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers in append-only tables, though every batch comes three times and once breaks off before its end."""
    inbox = scratch_dir(spark, "messages")
    fixtures.position_messages(spark, sf_dir).select("value").repartition(4, "value").write.text(inbox)
    incoming = messages.read_messages(spark, "text", {"path": inbox, "maxFilesPerTrigger": "2"})
    target, noted = (tables.ParquetTable(scratch_dir(spark, name), ()) for name in ("picks", "commits"))
    sink = commits.committed_sink(target, noted, sampling.explode_picks)

    def write(answers: DataFrame, run: str, batch_id: int) -> None:
        commits.stage(sampling.explode_picks(answers), target, run, batch_id)
        sink(answers, run, batch_id)
        sink(answers, run, batch_id)

    hotspots = folded(spark, sf_dir).persist()
    live.run_suggestions(incoming, hotspots, write, scratch_dir(spark, "state"), available_now=True).awaitTermination()
    hotspots.unpersist()
    return commits.read_committed(spark, target, noted)


def track_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested customers are resolved to vehicles, played back and labelled."""
    positions = fixtures.positions(spark, sf_dir).withColumn("vehicle_pos", F.array("longitude", "latitude"))
    requested = fixtures.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("vehicle_id"))
    tracked = fixtures.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("vehicle_id"))
    ids = tracking_plan.track(positions, requested, tracked)
    shown = tracking_plan.frames(positions.drop("longitude", "latitude"), ids, order=("datetime", "event_id"))
    return shown.select("vehicle_id", "tick", "label", "event_id", "longitude", "latitude")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        parse_trips,
        hotspots_from_text,
        read_slots,
        message_key_value,
        decode_positions,
        replay_sequence,
        csv_periods,
        parse_positions,
        replay_from_text,
        time_slot,
        cell_ids,
        neighbours,
        sub_cell_centre,
        viewport_corner,
        viewport_tiles,
        clock_label,
        minute_of_month,
        slot_part,
        amplify,
        amplify_lines,
        valid_trips,
        clean_positions,
        clean_odd_positions,
        suggest_odd,
        match_spots,
        match_stored,
        expand_neighbours,
        prune_slots,
        resolve_ids,
        fleet_at,
        fleet_at_months,
        fleet_at_clocks,
        playback,
        playback_ids,
        track_live,
        vehicle_history,
        vehicle_histories,
        count_pickups,
        top_spots,
        hotspots,
        hotspots_updated,
        known_vehicles,
        arrivals,
        slot_counts,
        suggest,
        suggestions,
        stream_suggestions,
        stream_committed,
        track_frames,
    )
}
