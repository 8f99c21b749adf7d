"""Live suggestions: a stream of positions answered from stored hotspots.

An answer depends on one message and the hotspots only, so the stream keeps no state and late messages
need no rule. Each micro-batch is written to its own ``run=/batch_id=`` folder in overwrite mode: a batch
that is repeated after a failure replaces itself, and with the checkpoint every message is answered
exactly once. ``run`` is the query's id, which lives in its checkpoint: a restart goes on in the same
folder, and a new checkpoint adds to what is there. Errors are not swallowed; the query stops and is started again from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.functions.clock import part_ranges
from kerbside.operators.cleaning import clean_positions
from kerbside.operators.matching import HEAVY_ROWS, prune_slots, with_draws
from kerbside.operators.sampling import explode_picks, suggestions
from kerbside.params import GRID, PICKS, SLOTS, Grid, Slots
from kerbside.sources.messages import decode_positions
from kerbside.sources.tables import PARTS, Table, read_slots, write_table
from kerbside.sources.versions import SlotStore

INTERVAL = "1 second"
# A micro-batch up to this many rows (about 100 bytes each) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000


class SlotHistory:
    """The hotspots kept in memory in parts of neighbouring slots, each loaded when a batch first needs it, with the running
    totals that draws need.

    A batch touches only the parts that hold its slots. A lost block is read again from the table. The
    owner calls ``unpersist`` when the query has ended. A ``SlotStore`` may be renewed while the query runs: each batch looks for
    a newer list of it, and the parts one of whose slots has another stamp are dropped and read again; all others
    stay. Any other table is taken as it was when its parts were loaded.
    """

    def __init__(self, spark: SparkSession, table: Table | SlotStore, parts: int = PARTS, slots: Slots = SLOTS):
        self.spark, self.table, self.ranges = spark, table, part_ranges(parts, slots)
        self.loaded: dict[tuple[int, int], DataFrame] = {}
        self.stamps: dict[tuple[int, int], list[str | None]] = {}

    def renew(self) -> list[tuple[int, int]]:
        """Drops the loaded parts that have changed in the store, and names them."""
        if not isinstance(self.table, SlotStore):
            return []
        newest = self.table.state().stamps
        found = {edges: [newest.get(slot) for slot in range(edges[0], edges[1] + 1)] for edges in self.ranges}
        changed = [edges for edges in self.loaded if found[edges] != self.stamps[edges]]
        for edges in changed:
            self.loaded.pop(edges).unpersist()
        self.stamps = found
        return changed

    def part(self, low: int, high: int) -> DataFrame:
        if (low, high) not in self.loaded:
            if isinstance(self.table, SlotStore):
                rows = self.table.read(range(low, high + 1))
            else:
                rows = read_slots(self.spark, self.table, [(low, high)])
            self.loaded[low, high] = with_draws(rows).persist(StorageLevel.MEMORY_AND_DISK)
        return self.loaded[low, high]

    def of(self, slots: list[int]) -> DataFrame:
        self.renew()
        touched = [(low, high) for low, high in self.ranges if any(low <= slot <= high for slot in slots)]
        parts = [self.part(*edges) for edges in touched]
        return prune_slots(reduce(DataFrame.union, parts), slots)

    def unpersist(self) -> None:
        for rows in self.loaded.values():
            rows.unpersist()
        self.loaded.clear()


def load_hotspots(spark: SparkSession, table: Table | SlotStore, parts: int = PARTS) -> SlotHistory:
    """The hotspots kept in memory, for ``run_suggestions``."""
    return SlotHistory(spark, table, parts)


def answer_batch(
    batch: DataFrame, hotspots: DataFrame | SlotHistory, k: int = PICKS
) -> DataFrame | None:
    """Suggestions for one cleaned, persisted micro-batch; None if it is empty.

    Slots and size come from one count per slot. The slots prune the hotspot table; the size decides
    whether the batch may be broadcast.
    """
    per_slot = batch.groupBy("time_slot").count().collect()  # at most one row per slot of the day
    if not per_slot:
        return None
    slots = sorted(row["time_slot"] for row in per_slot)
    offers = hotspots.of(slots) if isinstance(hotspots, SlotHistory) else prune_slots(hotspots, slots)
    if sum(row["count"] for row in per_slot) <= BROADCAST_ROWS:
        return suggestions(batch, offers, k, broadcast="positions")
    return suggestions(batch, offers, k, heavy=HEAVY_ROWS)


Sink = Callable[[DataFrame, str, int], None]


def folder_sink(path: str) -> Sink:
    """Writes each batch of answers below ``run=<query id>/batch_id=<batch>``."""

    def write(answers: DataFrame, run: str, batch_id: int) -> None:
        answers.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")

    return write


def table_sink(target: Table) -> Sink:
    """Appends each batch to a stored table, one row per suggested spot. A batch that is repeated after a failure is
    appended again; ``run`` and ``batch_id`` tell such rows apart. ``streaming.commits.committed_sink`` adds each just once."""

    def write(answers: DataFrame, run: str, batch_id: int) -> None:
        rows = explode_picks(answers).withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
        write_table(rows, target, "append")

    return write


def batch_writer(
    hotspots: Callable[[], DataFrame | SlotHistory], sink: Sink, run: Callable[[], str], k: int
) -> Callable[[DataFrame, int], None]:
    def write(cleaned: DataFrame, batch_id: int) -> None:
        batch = cleaned.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            answers = answer_batch(batch, hotspots(), k)
            if answers is not None:
                sink(answers, run(), batch_id)
        finally:
            batch.unpersist()

    return write


def run_suggestions(
    messages: DataFrame,
    hotspots: DataFrame | SlotHistory | Callable[[], DataFrame],
    target: str | Sink,
    checkpoint: str,
    k: int = PICKS,
    available_now: bool = False,
    cells: Grid = GRID,
    slots: Slots = SLOTS,
) -> StreamingQuery:
    """Starts the query. ``messages`` has the JSON bodies in ``value`` (see ``sources.messages``).

    ``hotspots`` is the static side, usually from ``load_hotspots``. A function is called for every
    micro-batch instead; one that reads the table anew sees the newest hotspots, and reads only the
    slots it needs. ``available_now`` works through what is there and stops; otherwise a batch runs
    every second. ``target`` is a folder, or a function that gets each batch of answers with the query's id
    and the batch's number (see ``table_sink``).
    """
    current = hotspots if callable(hotspots) else lambda: hotspots
    sink = folder_sink(target) if isinstance(target, str) else target
    started: Future[str] = Future()  # the first batch may begin before the query's id is known here
    cleaned = clean_positions(decode_positions(messages), cells, slots)
    query = cleaned.writeStream.foreachBatch(batch_writer(current, sink, started.result, k))
    query = query.option("checkpointLocation", checkpoint)
    query = query.trigger(availableNow=True) if available_now else query.trigger(processingTime=INTERVAL)
    running = query.start()
    started.set_result(running.id)
    return running


def stream_join(messages: DataFrame, hotspots: DataFrame, k: int = PICKS, salt: int = 1) -> DataFrame:
    """The same answers as a plain stream-static join, for sinks that Spark writes to itself.

    Hotspots too large for the engine's own broadcast are shuffled; ``salt`` then spreads a busy cell.
    """
    return suggestions(clean_positions(decode_positions(messages)), hotspots, k, salt=salt)


def read_suggestions(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "vehicle_id string, vehicle_pos array<double>, spot_lon array<double>, spot_lat array<double>, "
        "datetime string, run string, batch_id bigint"
    )
    return spark.read.schema(schema).parquet(path).drop("run", "batch_id")


def compact_suggestions(spark: SparkSession, path: str, target: str) -> None:
    """Rewrites the many small batch folders as one table that is quick to search by vehicle: sorted by it inside the
    files, and with a Bloom filter of it for every row group, so that a vehicle's rows are read and few others."""
    rows = read_suggestions(spark, path).withColumn("day", F.substring("datetime", 1, 10))
    by_vehicle = rows.hint("rebalance", "day").sortWithinPartitions("day", "vehicle_id", "datetime")
    by_vehicle.write.mode("overwrite").partitionBy("day").option("parquet.bloom.filter.enabled#vehicle_id", "true").parquet(target)
