"""Playback on a live table: the positions a stream brings, reduced to what playback needs, and always ready to be shown.

Of every vehicle, month and minute only the earliest and the latest row are kept. Both are a least and a greatest value, so
parts can be merged in any order and any number of times: a micro-batch that is repeated writes its folder again, one
that arrives twice under different numbers adds rows that change nothing, and compacting may leave both the old
folders and the new one behind without harm. The table grows with vehicles and minutes, not with positions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators import tracking
from kerbside.operators.cleaning import drop_invalid
from kerbside.sources.tables import cluster_by

INTERVAL = "1 second"


def batch_writer(path: str, run: Callable[[], str], order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Writes the minutes of each batch to its own folder, which a repetition writes over."""

    def write(batch: DataFrame, batch_id: int) -> None:
        minutes = tracking.minutes(batch, order)
        minutes.write.mode("overwrite").parquet(f"{path}/run={run()}/batch_id={batch_id}")

    return write


def run_tracking(
    positions: DataFrame, path: str, checkpoint: str, order: Sequence[str] = ("datetime",), available_now: bool = False
) -> StreamingQuery:
    """Starts the query on a stream of positions (``vehicle_id``, ``datetime`` and any others, see
    ``sources.messages.decode_positions``)."""
    started: Future[str] = Future()  # the first batch may begin before the query's id is known here
    named = drop_invalid(positions, "vehicle_id")
    query = named.writeStream.foreachBatch(batch_writer(path, started.result, order)).option("checkpointLocation", checkpoint)
    query = query.trigger(availableNow=True) if available_now else query.trigger(processingTime=INTERVAL)
    running = query.start()
    started.set_result(running.id)
    return running


def read_minutes(spark: SparkSession, *paths: str, month: str | None = None, ids: DataFrame | None = None) -> DataFrame:
    """The merged minutes of live folders and compacted tables. Month and vehicles are picked before the merge, as both are
    keys of it; in a compacted table the month prunes folders."""
    kept = ["vehicle_id", "month", "minute", "early", "late"]
    parts = []
    for path in paths:
        part = spark.read.parquet(path).select(*kept)
        parts.append(part if month is None else part.filter(F.col("month") == month))
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    if ids is not None:
        everything = tracking.keep_vehicles(everything, ids)
    return tracking.merge_minutes(everything)


def track_live(
    spark: SparkSession, *paths: str, month: str | None = None, ids: DataFrame | None = None, **clock: int
) -> DataFrame:
    """``operators.tracking.playback`` of all positions that have come in so far."""
    return tracking.playback_of_minutes(read_minutes(spark, *paths, month=month, ids=ids), **clock)


def compact_minutes(spark: SparkSession, target: str, *paths: str) -> None:
    """Merges live folders and tables into one table by month, quick to search by vehicle. The sources may be removed
    once the table is complete, or stay: reading both gives the same."""
    laid_out = cluster_by(read_minutes(spark, *paths), ("month",), ("vehicle_id", "minute"))
    laid_out.write.partitionBy("month").option("parquet.bloom.filter.enabled#vehicle_id", "true").parquet(target)
