"""Replays stored positions as an endless stream of messages at a bounded rate.

The positions are numbered once, in time order, and stored sorted by that number. A source then counts upwards by
the same number of rows every second, and each micro-batch reads just the rows whose numbers have come up; after the last row
it starts again at the first. The count is kept in the query's checkpoint and does not follow the clock on the wall: after
a pause, or behind a slow batch, it goes on where it was, at the same rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.session import remove, scratch_dir
from kerbside.sources.messages import MESSAGE_FIELDS, encode_positions

ROWS_PER_SECOND = 1000
CHUNK_ROWS = 1_000_000  # consecutive numbers in one folder


def prepare_replay(positions: DataFrame, path: str, chunk_rows: int = CHUNK_ROWS) -> None:
    """Stores positions with ``seq`` 0, 1, 2, ... in time order.

    One range shuffle, as wide as ``spark.sql.shuffle.partitions``, and no global sort in one task.
    Sorted files are written first; a row's number is then the number of rows in the files before plus
    its place in its own file. The input partition is the last sort key, so that even exact copies can
    be split over tasks.
    """
    spark = positions.sparkSession
    staged = scratch_dir(spark, "replay")
    keys = ["datetime", "vehicle_id", "longitude", "latitude", "origin"]
    ordered = positions.select(*MESSAGE_FIELDS, F.spark_partition_id().alias("origin"))
    spread = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("origin")
    # One file a task, whatever the session's settings: the part number orders the files.
    spread.write.option("maxRecordsPerFile", 0).parquet(staged)

    stored = spark.read.parquet(staged).select(
        *MESSAGE_FIELDS,
        F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("file")
        .agg(F.count("*").alias("members"))
        .select("file", F.coalesce(F.sum("members").over(before), F.lit(0)).alias("start"))
    )
    # One row per range partition at most: the setting above bounds what is broadcast.
    numbered = stored.join(F.broadcast(starts), "file").select(
        *MESSAGE_FIELDS, (F.col("start") + F.col("at")).alias("seq")
    )
    # Whole chunks of numbers in a folder each: a batch opens the folders that are due, no others.
    chunks = numbered.withColumn("chunk", F.expr(f"seq div {chunk_rows}"))
    laid_out = chunks.sortWithinPartitions("chunk", "seq").write.mode("overwrite").partitionBy("chunk")
    laid_out.option("maxRecordsPerFile", 0).parquet(path)
    remove(spark, staged)


def replay_rows(ticks: DataFrame, table: DataFrame, total: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The stored rows for a batch of ticks (column ``value``), wrapping round after ``total`` rows."""
    low, high = ticks.agg(F.min("value"), F.max("value")).first()
    if low is None or total == 0:
        return table.limit(0)
    first, last, seq, chunk = low % total, high % total, F.col("seq"), F.col("chunk")
    if high - low + 1 >= total:
        wanted = table
    elif first <= last:
        wanted = table.filter(chunk.between(first // chunk_rows, last // chunk_rows) & seq.between(first, last))
    else:
        folders = (chunk >= first // chunk_rows) | (chunk <= last // chunk_rows)
        wanted = table.filter(folders & ((seq >= first) | (seq <= last)))
    return ticks.select("value", (F.col("value") % total).alias("seq")).join(wanted.drop("chunk"), "seq")


def replay(
    spark: SparkSession,
    path: str,
    sink,
    checkpoint: str,
    rate: int = ROWS_PER_SECOND,
    chunk_rows: int = CHUNK_ROWS,
) -> StreamingQuery:
    """Starts an endless replay. ``sink(messages, batch_id)`` gets each micro-batch of keyed messages,
    for example to hand them to ``sources.messages.write_messages``. No batch holds more than ``rate`` rows, and none begins
    less than a second after the one before."""
    table = spark.read.parquet(path)
    total = table.count()  # answered from the file footers

    def send(ticks: DataFrame, batch_id: int) -> None:
        sink(encode_positions(replay_rows(ticks, table, total, chunk_rows)), batch_id)

    counter = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rate).option("numPartitions", 1)
    ticks = counter.option("advanceMillisPerBatch", 1000).load()
    return ticks.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start()
