"""Keyed JSON messages, from and to a broker or files."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.grid import message_key
from kerbside.operators.cleaning import add_cells, drop_invalid
from kerbside.operators.staging import compute_once
from kerbside.params import GRID, Grid

MESSAGE_SCHEMA = "latitude double, longitude double, datetime string, vehicle_id string"
MESSAGE_FIELDS = ("latitude", "longitude", "datetime", "vehicle_id")
# A micro-batch never holds more than this, whatever has piled up in the topic.
MAX_OFFSETS_PER_TRIGGER = 1_000_000


def kafka_options(
    brokers: str,
    topic: str,
    partitions: int,
    start_offset: int | None = 0,
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
) -> dict[str, str]:
    """Source options to read all partitions from one offset; without an offset, from new messages on.

    The offset only counts for the first start: after that the checkpoint of the query decides.
    """
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "maxOffsetsPerTrigger": str(max_offsets)}
    try:
        offset = int(start_offset)
    except (TypeError, ValueError):
        return options
    offsets = {topic: {str(partition): offset for partition in range(partitions)}}
    return {**options, "startingOffsets": json.dumps(offsets)}


def read_messages(spark: SparkSession, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """A stream of messages with the text body in ``value``. ``fmt`` is ``kafka`` or ``text``."""
    stream = spark.readStream.format(fmt).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def decode_positions(messages: DataFrame) -> DataFrame:
    """JSON bodies to typed positions. A body that is malformed or lacks a field gives no row."""
    body = compute_once(messages.select("value"), {"body": F.from_json("value", MESSAGE_SCHEMA)}).select("body.*")
    return drop_invalid(body, *MESSAGE_FIELDS)


def encode_positions(positions: DataFrame, cells: Grid = GRID) -> DataFrame:
    """Positions to ``key`` and ``value``. The body has just the four fields; a position off the grid
    is sent without a key."""
    placed = add_cells(positions, cells)
    return placed.select(
        message_key(F.col("cell_x"), F.col("cell_y")).alias("key"),
        F.to_json(F.struct(*MESSAGE_FIELDS)).alias("value"),
    )


def write_messages(messages: DataFrame, fmt: str, options: Mapping[str, str], path: str | None = None) -> None:
    """Writes a batch of messages to a broker (``kafka``) or, in any file format, to a folder."""
    writer = messages.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("overwrite").save(path)
