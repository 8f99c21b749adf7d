"""Replay job: position text in, an endless stream of keyed messages out.

    spark-submit kerbside/plans/replay_job.py --input 'positions/*.txt' --prepared replay --checkpoint state \\
        --brokers host:9092 --topic positions
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from kerbside.session import build_session
from kerbside.sources.messages import write_messages
from kerbside.sources.text import positions_from_lines, read_lines
from kerbside.streaming.replay import ROWS_PER_SECOND, prepare_replay, replay


def prepare(spark: SparkSession, paths: str | list[str], prepared: str) -> None:
    """Position text to the numbered table that ``replay`` reads."""
    prepare_replay(positions_from_lines(read_lines(spark, paths)), prepared)


def topic_sink(brokers: str, topic: str):
    options = {"kafka.bootstrap.servers": brokers, "topic": topic}

    def send(messages: DataFrame, batch_id: int) -> None:
        write_messages(messages, "kafka", options)

    return send


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    for name in ("input", "prepared", "checkpoint", "brokers", "topic"):
        args.add_argument(f"--{name}", required=True)
    args.add_argument("--rate", type=int, default=ROWS_PER_SECOND)
    given = args.parse_args()
    spark = build_session("replay")
    prepare(spark, given.input, given.prepared)
    replay(spark, given.prepared, topic_sink(given.brokers, given.topic), given.checkpoint, given.rate).awaitTermination()


if __name__ == "__main__":
    main()
