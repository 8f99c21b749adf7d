"""Suggestion jobs: a stored position history in one go, or the live stream.

    spark-submit kerbside/plans/suggestion_job.py --hotspots hotspots --output answers --positions 'positions/*.txt'
    spark-submit kerbside/plans/suggestion_job.py --hotspots hotspots --output answers \\
        --checkpoint state --brokers host:9092 --topic positions --partitions 3

The hotspots may lie in a database, too: ``--hotspots jdbc:... --table hotspots --properties connection.properties``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.cleaning import clean_positions
from kerbside.operators.matching import HEAVY_ROWS
from kerbside.operators.sampling import suggestions
from kerbside.params import PICKS
from kerbside.session import build_session
from kerbside.sources.messages import MAX_OFFSETS_PER_TRIGGER, kafka_options, read_messages
from kerbside.sources.tables import Table, add_table_options, named_table, read_table
from kerbside.sources.text import positions_from_lines, read_lines
from kerbside.streaming.suggestions import load_hotspots, run_suggestions

# Size of the broadcast hotspots that a driver and executor with default memory can hold. A row takes 173
# bytes and a spot 24.6 in it, as measured. The positions, by far the larger side, are then not shuffled.
BROADCAST_BYTES = 256 << 20
ROW_BYTES, SPOT_BYTES = 173, 24.6


def suggest_history(spark: SparkSession, positions: DataFrame, table: Table, k: int = PICKS, keep: tuple[str, ...] = (), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Suggestions for stored positions. Rows and spots of the hotspot table are counted, which reads one of its
    columns, to choose between broadcasting it and a shuffle join in which heavy keys are split."""
    hotspots = read_table(spark, table)
    cleaned = clean_positions(positions)
    rows, spots = hotspots.agg(F.count("*"), F.coalesce(F.sum(F.size("passengers")), F.lit(0))).first()
    if rows * ROW_BYTES + spots * SPOT_BYTES <= broadcast_bytes:
        return suggestions(cleaned, hotspots, k, keep, broadcast="hotspots")
    return suggestions(cleaned, hotspots, k, keep, heavy=HEAVY_ROWS)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--hotspots", required=True, help="a folder or a jdbc: address")
    add_table_options(args)
    args.add_argument("--output", required=True)
    args.add_argument("--positions", help="stored position text; without it the stream is answered")
    for name in ("checkpoint", "brokers", "topic"):
        args.add_argument(f"--{name}")
    args.add_argument("--partitions", type=int)
    args.add_argument("--start-offset", type=int, default=0)
    args.add_argument("--picks", type=int, default=PICKS)
    args.add_argument("--max-offsets", type=int, default=MAX_OFFSETS_PER_TRIGGER, help="messages of one micro-batch")
    given = args.parse_args()
    table = named_table(given.hotspots, given)
    spark = build_session("suggestions")
    if given.positions:
        positions = positions_from_lines(read_lines(spark, given.positions))
        answers = suggest_history(spark, positions, table, given.picks)
        answers.write.mode("overwrite").parquet(given.output)
        return
    missing = [name for name in ("checkpoint", "brokers", "topic", "partitions") if getattr(given, name) is None]
    if missing:
        args.error(f"the stream also needs {', '.join(missing)}")
    options = kafka_options(given.brokers, given.topic, given.partitions, given.start_offset, given.max_offsets)
    messages = read_messages(spark, "kafka", options)
    hotspots = load_hotspots(spark, table)
    run_suggestions(messages, hotspots, given.output, given.checkpoint, given.picks).awaitTermination()


if __name__ == "__main__":
    main()
