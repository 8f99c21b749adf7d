"""Stored tables: Parquet folders by default, or a relational database over JDBC."""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.clock import part_ranges

SLOT = "time_slot"
PARTS = 18  # connections that read a whole table from a database


@dataclass(frozen=True)
class ParquetTable:
    path: str
    partition_by: tuple[str, ...] = (SLOT,)


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)


Table = ParquetTable | JdbcTable


def add_table_options(args: ArgumentParser) -> None:
    """Options that name a table of a database, for an argument that is a path or a ``jdbc:`` address."""
    args.add_argument("--table", help="with a jdbc: address, the table of hotspots there")
    args.add_argument("--properties", help="file of key=value lines for the connection: user, password, driver, fetchsize")


def named_table(place: str, given: Namespace) -> Table:
    """The table that a command line names by a path or a ``jdbc:`` address. Passwords come from a file only."""
    if not place.startswith("jdbc:"):
        return ParquetTable(place)
    if not given.table:
        raise SystemExit("a jdbc: address also needs --table")
    lines = Path(given.properties).read_text().splitlines() if given.properties else []
    pairs = (line.split("=", 1) for line in lines if "=" in line and not line.lstrip().startswith("#"))
    return JdbcTable(place, given.table, {key.strip(): value.strip() for key, value in pairs})


def cluster_by(df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Lays rows out so that later look-ups read little, ready for a ``partitionBy`` write.

    Rows of one folder come together, so tasks do not write one small file per folder each. The
    rebalance hint lets adaptive execution split a huge folder over several tasks and put small ones
    together. Inside the files rows are sorted, so row groups can be skipped by their value ranges.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df


def write_table(df: DataFrame, target: Table, mode: str, sort_by: Sequence[str] = ()) -> None:
    """``mode`` is ``overwrite`` or ``append``."""
    if isinstance(target, ParquetTable):
        laid_out = cluster_by(df, target.partition_by, sort_by)
        laid_out.write.mode(mode).partitionBy(*target.partition_by).parquet(target.path)
    else:
        df.write.jdbc(target.url, target.table, mode=mode, properties=dict(target.properties))


def read_table(spark: SparkSession, target: Table, parts: int = PARTS) -> DataFrame:
    """The whole table. From a database one task reads each of ``parts`` ranges of slots."""
    if isinstance(target, ParquetTable):
        return spark.read.parquet(target.path)
    return read_slots(spark, target, part_ranges(parts))


def slot_predicates(ranges: Sequence[tuple[int, int]]) -> list[str]:
    """One condition per slot range, each read by one task of a JDBC scan."""
    return [f'"{SLOT}" BETWEEN {int(low)} AND {int(high)}' for low, high in ranges]


def read_slots(spark: SparkSession, target: Table, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """The rows in the given slot ranges, ends included; the source skips the rest."""
    if isinstance(target, JdbcTable):
        return spark.read.jdbc(
            target.url, target.table, predicates=slot_predicates(ranges), properties=dict(target.properties)
        )
    wanted = F.lit(False)
    for low, high in ranges:
        wanted = wanted | F.col(SLOT).between(low, high)
    return read_table(spark, target).filter(wanted)


def read_all(spark: SparkSession, target: Table) -> DataFrame:
    """A whole table of any layout, slots or none. A database is asked in one query unless its properties say how to split."""
    if isinstance(target, ParquetTable):
        return spark.read.parquet(target.path)
    return spark.read.jdbc(target.url, target.table, properties=dict(target.properties))
