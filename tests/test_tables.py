"""Stored tables and their layout."""

import argparse
import re
from pathlib import Path

import pytest

from kerbside.operators import ranking
from kerbside.sources import tables
from kerbside.sources.tables import JdbcTable, ParquetTable, cluster_by, read_slots, read_table, slot_predicates, write_table


def slots(spark, count=144):
    return spark.range(count * 5).selectExpr("CAST(id % 144 AS INT) AS time_slot", "id AS value")


def test_round_trip_and_modes(spark, tmp_path):
    table = ParquetTable(str(tmp_path / "t"))
    write_table(slots(spark), table, "overwrite")
    write_table(slots(spark), table, "append")
    assert read_table(spark, table).count() == 2 * 144 * 5
    write_table(slots(spark), table, "overwrite")
    assert sorted(read_table(spark, table).select("value").collect()) == sorted(slots(spark).select("value").collect())
    assert len(list(Path(table.path).glob("time_slot=*"))) == 144


def test_slot_ranges_prune_folders(spark, tmp_path, plan):
    table = ParquetTable(str(tmp_path / "t"))
    write_table(slots(spark), table, "overwrite")
    some = read_slots(spark, table, [(0, 3), (140, 143)])
    assert {r.time_slot for r in some.collect()} == {0, 1, 2, 3, 140, 141, 142, 143}
    text = plan(some)
    assert re.search(r"PartitionFilters: \[[^\]]*time_slot#\d+ <= 3", text) and "Filter (" not in text
    assert read_slots(spark, table, []).count() == 0


def test_jdbc_predicates():
    assert slot_predicates([(0, 7), (8, 15)]) == ['"time_slot" BETWEEN 0 AND 7', '"time_slot" BETWEEN 8 AND 15']
    assert JdbcTable("jdbc:x", "t").properties == {}


def test_clustering_brings_keys_together(spark, plan):
    df = slots(spark).withColumnRenamed("value", "vehicle_id")
    text = plan(cluster_by(df, ["time_slot"], ["vehicle_id"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    assert "Sort [time_slot#" in text
    assert "Exchange" not in plan(cluster_by(df, sort_by=["vehicle_id"]))


def test_slot_counts(spark):
    found = {r.time_slot: r.row_count for r in ranking.slot_counts(slots(spark)).collect()}
    assert found == {slot: 5 for slot in range(144)}


def test_command_lines_name_folders_and_databases(tmp_path):
    """Only the options are tested; there is no database here."""
    parser = argparse.ArgumentParser()
    tables.add_table_options(parser)
    assert tables.named_table("/shared/hotspots", parser.parse_args([])) == tables.ParquetTable("/shared/hotspots")
    file = tmp_path / "connection.properties"
    file.write_text("# fleet\nuser = me\npassword=a=b\n\nfetchsize=1000\n")
    given = parser.parse_args(["--table", "hotspots", "--properties", str(file)])
    found = tables.named_table("jdbc:postgresql://host/fleet", given)
    assert found == tables.JdbcTable("jdbc:postgresql://host/fleet", "hotspots", {"user": "me", "password": "a=b", "fetchsize": "1000"})
    assert tables.named_table("jdbc:x", parser.parse_args(["--table", "t"])).properties == {}
    with pytest.raises(SystemExit):
        tables.named_table("jdbc:x", parser.parse_args([]))
