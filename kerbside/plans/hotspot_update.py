"""Hotspots kept up to date: each batch of trips changes only the cells and slots that it touches.

    spark-submit kerbside/plans/hotspot_update.py --input 'trips/2016-01.csv' --name 2016-01 --store /shared/hotspots

Stored are, for every batch by its name, the passengers of each sub-cell and slot. Such sums can be added up in any order, so
a batch of a month is some thousand times smaller than its trips, and trips are never read again. A batch touches the
groups (cell and slot) its sums lie in; those groups and the ones they are offered to change, and each of these is ranked anew
from the sums of the groups that feed it, of all batches. Slots without such a group are neither read nor
written. A name that was given before replaces that batch: the groups of both versions are ranked anew.

Sums, slots and the names of the batches change together, by one list (see ``sources.versions``): an update that dies on the way has
not happened, and repeating one changes nothing.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import clock, grid
from kerbside.operators import ranking
from kerbside.operators.cleaning import CELL_KEYS, clean_trips
from kerbside.params import GRID, SLOTS, TOP_N, Grid, Slots
from kerbside.session import build_session, remove, scratch_dir
from kerbside.sources.tables import SLOT
from kerbside.sources.text import read_lines, trips_from_lines
from kerbside.sources.versions import SlotStore, State

GROUP = list(ranking.GROUP)
SUMS = "cell_x bigint, cell_y bigint, time_slot int, sub_x bigint, sub_y bigint, passengers bigint"


def around(groups: DataFrame, slot: F.Column) -> DataFrame:
    """Each group's own place, and the cells around it in the given slot."""
    targets = F.array(
        *[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(bool(dx or dy)).alias("moved")) for dx, dy in grid.surroundings(own=True)]
    )
    return (
        groups.withColumn("to", F.explode(targets))
        .select(
            (F.col("cell_x") + F.col("to.dx")).alias("cell_x"),
            (F.col("cell_y") + F.col("to.dy")).alias("cell_y"),
            F.when(F.col("to.moved"), slot).otherwise(F.col("time_slot")).alias("time_slot"),
        )
        .distinct()
    )


def fed_by(groups: DataFrame, slots: Slots = SLOTS) -> DataFrame:
    """The groups that spots of the given ones are offered to: their own, and the neighbours in the slot before."""
    return around(groups, clock.previous_slot(F.col("time_slot"), slots))


def feeding(groups: DataFrame, slots: Slots = SLOTS) -> DataFrame:
    """The groups whose spots are offered to the given ones: their own, and the neighbours in the slot after."""
    return around(groups, F.pmod(F.col("time_slot") + 1, F.lit(slots.count)).cast("int"))


class HotspotStore:
    """Sums of batches and the hotspots of them all, below one folder."""

    def __init__(self, spark: SparkSession, path: str, n: int = TOP_N, cells: Grid = GRID, slots: Slots = SLOTS):
        self.spark, self.path = spark, path.rstrip("/")
        self.n, self.cells, self.slots = n, cells, slots
        self.hotspots = SlotStore(spark, f"{self.path}/hotspots")

    def batches(self) -> dict[str, str]:
        """The folder of sums of every batch by its name."""
        return self.hotspots.state().notes

    def write_sums(self, counted: DataFrame) -> str:
        """In files of neighbouring slots and cells, so that the rest is ruled out by the value ranges of row groups."""
        part, order = uuid.uuid4().hex, (SLOT, "cell_x", "cell_y")
        spread = counted.repartitionByRange(*order).sortWithinPartitions(*order)
        spread.write.parquet(f"{self.path}/sums/part={part}")
        return part

    def sums(self, parts: list[str], slots: list[int] | None = None) -> DataFrame:
        """Stored sums of the named folders, in some slots or in all. The slots reach the scan."""
        if not parts:
            return self.spark.createDataFrame([], SUMS)
        stored = self.spark.read.schema(SUMS).parquet(*[f"{self.path}/sums/part={part}" for part in parts])
        return stored if slots is None else stored.filter(F.col(SLOT).isin(slots))

    def ranked(self, parts: list[str], changed: DataFrame, sources: DataFrame, slots: list[int]) -> DataFrame:
        """The stored form of the changed groups, from the sums of the groups that feed them."""
        wanted = self.sums(parts, slots).join(sources, GROUP, "left_semi")
        total = F.coalesce(F.try_sum("passengers"), F.lit(ranking.LARGEST))
        counts = wanted.groupBy(*GROUP, "sub_x", "sub_y").agg(total.alias("passengers"))
        own = ranking.top_spots(counts, self.n).drop("rn")
        offers = ranking.expand_neighbours(own, self.slots).join(changed, GROUP, "left_semi")
        return ranking.fold_spots(ranking.top_spots(offers, self.n), self.cells)

    def update(self, name: str, trips: DataFrame) -> list[int]:
        """Adds a batch of typed trips, or replaces the one of this name. Returns the slots that were written."""
        before = self.batches()
        part = self.write_sums(ranking.count_pickups(clean_trips(trips, self.cells, self.slots), self.cells))
        batches = {**before, name: part}
        touched = self.sums([part, *([before[name]] if name in before else [])]).select(*GROUP).distinct()
        scratch = scratch_dir(self.spark, "changed")
        # Small tables, each used several times.
        fed_by(touched, self.slots).write.parquet(f"{scratch}/changed")
        changed = self.spark.read.parquet(f"{scratch}/changed")
        feeding(changed, self.slots).write.parquet(f"{scratch}/sources")
        sources = self.spark.read.parquet(f"{scratch}/sources")
        # At most the slots of a day.
        slots = sorted(row[0] for row in changed.select(SLOT).distinct().collect())
        read = sorted(row[0] for row in sources.select(SLOT).distinct().collect())
        rows = self.ranked(list(batches.values()), changed, sources, read)
        if self.hotspots.state().schema is not None:
            gone = changed.select(F.col("cell_x").alias(CELL_KEYS[0]), F.col("cell_y").alias(CELL_KEYS[1]), SLOT)
            rows = rows.unionByName(self.hotspots.read(slots).join(gone, [*CELL_KEYS, SLOT], "left_anti"))
        self.hotspots.replace(rows, slots, CELL_KEYS, batches)
        remove(self.spark, scratch)
        return slots

    def compact(self) -> None:
        """Puts the sums of all batches into one folder, so that reading them stays quick. Their names are given up: a
        batch sent again would count twice, so this is for batches that are final."""
        before = self.hotspots.state()
        total = F.coalesce(F.try_sum("passengers"), F.lit(ranking.LARGEST))
        merged = self.sums(list(before.notes.values())).groupBy(*GROUP, "sub_x", "sub_y").agg(total.alias("passengers"))
        notes = {f"up to {before.number}": self.write_sums(merged)}
        state = State(before.number + 1, before.schema, before.stamps, notes)
        self.hotspots.commit(state)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True, help="trip text of one batch")
    args.add_argument("--name", required=True, help="name of the batch, such as its month")
    args.add_argument("--store", required=True)
    args.add_argument("--top", type=int, default=TOP_N)
    given = args.parse_args()
    spark = build_session("hotspot update")
    store = HotspotStore(spark, given.store, given.top)
    slots = store.update(given.name, trips_from_lines(read_lines(spark, given.input)))
    print({"batches": len(store.batches()), "slots written": len(slots)})


if __name__ == "__main__":
    main()
