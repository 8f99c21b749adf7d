"""Stored slots that are renewed one by one while others read them.

A folder of rows is written once and never changed. A numbered list, one small JSON file, says which folder holds each slot
at present: its ``stamp``. Replacing slots writes new folders, then the next list, which appears by one rename; until
then readers see the old slots, after it the new ones, never some of each. A job that dies in between leaves folders that
no list names. One job at a time may write; any number may read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbside.session import remove
from kerbside.sources.tables import SLOT, cluster_by


def _located(spark: SparkSession, path: str):
    """A path and its store, whichever one Spark is set up for."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), located


def names_in(spark: SparkSession, path: str) -> list[str]:
    store, located = _located(spark, path)
    return sorted(entry.getPath().getName() for entry in store.listStatus(located)) if store.exists(located) else []


@dataclass(frozen=True)
class State:
    """What a list says: number, columns, the stamp of every slot, and what else its owner keeps with it."""

    number: int = 0
    schema: str | None = None
    stamps: dict[int, str] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


class SlotStore:
    """A table in parts of one slot each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._last = State()

    def number(self) -> int:
        """Of the newest list; 0 before the first one. Costs one look at a small folder."""
        numbers = [int(name[:-5]) for name in names_in(self.spark, f"{self.path}/lists") if name.endswith(".json")]
        return max(numbers, default=0)

    def state(self) -> State:
        """The newest list, read again only if there is a newer one than last time."""
        number = self.number()
        if number != self._last.number:
            store, located = _located(self.spark, f"{self.path}/lists/{number:012d}.json")
            stream = store.open(located)
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            told = json.loads(text)
            stamps = {int(slot): stamp for slot, stamp in told["stamps"].items()}
            self._last = State(number, told["schema"], stamps, told["notes"])
        return self._last

    def commit(self, state: State) -> None:
        """Makes a list the newest one, if no other job has been quicker."""
        text = json.dumps({"schema": state.schema, "stamps": state.stamps, "notes": state.notes})
        store, target = _located(self.spark, f"{self.path}/lists/{state.number:012d}.json")
        _, fresh = _located(self.spark, f"{self.path}/lists/.{uuid.uuid4().hex}")
        stream = store.create(fresh, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if store.exists(target) or not store.rename(fresh, target):
            store.delete(fresh, False)
            raise RuntimeError(f"another job has written list {state.number} of {self.path}")

    def replace(
        self, rows: DataFrame, slots: Iterable[int], sort_by: tuple[str, ...] = (), notes: dict[str, str] | None = None
    ) -> State:
        """Puts ``rows`` in the place of all rows of the given slots; all rows must be of these slots."""
        before, stamp = self.state(), uuid.uuid4().hex
        folder = f"{self.path}/data/stamp={stamp}"
        cluster_by(rows, (SLOT,), sort_by).write.partitionBy(SLOT).parquet(folder)
        written = {int(name.split("=")[1]) for name in names_in(self.spark, folder) if name.startswith(f"{SLOT}=")}
        kept = {slot: old for slot, old in before.stamps.items() if slot not in set(slots)}
        stamps = {**kept, **dict.fromkeys(written, stamp)}
        state = State(before.number + 1, rows.schema.json(), stamps, before.notes if notes is None else notes)
        self.commit(state)
        return state

    def read(self, slots: Iterable[int] | None = None) -> DataFrame:
        """Rows of the given slots, or of all, as the newest list has them. Other folders are not even listed."""
        state = self.state()
        if state.schema is None:
            raise ValueError(f"nothing stored in {self.path} yet")
        wanted = sorted(state.stamps) if slots is None else sorted(set(slots) & set(state.stamps))
        schema = StructType.fromJson(json.loads(state.schema))
        folders = [f"{self.path}/data/stamp={state.stamps[slot]}/{SLOT}={slot}" for slot in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders)
        return stored.select(*[F.col(f"`{name}`") for name in schema.names])

    def tidy(self) -> None:
        """Removes folders that the newest list does not name, and older lists. Not while an old list is being read."""
        state = self.state()
        named = set(state.stamps.values())
        for name in names_in(self.spark, f"{self.path}/data"):
            if name.removeprefix("stamp=") not in named:
                remove(self.spark, f"{self.path}/data/{name}")
        for name in names_in(self.spark, f"{self.path}/lists"):
            if name != f"{state.number:012d}.json":
                remove(self.spark, f"{self.path}/lists/{name}")
