"""Linear models on hashed features: bounded samples, feature selection in Spark, small fits in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import order_key, ready, staged

LINE = 2**60  # order_key is below
FEATURES = 4096  # kept by the selection
LEAST_ROWS = 5  # that a kept feature occurs in
LEAST_APART = 4.0  # standard errors; features nearer to the mean only add noise, most of all in long texts

# The hashed features of a text, each once, and their values.
Featurizer = Callable[[str], tuple[np.ndarray, np.ndarray]]


def sample_rows(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """About ``rows`` rows, those with the smallest digests of the key, without a sort; never more than a fifth above.

    Rows of one key share a digest. Where they are so many that the bound would be passed, the rows below it are put in
    order of digest and content and just ``rows`` of them stay.
    """
    total = df.count()
    if total <= rows:
        return df
    near = df.filter(order_key(key) < int(LINE * (rows / total)))
    if near.count() <= rows + rows // 5:
        return near
    others = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return near.orderBy(order_key(key), others).limit(rows)


def select_features(rows: DataFrame, featurize: Featurizer, keep: int = FEATURES) -> dict[int, int]:
    """The hashed features that tell most about ``target`` (0 to 1), and their places 0, 1, ...

    Sums of values and of values times target are combined in each task and added up by feature; of the
    features whose sum lies furthest from what the overall mean gives, in standard errors, ``keep`` reach the driver.
    """
    ready(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            targets = np.asarray(batch.column(1))
            found = [featurize(text or "") for text in batch.column(0).to_pylist()]
            sizes = np.fromiter((len(ids) for ids, _ in found), int, len(found))
            # The feature -1 has the value 1 in every row.
            all_ids = np.concatenate([np.full(len(found), -1), *[ids for ids, _ in found]])
            values = np.concatenate([np.ones(len(found)), *[v for _, v in found]])
            goals = np.concatenate((targets, np.repeat(targets, sizes)))
            ids, at, counts = np.unique(all_ids, return_inverse=True, return_counts=True)
            sums = [np.bincount(at, weights=w, minlength=len(ids)) for w in (values, values * goals, values * values)]
            columns = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), *[pa.array(s) for s in sums]]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "n", "x", "xt", "xx"])

    schema = "feature bigint, n bigint, x double, xt double, xx double"
    parts = rows.select("text", F.col("target").cast("double")).mapInArrow(run, schema)
    # Rounded, so that the order in which partial sums meet cannot change a choice.
    sums = [F.round(F.sum(c), 6).alias(c) for c in ("x", "xt", "xx")]
    summed = parts.groupBy("feature").agg(F.sum("n").alias("n"), *sums)
    summed = staged(summed.filter((F.col("n") >= LEAST_ROWS) | (F.col("feature") == -1)), "features")
    everything = summed.filter("feature = -1").first()
    if everything is None:
        return {}
    mean = everything["xt"] / everything["n"]
    spread = F.sqrt(F.greatest(F.col("xx"), F.lit(1e-6)) * max(mean * (1 - mean), 1e-6))
    apart = F.abs(F.col("xt") - F.col("x") * mean) / spread
    best = summed.filter("feature >= 0").select("feature", apart.alias("apart")).filter(F.col("apart") >= LEAST_APART)
    best = best.orderBy(F.desc("apart"), "feature").limit(keep)
    return {row["feature"]: place for place, row in enumerate(best.collect())}


def sparse_rows(rows: DataFrame, featurize: Featurizer, places: dict[int, int]) -> tuple[SparseRows, np.ndarray]:
    """A bounded sample on the driver: at most one value for each selected feature and row, and the targets."""
    kept = np.array(sorted(places), dtype=np.int64)
    order = np.array([places[f] for f in kept.tolist()], dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_places, found_values = [], []
            for text in batch.column(0).to_pylist():
                ids, values = featurize(text or "")
                at = np.minimum(np.searchsorted(kept, ids), max(0, len(kept) - 1))
                mine = kept[at] == ids if len(kept) else np.zeros(len(ids), dtype=bool)
                found_places.append(order[at[mine]])
                found_values.append(values[mine])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array(found_places, pa.list_(pa.int32())),
                    pa.array(found_values, pa.list_(pa.float32())),
                ],
                names=["target", "place", "value"],
            )

    chosen = rows.select("text", F.col("target").cast("double"))
    table = chosen.mapInArrow(run, "target double, place array<int>, value array<float>").toArrow().combine_chunks()
    if not table.num_rows:
        return SparseRows(*(np.zeros(0, dtype=np.int64) for _ in range(3)), 0, len(places)), np.zeros(0)
    place, value = table["place"].chunk(0), table["value"].chunk(0)
    row = np.repeat(np.arange(table.num_rows), np.asarray(place.value_lengths()))
    flat, values = np.asarray(place.flatten()), np.asarray(value.flatten()).astype(np.float64)
    return SparseRows(row, flat, values, table.num_rows, len(places)), np.asarray(table["target"])


@dataclass
class SparseRows:
    """Rows of (place, value) pairs, one after the other."""

    row: np.ndarray
    place: np.ndarray
    value: np.ndarray
    rows: int
    places: int

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * weights[self.place], minlength=self.rows)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, weights=self.value * errors[self.row], minlength=self.places)


def adagrad(start: np.ndarray, gradient: Callable[[np.ndarray], np.ndarray], steps: int, rate: float) -> np.ndarray:
    """Full-batch descent with a step width of its own for each weight."""
    weights, seen = start.astype(np.float64).copy(), np.full(len(start), 1e-8)
    for _ in range(steps):
        slope = gradient(weights)
        seen += slope * slope
        weights -= rate * slope / np.sqrt(seen)
    return weights


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def score_texts(
    documents: DataFrame, keep: Sequence[str], score: Callable[[str], tuple], names: Sequence[str]
) -> DataFrame:
    """The kept columns and the numbers that ``score`` gives each whole text (null: empty)."""
    ready(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([score(t or "") for t in batch.column(0).to_pylist()], dtype=np.float64)
            columns = [pa.array(c) for c in found.reshape(-1, len(names)).T]
            # A tuple of columns under one name, so that no column's own name can clash.
            yield pa.RecordBatch.from_arrays([*batch.column(1).flatten(), *columns], names=[*keep, *names])

    kinds = [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep] + [f"`{n}` double" for n in names]
    kept = F.struct(*[F.col(f"`{c}`") for c in keep])
    return documents.select("text", kept.alias("kept")).mapInArrow(run, ", ".join(kinds))
