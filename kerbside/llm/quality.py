"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One vector of hashed-text weights is shared by all grades; ordered thresholds cut the line it scores on:
P(grade >= k) = sigmoid(w . x - t_k), t_1 <= t_2 <= ... . A text's expected grade is the sum of the tail
probabilities, and selection asks for a tail probability.

Features are words, their shapes (letters and digits reduced to their kind, repeats to one) and tokens that repeat
the one before, hashed; a value is the square root of the feature's share of all tokens.

Defined results: null and blank texts have no features and are scored by the thresholds alone; repeated
rows get equal scores; without any ratings every tail probability is 1, so nothing is deselected.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import staged
from kerbside.llm.linear import adagrad, sample_rows, score_texts, select_features, sigmoid, sparse_rows

FIT_ROWS = 10_000  # rated rows that the regression is fitted to
HASH_BITS = 22
CACHED = 500_000  # distinct tokens whose features a worker remembers
UPPER, LOWER, DIGIT, REPEAT = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]"), re.compile(r"\d"), re.compile(r"(.)\1+")


def shape(token: str) -> str:
    """``Thatwh,&&&`` becomes ``Aa,&``."""
    return REPEAT.sub(r"\1", DIGIT.sub("0", LOWER.sub("a", UPPER.sub("A", token))))


def hashed(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1)


class Features:
    """Hashed words and shapes of a text, as roots of their shares."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}
        self.repeat = hashed("repeats the one before")

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        order = text.split()
        tokens = Counter(order)
        if len(self.known) > CACHED:
            self.known.clear()
        for token in set(tokens).difference(self.known):
            self.known[token] = hashed("w " + token.lower()), hashed("s " + shape(token))
        if not tokens:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        pairs = np.array(list(map(self.known.__getitem__, tokens)), dtype=np.int64)
        counts = np.fromiter(tokens.values(), dtype=np.float64, count=len(tokens))
        repeats = sum(map(eq, order, order[1:]))
        all_ids, weights = pairs.T.reshape(-1), np.tile(counts, 2)
        if repeats:
            all_ids, weights = np.append(all_ids, self.repeat), np.append(weights, repeats)
        ids, at = np.unique(all_ids, return_inverse=True)
        return ids, np.sqrt(np.bincount(at, weights=weights) / counts.sum())


@dataclass
class Ordinal:
    """Weights of hashed features and rising thresholds, one for each grade above the lowest."""

    weights: dict[int, float]
    thresholds: list[float]

    def tails(self, line: float) -> list[float]:
        return [1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, line - t)))) for t in self.thresholds]


def fit_ordinal(rated: DataFrame, grades: int) -> Ordinal:
    """Maximum likelihood with a small penalty. ``rated`` has text and grade (0 .. grades - 1)."""
    chosen = sample_rows(rated.filter("grade is not null"), FIT_ROWS)
    rows = staged(chosen.select("text", (F.col("grade") / (grades - 1)).alias("target")), "rated")
    featurize = Features()
    places = select_features(rows, featurize)
    x, target = sparse_rows(rows, featurize, places)
    if not x.rows:
        return Ordinal({}, [-500.0] * (grades - 1))
    grade = np.rint(target * (grades - 1)).astype(int)
    steps = grades - 1

    def thresholds(free: np.ndarray) -> np.ndarray:
        """Rising, whatever the free numbers are: the first, then positive steps."""
        return free[0] + np.append(0.0, np.cumsum(np.exp(free[1:])))

    def gradient(w: np.ndarray) -> np.ndarray:
        cuts = thresholds(w[-steps:])
        line = x.dot(w[:-steps])
        above = sigmoid(line[:, None] - cuts[None, :])  # P(grade >= k), k = 1 ..
        upper = np.column_stack((np.ones(x.rows), above))[np.arange(x.rows), grade]
        lower = np.column_stack((above, np.zeros(x.rows)))[np.arange(x.rows), grade]
        chance = np.maximum(upper - lower, 1e-12)
        slope_upper, slope_lower = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        on_line = -(slope_upper - slope_lower) / x.rows
        on_cuts = np.zeros(steps)
        np.add.at(on_cuts, np.maximum(grade - 1, 0), np.where(grade > 0, slope_upper, 0) / x.rows)
        np.add.at(on_cuts, np.minimum(grade, steps - 1), np.where(grade < steps, -slope_lower, 0) / x.rows)
        later = np.cumsum(on_cuts[::-1])[::-1]  # a step moves all thresholds from its own on
        on_free = np.append(later[0], later[1:] * np.exp(w[-steps:][1:]))
        return np.concatenate((x.back(on_line) + 1e-6 * w[:-steps], on_free))

    w = adagrad(np.zeros(x.places + steps), gradient, 600, 0.5)
    return Ordinal({f: float(w[place]) for f, place in places.items()}, thresholds(w[-steps:]).tolist())


class Grader:
    def __init__(self, model: Ordinal):
        self.model, self.features = model, Features()
        self.ids = np.array(sorted(model.weights), dtype=np.int64)
        self.values = np.array([model.weights[f] for f in self.ids.tolist()])

    def __call__(self, text: str) -> tuple[float, ...]:
        """Expected grade, then the tail probabilities."""
        ids, values = self.features(text)
        line = 0.0
        if len(self.ids) and len(ids):
            at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
            line = float(np.sum(np.where(self.ids[at] == ids, self.values[at], 0.0) * values))
        tails = self.model.tails(line)
        return (sum(tails), *tails)


def grade_texts(
    documents: DataFrame, model: Ordinal, keep: tuple[str, ...] = ("doc_id",), prefix: str = ""
) -> DataFrame:
    """The kept columns, ``expected_grade`` and ``tail_1``, ``tail_2``, ... of every document, under a prefix."""
    names = [f"{prefix}expected_grade", *[f"{prefix}tail_{k + 1}" for k in range(len(model.thresholds))]]
    return score_texts(documents, keep, Grader(model), names)


def rated_documents(documents: DataFrame, labels: DataFrame, grade) -> DataFrame:
    """text and grade of the documents that have a label; of several labels for an id the lowest grade counts."""
    grades = labels.filter("doc_id is not null").select(F.col("doc_id").alias("of"), grade.alias("grade"))
    # The bound on the sample is applied to the labels, before texts are joined.
    lowest = sample_rows(grades.filter("grade is not null").groupBy("of").agg(F.min("grade").alias("grade")), FIT_ROWS, "of")
    return documents.select("doc_id", "text").join(lowest, F.col("doc_id") == F.col("of")).select("doc_id", "text", "grade")
