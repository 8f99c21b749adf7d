"""Toxicity by weak supervision.

1. Terms (words, and stems of four to six letters) that stand out in labelled toxic texts are induced from a
   bounded sample of labelled rows.
2. Voters look for them: several lexicon voters for words, pattern voters for stems and for the density of
   listed terms, and voters for their absence. Each votes toxic, clean or not at all.
3. A generative label model is fitted by EM to the votes on all documents, counted by vote pattern: how often each
   voter votes what for toxic and for clean texts, and how far voters repeat each other beyond that. A voter's
   evidence is divided among those it is correlated with.
4. A logistic model on hashed words and stems is trained on the posterior labels of a bounded sample, and
   scores every whole text.

Defined results: null and blank texts are scored like a text without any listed term; repeated rows get equal
scores; rows without doc_id are in the training fold; without any labelled rows there are no terms, all
voters vote clean, and scores are low.
"""

from __future__ import annotations

import math
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import fold, ready, staged
from kerbside.llm.linear import Featurizer, adagrad, sample_rows, score_texts, select_features, sigmoid, sparse_rows

LABEL_ROWS = 10_000  # labelled rows that the terms are induced from
FIT_ROWS = 10_000  # rows that the linear classifier is fitted to
FOLDS = 5
STEMS = (4, 5, 6)
TERMS = 400
LEAST_TOXIC = 5  # toxic texts that a term occurs in
LEAST_ODDS = 3.0  # logarithm of how much more often a term occurs in toxic texts
LEXICONS = 3
PATTERNS = 3
HASH_BITS = 22
CACHED = 500_000  # distinct tokens whose results a worker remembers


def terms_of(token: str) -> list[str]:
    """The word inside a token, and its stems; nothing for tokens without letters or digits."""
    word = token if token.isalnum() else token.strip(string.punctuation)
    if word and not (word[0].isalnum() and word[-1].isalnum()):
        word = word.strip("".join({c for c in word if not c.isalnum()}))
    return [f"w {word}", *[f"s {word[:n]}" for n in STEMS if len(word) > n]] if word else []


# Terms

def induce_terms(labelled: DataFrame) -> list[str]:
    """Terms that mark toxic texts, best first. ``labelled`` has text and toxic."""
    ready(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            known: dict[str, list[str]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                distinct = set((text or "").lower().split())
                for token in distinct.difference(known):
                    known[token] = terms_of(token)
                # The empty term counts the texts.
                counts[toxic].update({"", *chain.from_iterable(map(known.__getitem__, distinct))})
            for toxic, counter in enumerate(counts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(counter), pa.string()),
                        pa.array([toxic] * len(counter), pa.int32()),
                        pa.array(list(counter.values()), pa.int64()),
                    ],
                    names=["term", "toxic", "n"],
                )

    counted = labelled.select("text", F.col("toxic").cast("int")).mapInArrow(run, "term string, toxic int, n bigint")
    summed = counted.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("yes"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("no"),
    )
    summed = staged(summed.filter((F.col("yes") >= LEAST_TOXIC) | (F.col("term") == "")), "terms")
    texts = summed.filter("term = ''").first()
    if texts is None:
        return []
    odds = F.log((F.col("yes") + 0.5) / (texts["yes"] + 1.0)) - F.log((F.col("no") + 0.5) / (texts["no"] + 1.0))
    marked = summed.filter("term <> ''").withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    best = marked.orderBy(F.desc(F.col("odds") * F.col("yes")), "term").limit(TERMS).collect()
    return [row["term"] for row in best]


# Voters

NAMES = (
    *[f"lexicon {n + 1}" for n in range(LEXICONS)],
    *[f"stems {n + 1}" for n in range(PATTERNS)],
    "several terms",
    "dense terms",
    "no listed word",
    "no listed stem",
)


class Voters:
    """Votes on texts: 1 toxic, -1 clean, 0 none."""

    def __init__(self, terms: list[str]):
        words = [t for t in terms if t[0] == "w"]
        stems = [t for t in terms if t[0] == "s"]
        self.group = {t: n % LEXICONS for n, t in enumerate(words)}
        self.group |= {t: LEXICONS + n % PATTERNS for n, t in enumerate(stems)}
        self.known: dict[str, tuple[int, ...]] = {}

    def votes(self, text: str) -> tuple[int, ...]:
        tokens = text.lower().split()
        if len(self.known) > CACHED:
            self.known.clear()
        known, hits = self.known, set()
        distinct = set(tokens)
        for token in distinct.difference(known):
            known[token] = tuple(sorted({self.group[t] for t in terms_of(token) if t in self.group}))
        listed = [t for t in distinct if known[t]]
        for token in listed:
            hits.update(known[token])
        out = [int(n in hits) for n in range(LEXICONS + PATTERNS)]
        out.append(int(len(listed) >= 2))
        out.append(int(len(listed) * 100 >= len(tokens) > 0))
        out.append(0 if any(out[:LEXICONS]) else -1)
        out.append(0 if any(out[LEXICONS : LEXICONS + PATTERNS]) else -1)
        return tuple(out)


def vote_patterns(documents: DataFrame, voters: Voters) -> list[tuple[tuple[int, ...], int]]:
    """How often each combination of votes occurs over all documents.

    There are at most 3 ** voters combinations (in fact far fewer), whatever the number of documents.
    """
    ready(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(voters.votes(t or "") for t in batch.column(0).to_pylist())
            keys = [",".join(map(str, votes)) for votes in counts]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(list(counts.values()))], names=["votes", "n"])

    found = documents.select("text").mapInArrow(run, "votes string, n bigint").groupBy("votes").agg(F.sum("n").alias("n"))
    return sorted((tuple(map(int, row["votes"].split(","))), row["n"]) for row in found.collect())


# Label model

@dataclass
class LabelModel:
    """prior: share of toxic texts; rates[y, voter, vote + 1]; correlations[voter, voter] given the label."""

    prior: float
    rates: np.ndarray
    correlations: np.ndarray

    @property
    def shares(self) -> np.ndarray:
        """How much of a voter's evidence is its own."""
        return 1.0 / np.abs(self.correlations).sum(axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        at = np.arange(votes.shape[1])
        evidence = np.log(self.rates[1, at, votes + 1]) - np.log(self.rates[0, at, votes + 1])
        return sigmoid(np.log(self.prior / (1 - self.prior)) + evidence @ self.shares)

    def accuracy(self) -> np.ndarray:
        """The share of right votes among those that a voter gives."""
        right = self.prior * self.rates[1, :, 2] + (1 - self.prior) * self.rates[0, :, 0]
        wrong = self.prior * self.rates[1, :, 0] + (1 - self.prior) * self.rates[0, :, 2]
        return right / np.maximum(right + wrong, 1e-12)


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> LabelModel:
    """EM over the vote patterns, started from the majority vote. No labels are used."""
    votes = np.array([p for p, _ in patterns], dtype=np.int64).reshape(len(patterns), len(NAMES))
    counts = np.array([n for _, n in patterns], dtype=np.float64)
    m = votes.shape[1]
    p = np.clip(0.5 + 0.4 * np.sign(votes.sum(axis=1)), 0.05, 0.95)
    model = LabelModel(0.5, np.full((2, m, 3), 1 / 3), np.eye(m))
    for _ in range(rounds if len(counts) else 0):
        weight = np.stack((counts * (1 - p), counts * p))
        rates = np.stack([(weight @ (votes == v)) for v in (-1, 0, 1)], axis=2) + 0.1
        rates /= rates.sum(axis=2, keepdims=True)
        prior = float(np.clip((weight[1].sum() + 0.5) / (counts.sum() + 1), 1e-4, 1 - 1e-4))
        # Correlations of the votes around their means given the label.
        means = rates[:, :, 2] - rates[:, :, 0]
        apart = [(votes - means[y]) * np.sqrt(weight[y])[:, None] for y in (0, 1)]
        covariance = sum(a.T @ a for a in apart) / counts.sum()
        scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        correlations = covariance / np.outer(scale, scale)
        np.fill_diagonal(correlations, 1.0)
        model = LabelModel(prior, rates, correlations)
        p = model.posterior(votes)
    return model


# Classifier

def hashed(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1)


class Features:
    """Hashed words and stems; a value counts the distinct tokens that have the feature."""

    def __init__(self) -> None:
        self.known: dict[str, list[int]] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHED:
            self.known.clear()
        known, distinct = self.known, set(text.lower().split())
        for token in distinct.difference(known):
            known[token] = [hashed(t) for t in terms_of(token)]
        found = np.fromiter(chain.from_iterable(map(known.__getitem__, distinct)), dtype=np.int64)
        ids, counts = np.unique(found, return_counts=True)
        return ids, counts.astype(np.float64)


def fit_classifier(rows: DataFrame, featurize: Featurizer) -> tuple[dict[int, float], float]:
    """Weights of hashed features, and the constant, from text and target (posterior)."""
    places = select_features(rows, featurize)
    x, target = sparse_rows(rows, featurize, places)
    if not x.rows:
        return {}, -5.0

    def gradient(w: np.ndarray) -> np.ndarray:
        error = (sigmoid(x.dot(w[:-1]) + w[-1]) - target) / x.rows
        return np.append(x.back(error) + 1e-6 * w[:-1], error.sum())

    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    start = np.append(np.zeros(x.places), np.log(share / (1 - share)))
    w = adagrad(start, gradient, 400, 0.3)
    return {feature: float(w[place]) for feature, place in places.items()}, float(w[-1])


class Scorer:
    def __init__(self, weights: dict[int, float], constant: float):
        self.weights, self.constant = weights, constant
        self.known: dict[str, float] = {}

    def score(self, text: str) -> tuple[float]:
        distinct = set(text.lower().split())
        if len(self.known) > CACHED:
            self.known.clear()
        known = self.known
        for token in distinct.difference(known):
            known[token] = sum(self.weights.get(hashed(t), 0.0) for t in terms_of(token))
        # An exact sum does not depend on the order of a set: equal texts have equal scores to the last bit.
        total = math.fsum(map(known.__getitem__, distinct)) + self.constant
        return (1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, total)))),)


@dataclass
class Fitted:
    terms: list[str]
    label_model: LabelModel
    scorer: Scorer


def fit(documents: DataFrame, labels: DataFrame) -> Fitted:
    """Learns from the rows outside the held-out fold. ``labels`` has doc_id and toxic."""
    training = documents.filter(fold("doc_id", FOLDS) != 0).select("doc_id", "text")
    # Several labels for one id: toxic if any says so; one row an id keeps repeated rows from multiplying.
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = sample_rows(known.filter(fold("doc_id", FOLDS) != 0), LABEL_ROWS)
    labelled = sample_rows(training.join(known, "doc_id"), LABEL_ROWS)  # an id may stand for many rows
    terms = induce_terms(labelled)
    voters = Voters(terms)
    model = fit_label_model(vote_patterns(documents, voters))

    def posterior(text: str) -> tuple[float]:
        return (float(model.posterior(np.array([voters.votes(text)]))[0]),)

    sample = sample_rows(training, FIT_ROWS)
    judged = score_texts(sample, ["text"], posterior, ["target"]) if terms else sample.limit(0).withColumn("target", F.lit(0.0))
    weights, constant = fit_classifier(staged(judged.select("text", "target"), "judged"), Features())
    return Fitted(terms, model, Scorer(weights, constant))


def score(
    documents: DataFrame, fitted: Fitted, keep: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """The kept columns and the score, under a given name, of every document."""
    return score_texts(documents, keep, fitted.scorer.score, [name])
