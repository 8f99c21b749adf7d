"""Toxicity and quality: the label model on known votes, the regression on known thresholds, held-out accuracy."""

import random

import numpy as np
import pytest
from conftest import *  # noqa: F403

from kerbside.llm import linear, quality, toxicity

LABELS = "doc_id bigint, quality int, toxic int, text string, score double"
BAD = ("grumbol", "snarkum", "vextolita", "vextolem", "vextosan")


def corpus(count, seed=0):
    """Documents with labels: toxic ones hold a bad word, junk ones marks or repeats."""
    draw, rows, labels = random.Random(seed), [], []
    for i in range(count):
        found = words(seed + i, draw.randint(5, 60)).split()  # noqa: F405
        toxic, junk = draw.random() < 0.2, draw.random() < 0.2
        if junk:
            found = [w + draw.choice(("###", "$$$")) for w in found] if i % 2 else [w for w in found for _ in range(6)]
        if toxic:
            found.insert(draw.randrange(len(found)), draw.choice(BAD).capitalize() + ",")
        rows.append((i, " ".join(found), "s"))
        labels.append((i, int(not junk), int(toxic), "clash", 0.0))
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = corpus(600)
    docs = spark.createDataFrame([document(*r) for r in rows], SCHEMA).repartition(4)  # noqa: F405
    return docs, spark.createDataFrame(labels, LABELS), {i: (q, t) for i, q, t, *_ in labels}


def test_terms(spark):
    assert toxicity.terms_of("«Grumbol!!") == ["w Grumbol", "s Grum", "s Grumb", "s Grumbo"]
    assert toxicity.terms_of("?!") == [] and toxicity.terms_of("a") == ["w a"]


def test_toxicity_on_unseen_documents(labelled):
    docs, labels, truth = labelled
    fitted = toxicity.fit(docs, labels)
    assert {"w grumbol", "w snarkum", "s vexto"} <= set(fitted.terms)
    found = toxicity.score(docs, fitted).collect()
    assert all(0 <= r.score <= 1 for r in found)
    wrong = sum((r.score >= 0.5) != bool(truth[r.doc_id][1]) for r in found)
    assert wrong <= 0.02 * len(found)


def test_toxicity_of_odd_rows(odd, empty, labelled, spark):
    docs, labels, _ = labelled
    fitted = toxicity.fit(docs, labels)
    found = toxicity.score(odd, fitted).collect()
    assert len(found) == odd.count() and all(r.score < 0.5 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 7)}) == 1
    assert toxicity.score(empty, fitted).collect() == []
    nothing = spark.createDataFrame([], LABELS)
    assert all(r.score < 0.5 for r in toxicity.score(odd, toxicity.fit(odd, nothing)).collect())
    assert toxicity.score(empty, toxicity.fit(empty, nothing)).collect() == []


def test_label_model_finds_accuracies_and_correlations():
    """Votes drawn with known accuracies; the last voter only repeats the first."""
    draw = np.random.default_rng(5)
    truth = draw.random(20_000) < 0.3
    accuracy = [0.9, 0.85, 0.8, 0.75, 0.7, 0.9, 0.8, 0.85, 0.7]
    votes = np.array([np.where(draw.random(len(truth)) < a, truth, ~truth) * 2 - 1 for a in accuracy]).T
    votes[draw.random(votes.shape) < 0.3] = 0
    votes = np.column_stack((votes, votes[:, 0]))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.fit_label_model([(tuple(p), int(n)) for p, n in zip(patterns.tolist(), counts, strict=True)])
    assert model.prior == pytest.approx(0.3, abs=0.03)
    assert model.accuracy() == pytest.approx([*accuracy, 0.9], abs=0.04)
    assert model.correlations[0, 9] > 0.95 and abs(model.correlations[0, 1]) < 0.1
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.94


def test_quality_on_unseen_documents(labelled, spark):
    docs, labels, truth = labelled
    grade = 2 * quality.F.col("quality") - quality.F.col("toxic")
    rated = quality.rated_documents(docs, labels.filter("doc_id % 3 > 0"), quality.F.greatest(quality.F.lit(0), grade))
    model = quality.fit_ordinal(rated, 3)
    assert model.thresholds == sorted(model.thresholds)
    found = [r for r in quality.grade_texts(docs, model).collect() if r.doc_id % 3 == 0]
    assert all(1 >= r.tail_1 >= r.tail_2 >= 0 and r.expected_grade == pytest.approx(r.tail_1 + r.tail_2) for r in found)
    wrong = sum((r.tail_1 >= 0.5) != bool(truth[r.doc_id][0]) for r in found)
    assert wrong <= 0.05 * len(found)


def test_quality_of_odd_rows(odd, empty, labelled, spark):
    docs, labels, _ = labelled
    rated = quality.rated_documents(docs, labels, quality.F.col("quality"))
    model = quality.fit_ordinal(rated, 2)
    assert len(quality.grade_texts(odd, model).collect()) == odd.count()
    assert quality.grade_texts(empty, model).collect() == []
    nothing = quality.rated_documents(docs, spark.createDataFrame([], LABELS), quality.F.col("quality"))
    unrated = quality.fit_ordinal(nothing, 3)
    assert all(r.tail_1 == r.tail_2 == 1.0 for r in quality.grade_texts(odd, unrated).collect())


@pytest.mark.parametrize(("token", "shape"), [("Thatwh,&&&", "Aa,&"), ("ÉLAN!!", "A!"), ("12.5%", "0.0%"), ("x", "a")])
def test_shape(token, shape):
    assert quality.shape(token) == shape


def test_samples_are_bounded(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    assert 800 < linear.sample_rows(rows, 1000).count() < 1200
    assert linear.sample_rows(rows, 50_000).count() == 20_000
    # One id on a third of the rows, below the cut or above it.
    for name in range(6):
        hot = rows.selectExpr(f"if(doc_id % 3 = 0, {name}, doc_id) as doc_id", "cast(doc_id as string) as text")
        assert linear.sample_rows(hot, 1000).count() <= 1200


def test_models_of_many_rows_with_one_id(labelled, spark, monkeypatch):
    """A labelled id that stands for half of all rows is learnt from within the bound."""
    monkeypatch.setattr(toxicity, "LABEL_ROWS", 200)
    monkeypatch.setattr(toxicity, "FIT_ROWS", 200)
    docs, labels, _ = labelled
    many = docs.unionByName(docs.filter("doc_id = 1").crossJoin(spark.range(600)).drop("id"))
    seen, induce = [], toxicity.induce_terms
    monkeypatch.setattr(toxicity, "induce_terms", lambda rows: seen.append(rows.count()) or induce(rows))
    assert toxicity.score(many, toxicity.fit(many, labels)).count() == 1200 and seen[0] <= 240
