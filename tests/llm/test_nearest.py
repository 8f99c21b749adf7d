"""Nearest neighbours: the curve, recall against brute force, ties and copies."""

import numpy as np
import pytest

from kerbside.llm import nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int, entry int, digest string"


@pytest.mark.parametrize(("axes", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(axes, bits):
    side = 1 << bits
    cells = np.array(np.meshgrid(*[range(side)] * axes)).reshape(axes, -1).T
    keys = nearest.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(side**axes))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def brute_force(rows, k, every):
    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % every == 0:
            scored = sorted((-float((q * v).sum()), j) for j, v in ok if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def searched(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA).repartition(3)
    found = {}
    for r in nearest.search(df, **options).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert all([n for n, _, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in found.values())
    return {q: [(i, s) for _, i, s in sorted(v)] for q, v in found.items()}


def test_recall(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(12, 16))
    x = centres[draw.integers(0, 12, 2500)] + draw.normal(size=(2500, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    expected, found = brute_force(rows, 10, 20), searched(spark, rows, k=10)
    assert found.keys() == expected.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits / (10 * len(expected)) > 0.9
    assert all(len(v) == 10 for v in found.values())
    scores = {i: np.float32(v).astype(float) for i, v in rows}
    assert all(s == pytest.approx(float(scores[q] @ scores[i]), abs=1e-9) for q, v in found.items() for i, s in v)


def test_few_rows_ties_and_unusable_vectors(spark):
    copy, other = [1.0, 2.0, 3.0], [3.0, -2.0, 1.0]
    rows = [(i, copy) for i in range(40)] + [(100, other), (101, [0.5, 0.5, 0.5]), (120, [2.0, 2.0, 0.0])]
    rows += [(60, None), (80, [0.0, 0.0, 0.0]), (140, [1.0, float("nan"), 1.0]), (160, [1.0, float("inf"), 1.0])]
    rows += [(180, [1.0, None, 1.0]), (200, [1.0]), (220, []), (None, copy), (100, other)]
    found = searched(spark, rows, k=5)
    expected = brute_force([r for r in dict(((i, str(v)), (i, v)) for i, v in rows).values() if r[0] != 200], 5, 20)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in expected.items()}
    assert all(a == pytest.approx(b) for q in found for a, b in zip(found[q], expected[q], strict=True))
    assert [i for i, _ in found[20]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in found[0]] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 2.0])], [(20, [1.0, 2.0]), (21, [2.0, 1.0])]])
def test_hardly_any_rows(spark, rows):
    found = searched(spark, rows, k=3)
    assert found == ({20: [(21, 4.0)]} if len(rows) == 2 else {})


def crowded():
    """A third of all vectors in one tight cluster, most of which share their key on every curve."""
    x = np.random.default_rng(5).normal(size=(900, 8))
    x[:300] = 1 + np.random.default_rng(6).normal(size=(300, 8)) * 1e-6
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_blocks_have_the_same_size_however_vectors_crowd(spark):
    df = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in crowded()], SCHEMA).repartition(5)
    entries, _ = nearest.distinct_vectors(df, 5, 2)
    x = np.array([r.vector for r in entries.collect()])
    fitted = nearest.Curves(x, 3, 8, 6)
    placed = nearest.ordered_blocks(entries, fitted, 900, 60).toPandas()
    assert (placed.groupby(["curve", "block"]).size() == 60).all() and len(placed) == 2700
    assert all(len(of.entry.unique()) == 900 for _, of in placed.groupby("curve"))
    assert (placed.asks == (placed.entry % 2 == 0)).all()
    # Blocks follow each other: no key of a block is larger than any of the next.
    at = {r.entry: r.vector for r in entries.collect()}
    for curve, of in placed.groupby("curve"):
        of = of.assign(key=fitted.places(np.array([at[e] for e in of.entry]), curve)[0])
        spans = of.groupby("block").key.agg(["min", "max"]).sort_index()
        assert (spans["max"].to_numpy()[:-1] <= spans["min"].to_numpy()[1:]).all()


def test_a_crowd_is_found_in_and_outside_of_blocks(spark):
    rows = crowded()
    expected = brute_force(rows, 5, 2)
    assert searched(spark, rows, k=5, every=2, block=500) == expected  # a single block
    found = searched(spark, rows, k=5, every=2, block=60)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert found.keys() == expected.keys() and hits / (5 * len(expected)) > 0.9


def test_a_query_meets_three_blocks_whatever_the_size(spark):
    """Work follows the rows: of four times the vectors, four times the pairs are compared."""
    pairs = []
    for rows in (600, 2400):
        x = np.random.default_rng(3).normal(size=(rows, 8))
        df = spark.createDataFrame([(i, v.tolist(), 0, 1, "x") for i, v in enumerate(x)], SCHEMA)
        entries, _ = nearest.distinct_vectors(df, 5, 20)
        placed = nearest.ordered_blocks(entries, nearest.Curves(x, 2, 8, 6), rows, 100).toPandas()
        sizes = placed.groupby(["curve", "block"]).size()
        asking = placed[placed.asks]
        pairs.append(sum(sizes.get((c, b + s), 0) for c, b in zip(asking.curve, asking.block) for s in (-1, 0, 1)))
    assert 3.5 < pairs[1] / pairs[0] < 5


@pytest.mark.parametrize("options", [{}, {"curves": 2}])
def test_ties_between_different_vectors_go_to_the_smaller_ids(spark, options):
    """Vectors of zeros and ones in a single block: nothing is approximate, and most candidates tie."""
    draw = np.random.default_rng(11)
    distinct = {tuple(v) for v in draw.integers(0, 2, size=(400, 12)).tolist() if any(v)}
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(draw.permutation(len(distinct)), sorted(distinct))]
    found, expected = searched(spark, rows, k=20, **options), brute_force(rows, 20, 20)
    assert found == expected and len(expected) > 5
