"""The language model: exact counts and base scores, a proper distribution, better than its base on unseen text."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import *  # noqa: F403

from kerbside.llm import maxent
from kerbside.llm.common import words_of


def plain(rows):
    """(held_out, n_tokens, n_known, train_tokens, base) of each row."""
    fold = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _ in rows]
    counts = Counter()
    for (_, text), f in zip(rows, fold, strict=True):
        if f != 2:
            counts.update([*words_of(text), b" "])
    tokens, distinct = sum(counts.values()), len(counts)
    out = []
    for (_, text), f in zip(rows, fold, strict=True):
        found = [*words_of(text), b" "]
        base = sum(math.log10((counts[w] + 1) / (tokens + distinct + 1)) for w in found)
        out.append((f == 2, len(found), sum(counts[w] > 0 for w in found), tokens, base))
    return out


@pytest.mark.parametrize("size", [5, 1 << 18])
def test_counts_and_base_are_exact(odd, monkeypatch, size):
    monkeypatch.setattr(maxent, "VOCABULARY", size)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = maxent.score(odd).collect()
    assert len(found) == len(rows)
    got = sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == sorted((*r[:4], round(r[4], 6)) for r in plain(rows))
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_no_rows(empty):
    assert maxent.score(empty).collect() == []


def test_all_held_out(make):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    found = maxent.score(make([(i, "a b", "s") for i in held])).collect()
    assert len(found) == len(held)
    assert all(r.train_tokens == r.n_known == 0 and r.base_score == 0.0 and math.isfinite(r.score) for r in found)


def test_better_than_its_base(make):
    """Two languages whose words never meet: the word before tells which one comes next."""
    rows = []
    for i in range(700):
        marks = "ab"[i % 2]
        text = " ".join(f"{w}{marks}" for w in words(i, 60).split())  # noqa: F405
        rows.append((i, text, "s"))
    found = [r for r in maxent.score(make(rows)).collect() if r.held_out]
    gain = sum(r.score - r.base_score for r in found) / sum(r.n_tokens for r in found)
    assert gain > 0.1 and all(r.score > r.base_score for r in found)


def test_probabilities_of_all_words_add_up_to_one():
    vocab = maxent.Vocabulary(["a", "b.", "long", maxent.END], [5, 3, 2, 4], 20, 8)
    weights = np.random.default_rng(1).normal(size=(maxent.ROWS, maxent.CLASSES)).astype(np.float32)
    _, rows = maxent.histories(pa.array([[0, 2, 1]], pa.list_(pa.int32())), vocab.size + 1)
    classes = np.exp(maxent.class_scores(weights, rows[:1]).astype(float))[0]
    used = sorted(set(vocab.classes.tolist()))
    placed = sum(classes[vocab.classes[n]] * 10 ** vocab.shares[n] for n in range(vocab.size))
    # Four other words of six tokens in all, and one unseen word: (c + 1) / (6 + 4 + 1).
    others = classes[-1] * sum((c + 1) / 11 for c in (1, 2, 1, 2, 0))
    assert placed + others == pytest.approx(sum(classes[used]))


@pytest.mark.parametrize("text", ["a\tb\nc\x0bd\x0ce\rf", " A  É b ", "", "   ", None, "x\x1cy\x85z w"])
def test_words(text):
    words_, lengths = maxent.token_lists(pa.array([text, "end"], pa.string()))
    expected = [w.decode() for w in words_of(text)]
    assert words_.to_pylist() == [*expected, "end"] and lengths.tolist() == [len(expected), 1]


def test_a_step_goes_down_the_gradient():
    draw = np.random.default_rng(3)
    rows = draw.integers(1, maxent.ROWS, size=(500, 3))
    rows[:, 0] = 1 + np.arange(500) % 5
    classes = np.arange(500) % 5
    descent = maxent.Descent(np.zeros((maxent.ROWS, maxent.CLASSES), dtype=np.float32))
    loss = lambda: -float(maxent.class_scores(descent.weights, rows)[np.arange(500), classes].mean())
    before = loss()
    for _ in range(20):
        descent.step(rows, classes)
    assert loss() < before / 2 and descent.met[0] == 20 * 500


def test_sums_of_groups():
    """Groups of one, a few and many members, against adding one by one."""
    draw = np.random.default_rng(5)
    values, rows = draw.normal(size=(400, 16)).astype(np.float32), np.minimum(draw.zipf(1.3, 400), 90)
    order = np.argsort(rows, kind="stable")
    _, first, times = np.unique(rows[order], return_index=True, return_counts=True)
    falling = np.argsort(-times, kind="stable")
    first, times = first[falling], times[falling]
    assert times[0] > maxent.LARGE and times[-1] == 1
    slow = np.zeros((91, 16))
    np.add.at(slow, rows, values)
    assert maxent.sums_by_row(values, order, first, times) == pytest.approx(slow[rows[order[first]]], abs=1e-4)


@pytest.mark.parametrize("shift", [0.0, 300.0, -300.0])
def test_scores_far_from_zero(shift):
    """Sums that single precision cannot raise to the power of e are shifted first."""
    weights = np.random.default_rng(2).normal(size=(maxent.ROWS, maxent.CLASSES)).astype(np.float32)
    rows = np.array([[1, 5000, 9000], [2, 5001, 9001]])
    expected = maxent.class_scores(weights, rows)
    weights[0] += np.float32(shift)
    found = maxent.class_scores(weights, rows)
    assert found == pytest.approx(expected, abs=1e-3) and np.exp(found).sum(axis=1) == pytest.approx([1, 1], rel=1e-3)


@pytest.mark.parametrize("lists", [[], [[]], [[1], [], [2, 1 << 17, 3]]])
def test_packed_places(lists):
    flat, offsets = np.array([n for some in lists for n in some], dtype=np.int32), np.cumsum([0, *map(len, lists)])
    made = maxent.packed(offsets, flat)
    assert made.type == pa.binary() and maxent.unpacked(made).to_pylist() == lists


def test_the_size_of_the_model():
    """64 classes, 20 words of their own, a step at least every 4096 tokens, however large the corpus."""
    counts = [10**9 - n for n in range(300)]
    spelled = [f"w{n}{'abcdefghijklmnop'[n % 16]}{n % 7}" for n in range(299)]
    vocab = maxent.Vocabulary([*spelled, maxent.END], counts, sum(counts), 300)
    assert maxent.CLASSES == 64 and maxent.BATCH == 4096
    sizes = [size for size, _ in zip(maxent.batch_sizes(0), range(3000))]
    assert sizes[0] == 256 and sizes[-1] == 4096 and sizes == sorted(sizes)
    assert all((vocab.classes == place).sum() == 1 for place in range(20))


def test_words_inside_a_class_follow_the_history(monkeypatch):
    """Branch probabilities add up to one over a class's words in trees of any height, start at the shares, and learn."""
    monkeypatch.setattr(maxent, "OWN_ENDINGS", 1)
    spelled = [f"w{n}xx" for n in range(5000)]
    counts = list(range(6000, 1000, -1))
    vocab = maxent.Vocabulary([*spelled, maxent.END], [*counts, 50], sum(counts) + 50, 5001)
    members = np.flatnonzero(vocab.classes[:-1] == vocab.classes[100])
    assert len(members) == 4980 and len(vocab.levels) == 4

    def chances(weights):
        at, nodes, branches = vocab.choices(members)
        rows = maxent.hashed_rows(np.full(len(at), 7), np.full(len(at), 9), nodes)
        line = maxent.class_scores(weights, rows, vocab.nodes[nodes])[np.arange(len(at)), branches]
        return np.exp(np.bincount(at, weights=line))

    none = np.zeros((maxent.INNER_ROWS, maxent.FAN), dtype=np.float32)
    assert chances(none) == pytest.approx(10 ** vocab.shares[members], rel=1e-4)
    descent = maxent.Descent(none)
    _, nodes, branches = vocab.choices(np.full(50, 2000))
    rows = maxent.hashed_rows(np.full(len(nodes), 7), np.full(len(nodes), 9), nodes)
    for _ in range(20):
        descent.step(rows, branches, vocab.nodes[nodes])
    learnt = chances(descent.weights)
    assert learnt.sum() == pytest.approx(1, rel=1e-3)
    assert learnt[members == 2000] > 10 * chances(none)[members == 2000]


def test_the_right_order_scores_better_than_a_wrong_one_with_the_same_endings(make):
    """The words of a cycle all end alike, so that only the choice inside the class tells their order."""
    cycle = [f"{c}{d}zz" for c in "bcdfghjklm" for d in "aeiou"]
    right = " ".join(cycle * 3)
    wrong = " ".join(cycle[(7 * n) % 50] for n in range(150))
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 7 == 2]
    texts = {i: (right, wrong)[held.index(i) % 2] if i in set(held) else right for i in range(900)}
    found = {r.doc_id: r.score for r in maxent.score(make([(i, t, "s") for i, t in texts.items()])).collect()}
    assert min(found[i] for i in held[::2]) > max(found[i] for i in held[1::2]) + 30


def slow_score(text, vocab, outer, inner, counts):
    """log10 of a whole text's probability, word by word and branch by branch, from the definition."""
    spelled = {word: place for place, word in enumerate(vocab.spelled)}
    found = [word.decode() for word in words_of(text)] + [maxent.END]
    places = [spelled.get(word, vocab.size) for word in found]
    total, last, other = 0.0, vocab.size + 1, vocab.size + 1
    for word, place in zip(found, places, strict=True):
        pair = (last * 1_000_003 + other * 8_191 + (last >> 3)) % maxent.PAIR_ROWS
        row = lambda p: p if p < maxent.OWN_ROWS else maxent.OWN_ROWS + (p * 40503 >> 4) % (maxent.WORD_ROWS - maxent.OWN_ROWS)
        line = outer[0].astype(float) + outer[1 + row(last)] + outer[1 + maxent.WORD_ROWS + row(other)]
        line = line + outer[1 + 2 * maxent.WORD_ROWS + pair]
        total += line[vocab.classes[place]] - math.log(sum(math.exp(x) for x in line))
        if place == vocab.size:
            total += math.log((counts.get(word, 0) + 1) / (vocab.other_tokens + vocab.other_words + 1))
        for node_of, branch_of in vocab.levels:
            node = node_of[place]
            if node >= 0:
                rows = maxent.hashed_rows(np.array([last]), np.array([other]), np.array([node]))[0]
                line = vocab.nodes[node].astype(float) + sum(inner[r].astype(float) for r in rows)
                total += line[branch_of[place]] - math.log(sum(math.exp(x) for x in line if x > -math.inf))
        last, other = place, last
    return total / math.log(10)


@pytest.mark.parametrize("size", [60, 1 << 18])
def test_scores_of_whole_texts_word_by_word(make, monkeypatch, size):
    """What the query returns, recomputed slowly with the very weights that were trained."""
    monkeypatch.setattr(maxent, "VOCABULARY", size)
    rows = [(i, words(i % 40, 50) + f" rare{i % 9}", "s") for i in range(150)]  # noqa: F405
    kept, train = {}, maxent.train
    monkeypatch.setattr(maxent, "train", lambda e, v, k: kept.setdefault("made", (v, train(e, v, k)))[1])
    found = {r.doc_id: r.score for r in maxent.score(make(rows)).collect()}
    vocab, (outer, inner) = kept["made"]
    counts = Counter()
    for i, text, _ in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*(word.decode() for word in words_of(text)), maxent.END])
    for i, text, _ in rows[::15]:
        assert found[i] == pytest.approx(slow_score(text, vocab, outer, inner, counts), rel=1e-4)
