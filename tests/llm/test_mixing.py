"""Mixing against a plain computation, on odd rows and a hot source."""

import hashlib
import re
from collections import defaultdict

import pytest
from conftest import *  # noqa: F403

from kerbside.llm import mixing


def place(doc_id):
    text = "-" if doc_id is None else str(doc_id)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain_mix(rows):
    """{(doc_id, source): copies} and {source: (size, target)}."""
    docs = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    size = defaultdict(int)
    for _, s, n in docs:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, stopped = sum(size.values()), set()
    while True:
        open_ = [s for s in order if s not in stopped]
        if not open_:
            break
        level = (1.5 * total - sum(2 * size[s] for s in stopped)) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not over:
            break
        stopped |= over
    target = {s: 2.0 * size[s] if s in stopped else level * weight[s] for s in order}
    copies = {}
    for s in order:
        base = int(target[s] // size[s]) if size[s] else 0
        rest = target[s] - base * size[s]
        groups = defaultdict(int)
        for i, own, n in docs:
            if own == s:
                groups[place(i)] += n
        bound, before = 2**60 if rest > 0 else 0, 0
        for p in sorted(groups):
            if rest > 0 and before + groups[p] > rest:
                bound = p + (before + groups[p] - rest < rest - before)
                break
            before += groups[p]
        for i, own, _ in docs:
            if own == s:
                copies[i, s] = min(base + (place(i) < bound), 2)
    return copies, {s: (size[s], target[s]) for s in order}


ROWS = [(i, words(i, 5 + i % 17), ("hot", "b", "c", "ü", None)[0 if i % 3 == 0 else i % 5]) for i in range(90)]  # noqa: F405


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], [(1, "", "a"), (2, None, "b")], [(i, "a b", "s") for i in range(5)]])
def test_against_plain(make, rows):
    copies, sources = plain_mix(rows)
    found = mixing.mix(make(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["copies"] == copies[r["doc_id"], r["source"]]
        assert (r["source_size"], r["target"]) == sources[r["source"]]


def test_documents_are_repeated(make):
    copies, _ = plain_mix(ROWS)
    docs = make(ROWS)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r["doc_id"], r["source"]] += 1
    assert taken == {k: n for k, n in copies.items() if n}


def test_odd_rows(odd, empty):
    found = mixing.mix(odd).collect()
    assert len(found) == odd.count()
    assert {r["size"] for r in found if r["doc_id"] in (2, 3, 4)} == {0}
    assert all(0 <= r["copies"] <= 2 for r in found)
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
