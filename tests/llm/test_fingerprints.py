"""One-permutation MinHash against definitions and exact likeness."""

import hashlib

import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from kerbside.llm import fingerprints


def shingles(text):
    found = text.split()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} or ({tuple(found)} if found else set())


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def order(rows):
    """By descending id, none last, equal ids by text."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))


@pytest.mark.parametrize("per_bucket", [3, 2000])
def test_against_plain(spark, make, monkeypatch, per_bucket):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", per_bucket)
    rows = [(3 * i, words(i // 2, 200 + i) + (" end" if i % 2 else ""), "s") for i in range(24)]  # noqa: F405
    rows += [(100, "", "s"), (101, "one two", "s"), (102, None, "s")]
    found = {r.doc_id: r for r in fingerprints.fingerprint_edits(make(rows)).collect()}
    ordered = order([(i, t) for i, t, _ in rows])
    assert len(found) == len(rows)
    for nth, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(nth + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = found[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(text, edited)) < 0.2
        assert abs(r.near_next - likeness(text, after)) < 0.2
    assert found[100].fingerprint == found[102].fingerprint == ""


def test_estimates_are_unbiased(spark, make):
    """Over many pairs of every likeness the mean error is near zero, short texts included."""
    rows, exact = [], {}
    for i in range(120):
        base = [f"w{i}x{k}" for k in range(12 + 3 * i)]
        cut = len(base) * (i % 10) // 10
        rows += [(2 * i + 1, " ".join(base), "s"), (2 * i, " ".join(base[cut:] + [f"o{i}x{k}" for k in range(cut)]), "s")]
        exact[2 * i + 1] = likeness(rows[-2][1], rows[-1][1])
    found = fingerprints.fingerprint_edits(make(rows)).filter("doc_id % 2 = 1").select("doc_id", "near_next").collect()
    errors = [r.near_next - exact[r.doc_id] for r in found]
    assert abs(sum(errors) / len(errors)) < 0.02
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.08


def test_equal_texts_have_equal_fingerprints(odd):
    found = fingerprints.fingerprint_edits(odd).collect()
    assert len(found) == odd.count()
    texts = {r.doc_id: r for r in found}
    assert texts[1].fingerprint == texts[7].fingerprint and len(texts[1].fingerprint) == 256
    assert texts[2].fingerprint == texts[3].fingerprint == texts[4].fingerprint == ""


def test_few_rows(empty, make):
    assert fingerprints.fingerprint_edits(empty).collect() == []
    (one,) = fingerprints.fingerprint_edits(make([(1, "a b c d e f g h i", "s")])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"a b c d e fa b c ").hexdigest() or one.n_chars == 17


def test_no_python_in_the_plan(odd, plan):
    text = plan(fingerprints.fingerprint_edits(odd))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_bin_of_probe_is_fixed(spark):
    """An empty bin copies one of the occupied ones, whichever text asks."""
    occupied = F.array(F.lit(5 << 8 | 1), F.lit(77 << 8 | 2)).cast("array<int>")
    codes = spark.range(1).select(fingerprints._densified(occupied, fingerprints._missing(occupied)).alias("c")).first().c
    assert [c >> 8 for c in codes] == list(range(128)) and {c & 255 for c in codes} == {1, 2}
    assert 30 < sum(c & 255 == 1 for c in codes) < 98
