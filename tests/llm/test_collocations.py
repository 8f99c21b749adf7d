import random
import re
from collections import Counter

import numpy as np
import pytest

from kerbside.llm import collocations, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_counts(rows, longest=3):
    """Occurrences of (lang, words) and words of each language, straight from the definition."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    counts[lang, tuple(words[at : at + size])] += 1
    return counts, totals


def slow_collocations(rows, least=10, within=50, best=2000, longest=3):
    counts, totals = slow_counts(rows, longest)
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    covered = {
        (lang, words[at : at + size])
        for (lang, words), f in candidates.items()
        for size in range(2, len(words))
        for at in range(len(words) - size + 1)
        if 100 * f >= within * counts[lang, words[at : at + size]]
    }
    lists = {}
    for (lang, words), a in candidates.items():
        if (lang, words) in covered:
            continue
        cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        parts = counts[lang, words[:k]], counts[lang, words[k:]]
        lists.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), *parts))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, found in lists.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:best], 1)
    )


def found(documents, **settings):
    rows = collocations.collocations(documents, **settings).collect()
    return sorted(tuple(row[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for row in rows)


SCHEMA = "doc_id bigint, text string, lang string, phrase string, n int, word string, is_last string, chunk int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(n, text, lang, "x", 1, "y", "z", 2) for n, (lang, text) in enumerate(rows)], SCHEMA).repartition(parts)


def draw_text(draw, words):
    marks = [" "] * 9 + ["  ", "\t", ". ", ", ", "\n", "; ", "!", "\r\n"]
    vocabulary = ["the", "The", "a", "ta", "mo", "run", "é", "漢", "Éa", "new york", "x\x00y", "a b"]
    return "".join(draw.choice(vocabulary[: draw.randint(2, 12)]) + draw.choice(marks) for _ in range(words))


def draw_rows(seed):
    draw = random.Random(seed)
    passage = draw_text(draw, 60)
    rows = [(draw.choice(("en", "de", None, "")), draw_text(draw, draw.randint(0, 200))) for _ in range(60)]
    rows += [(lang, f"{draw_text(draw, 3)} {passage}") for lang, _ in rows[:40]]
    return rows + [("en", None), ("en", ""), (None, " \t\n..")] + rows[:5]


@pytest.mark.parametrize("trigger", [1, 2, 5, 10**9])
def test_equal_to_brute_force_however_chunks_are_cut(spark, trigger):
    rows = draw_rows(trigger)
    assert found(frame(spark, rows), trigger=trigger) == slow_collocations(rows)


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths_and_limits(spark, longest):
    rows = draw_rows(longest)
    settings = {"least": 4, "within": 80, "best": 15, "longest": longest}
    assert found(frame(spark, rows), **settings) == slow_collocations(rows, **settings)


def test_a_full_bit_table_only_lets_more_through(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_BITS", 10)
    rows = draw_rows(77)
    assert found(frame(spark, rows)) == slow_collocations(rows)


def test_small_slabs_and_long_runs(spark, monkeypatch):
    """Long texts of one word, of one piece and without cuts; texts cut over several slabs."""
    rows = draw_rows(5) + [("en", "la " * 20_000), ("en", "x" * 50_000), ("de", "ab cd " * 3000 + "."), ("de", "-,-" * 500)]
    assert found(frame(spark, rows)) == slow_collocations(rows)
    monkeypatch.setattr(collocations, "SLAB", 50)
    assert found(frame(spark, rows[:20])) == slow_collocations(rows[:20])


def test_repeated_passages_share_chunks(spark):
    """Chunks are cut by content, so a passage gives the same ones wherever it stands."""
    draw = random.Random(1)
    passage = " ".join(f"w{draw.randint(0, 5000)}" for _ in range(400))
    rows = [("en", f"{'pre ' * n}{passage} post{n}") for n in range(50)]
    parsed = collocations.chunk_texts(frame(spark, rows))
    total, distinct = parsed.selectExpr("sum(n)", "count(*)").first()
    assert distinct < total / 10
    words = collocations.word_totals(parsed).first()["n"]
    assert words == sum(len(text.split()) for _, text in rows)


def test_exact_beyond_64_bits(spark):
    """Products of counts as a corpus of 100 TB would have them."""
    a, l, r = 3 * 10**13, 4 * 10**13, 5 * 10**13 + 7
    row = spark.createDataFrame([(a, l, r)], "a bigint, l bigint, r bigint").selectExpr(
        "cast(a as decimal(19,0)) * cast(a as decimal(19,0)) as s", "cast(l as decimal(19,0)) * cast(r as decimal(19,0)) as p"
    ).selectExpr("(cast(s as decimal(31,0)) * cast(1000000 as decimal(7,0))) div p as score").first()
    assert row["score"] == 10**6 * a * a // (l * r)


def test_hashes_do_not_depend_on_the_place():
    data = np.frombuffer(b"abc xabc abc", dtype=np.uint8)
    hashes = collocations.word_hashes(data, np.array([0, 5, 9, 4]), np.array([3, 8, 12, 8]))
    assert hashes[0] == hashes[1] == hashes[2] != hashes[3]


def test_odd_and_empty(odd, empty):
    rows = [(row["lang"], row["text"]) for row in odd.collect()]
    assert found(odd, least=2) == slow_collocations(rows, least=2)
    assert found(empty) == []


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r[c] for c in columns) for r in queries.op13_collocations(spark, sf).collect()) == slow_collocations(rows)
