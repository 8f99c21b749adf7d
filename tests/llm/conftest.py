import random

import pytest

EXTRA = "score double, place int, fp string, _text string, of int, source_ string, bucket int, key string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"


def words(seed, count):
    """Invented words; a vocabulary small enough that texts share some."""
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(("ta", "re", "mo", "li", "sun")) for _ in range(draw.randint(1, 4))) for _ in range(count))


def document(doc_id, text, source="s1", lang="en"):
    n = None if text is None else len(text)
    return (doc_id, text, lang, source, n, 0.5, 1, "x", "y", 2, "z", 3, "k")


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, odd characters."""
    return [
        document(1, words(1, 40)),
        document(1, words(1, 40)),
        document(2, ""),
        document(3, None),
        document(4, " \t\n "),
        document(5, "word", None, None),
        document(None, words(2, 30)),
        document(None, words(2, 30)),
        document(6, words(3, 20_000), "s2"),
        document(7, words(1, 40), "s2"),
        document(8, "Ünï çödé 漢字  two  spaces\n\nlines ▁ \x01   end. O'neil's 12,5%", "s3"),
        document(9, "x" * 5_000, "s3"),
        document(10, words(4, 12) + " " + words(5, 12), "ü"),
        (None,) * 13,
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text, source) rows."""
    return lambda rows, parts=3: spark.createDataFrame([document(*r) for r in rows], SCHEMA).repartition(parts)
