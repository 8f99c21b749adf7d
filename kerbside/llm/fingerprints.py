"""Document fingerprints: one-permutation MinHash with optimal densification, in column expressions only.

The hashes of a text's five-word shingles are computed once. The top seven bits of a hash choose one of 128
bins, and each bin keeps its smallest hash. An empty bin takes the value of an occupied one, chosen by probing
the bins in a random order of its own that is the same for all texts. Of each bin the low eight bits are
stored; likeness subtracts the matches that eight bits give by chance.

Defined results: a null text is empty; a text without words has the empty fingerprint, with likeness 1 to another
such text and 0 to any other; a text of fewer than five words is one shingle; rows without doc_id come last
in the descending order, rows with equal ids in the order of their texts; a single row is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import SPACE, parts_for, quantile_bounds
from kerbside.operators.staging import compute_once

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8  # stored of each bin
LOW = (1 << LOW_BITS) - 1
ROWS_PER_BUCKET = 2000
MOST_BUCKETS = 10_000
STRIDE = 100  # cut points in one step of the two-step search


# Signatures

def _hashes(words: Column) -> Column:
    """The hashes of all shingles in ascending order."""
    n = F.size(words)
    shingles = F.transform(
        F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])
    )
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    none = F.array().cast("array<bigint>")
    return F.sort_array(F.when(n >= SHINGLE, shingles).when(n > 0, short).otherwise(none))


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS)


def _occupied(hashes: Column) -> Column:
    """bin * 256 + low bits of the smallest hash, for each bin that has one."""
    first = F.filter(hashes, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(hashes, i - 1))))
    return F.transform(first, lambda h: (F.shiftleft(_bin(h), LOW_BITS).bitwiseOR(h.bitwiseAND(F.lit(LOW)))).cast("int"))


def _missing(occupied: Column) -> Column:
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    return F.array_except(bins, F.transform(occupied, lambda c: F.shiftright(c, LOW_BITS)))


def _densified(occupied: Column, missing: Column) -> Column:
    """The codes of all bins in order. An empty bin probes the others in the order of their joint hash."""

    def probe(bin_: Column) -> Column:
        order = lambda c: F.xxhash64(bin_, F.shiftright(c, LOW_BITS)).bitwiseAND(F.lit(~LOW))
        found = F.array_min(F.transform(occupied, lambda c: order(c).bitwiseOR(c.bitwiseAND(F.lit(LOW)).cast("bigint"))))
        return F.shiftleft(bin_, LOW_BITS).bitwiseOR(found.bitwiseAND(F.lit(LOW)).cast("int"))

    filled = F.when(F.size(occupied) == 0, F.array().cast("array<int>")).otherwise(F.transform(missing, probe))
    return F.sort_array(F.concat(occupied, filled))


def with_codes(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Adds for each name the codes (bin * 256 + low bits, one a bin) of a text column.

    Each step's arrays are computed once a row and read by the next step.
    """
    blank = F.lit(SPACE)

    def words(text: str) -> Column:
        trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), blank)
        return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))

    kept = [c for c in df.columns if c not in texts.values()]
    steps = (
        ("words", lambda name: words(texts[name])),
        ("hashes", lambda name: _hashes(F.col(f"{name}_words"))),
        ("occupied", lambda name: _occupied(F.col(f"{name}_hashes"))),
        ("missing", lambda name: _missing(F.col(f"{name}_occupied"))),
    )
    needed: list[str] = []
    for step, column in steps:
        df = compute_once(df, {f"{name}_{step}": column(name) for name in texts})
        needed = [f"{name}_{step}" for name in texts]
        if step == "missing":
            needed += [f"{name}_occupied" for name in texts]
        df = df.select(*kept, *needed)
    codes = {name: _densified(F.col(f"{name}_occupied"), F.col(f"{name}_missing")) for name in texts}
    return compute_once(df, codes).select(*kept, *texts)


def packed(codes: Column) -> Column:
    """The fingerprint: two hexadecimal digits a bin."""
    digits = F.array(*[F.lit(f"{value:02x}") for value in range(LOW + 1)])
    return F.array_join(F.transform(codes, lambda c: F.get(digits, c.bitwiseAND(F.lit(LOW)))), "")


def likeness(left: Column, right: Column) -> Column:
    """Estimated share of common shingles: matching bins, less those that match by chance."""
    chance = 1.0 / (LOW + 1)
    matches = F.size(F.array_intersect(left, right)) / F.lit(float(BINS))
    estimate = F.greatest(F.lit(0.0), (matches - chance) / (1 - chance))
    both_empty = (F.size(left) == 0) & (F.size(right) == 0)
    return F.when(both_empty, F.lit(1.0)).when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0)).otherwise(estimate)


# The next document

def _bucket(bounds: list[int]) -> Column:
    """How many cut points lie below the id; -1 without an id. Two short searches, as the list is sorted."""
    if not bounds:
        return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.lit(0))
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.array(*[F.lit(b) for b in bounds[STRIDE - 1 :: STRIDE]]).cast("array<bigint>")
    steps = F.size(F.filter(coarse, lambda b: b < F.col("doc_id"))) * STRIDE
    near = F.size(F.filter(F.slice(every, steps + 1, STRIDE), lambda b: b < F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(steps + near)


def with_next(documents: DataFrame) -> DataFrame:
    """bucket, place, ghost, doc_id, text and next_text, where next is by descending doc_id, round the end.

    The rows are dealt into buckets of neighbouring ids, and each bucket gets a copy (``ghost``) of the
    row that follows its last one, so one shuffle by bucket is all that texts go through.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count = rows.count()
    bounds = quantile_bounds(rows, "doc_id", parts_for(count, ROWS_PER_BUCKET, MOST_BUCKETS))
    rows = rows.withColumn("bucket", _bucket(bounds))
    # One row a bucket, MOST_BUCKETS + 1 at most: the size of the broadcast is bounded.
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    upward = Window.orderBy("bucket")
    last = F.min("bucket").over(Window.partitionBy())
    tops = tops.select(F.col("bucket").alias("of"), "top", F.coalesce(F.lead("bucket").over(upward), last).alias("above"))
    head = F.row_number().over(Window.partitionBy("bucket").orderBy("text"))
    same = (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top"))
    ghosts = (
        rows.join(F.broadcast(tops), same)
        .select("bucket", "doc_id", "text", "above")
        .withColumn("nth", head)
        .filter("nth = 1")
        .select("doc_id", "text", F.col("above").alias("bucket"), F.lit(True).alias("ghost"))
    )
    both = rows.select("doc_id", "text", "bucket", F.lit(False).alias("ghost")).unionByName(ghosts)
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "text")
    return both.select(
        "bucket",
        F.row_number().over(order).alias("place"),
        "ghost",
        "doc_id",
        "text",
        F.lead("text", 1, "").over(order).alias("next_text"),
    )


def edited(text: Column, next_text: Column) -> Column:
    """The last third of the code points replaced by the first as many of the next text."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(next_text, F.lit(1), third))


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(documents)
    rows = compute_once(rows, {"edited": edited(F.col("text"), F.col("next_text"))})
    rows = rows.select(
        "bucket", "place", "ghost", "doc_id", "text", "edited",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
    )
    coded = with_codes(rows, {"codes": "text", "edited_codes": "edited"})
    coded = coded.withColumn("next_codes", F.lead("codes").over(Window.partitionBy("bucket").orderBy("place")))
    return coded.filter(~F.col("ghost")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        packed(F.col("codes")).alias("fingerprint"),
        packed(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
