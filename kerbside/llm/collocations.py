"""Phrase collocations by prefix-free parsing.

Texts are split into pieces at punctuation, pieces into words. A piece is parsed into chunks: wherever the hash of a window of
two words (one less than the longest phrase) is divisible by ``TRIGGER``, a chunk ends behind the window and the next one begins with
it. The cuts follow from the words alone, so passages that repeat give the same chunks wherever they stand, and the
corpus becomes a dictionary of distinct chunks with their frequencies. Each phrase that begins before the closing
window lies wholly in the chunk, and one that begins in it belongs to the next chunk, so overlaps are assigned once. All counts
are then sums over distinct chunks, weighted by frequency:

1. words and pairs by a 64-bit hash, summed by Spark; those with fewer than the asked occurrences are out (hashes that
   collide only let more through);
2. the hashes that stay are marked in a bit table of bounded size, sent to all tasks;
3. marked words, marked pairs and longer phrases all of whose pairs are marked are counted as text, exactly.

Only distinct chunks, hashes and phrases that may matter are shuffled, each summed in the task first. Once many more
phrases are frequent than the bit table has room for it lets more through; results stay exact.

Defined results: a null text has no words; a null language counts as ``und``; A-Z are lower-cased, nothing else;
repeated rows count as often as they stand there; ties go by the phrase in byte order; a text that is one long
piece is cut like any other, and a piece without cuts is one chunk. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import LOWER, flat_ranges, ready, staged

# What ends a piece, and what separates words inside one.
ENDS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"

TRIGGER = 12  # one window in so many ends a chunk
LONGEST = 3
LEAST = 10  # occurrences of a candidate
WITHIN = 50  # percent of a phrase's occurrences that a longer one may not reach
BEST = 2000  # of a language
SLAB = 4_000_000  # bytes worked on at once; a longer text by itself
MOST_BITS = 26  # the bit table has 2^26 bits (8 MB) at most
BITS_A_KEY = 16

BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
KIND = np.full(256, 0, dtype=np.int8)
KIND[list(GAPS)] = 1
KIND[list(ENDS)] = 2
FOLD = np.frombuffer(LOWER, dtype=np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * SPREAD
    h = (h ^ (h >> np.uint64(29))) * SPREAD
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes, all at once: differences of running sums of bytes times powers of an odd number, which
    has an inverse, so a stretch has the same hash wherever it stands."""
    powers = np.full(len(data) + 1, BASE)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    inverse = np.full(len(data) + 1, np.uint64(pow(int(BASE), -1, 2**64)))
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def joined(hashes: np.ndarray, count: int) -> np.ndarray:
    """Hashes of each word with the ``count`` - 1 after it; the last ones, which lack some, are left out."""
    size = len(hashes) - count + 1
    out = hashes[: max(size, 0)]
    for nth in range(1, count):
        out = mixed(out * BASE + hashes[nth : nth + size])
    return out


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Stretches of bytes, which may overlap, as an Arrow array."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    values = data[flat_ranges(starts, sizes)]
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def slabs(batches: Iterator[pa.RecordBatch], most: int = SLAB) -> Iterator[pa.RecordBatch]:
    """The rows again in batches of about ``most`` bytes of the first column, or one longer row."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column(0)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for nth, bytes_ in enumerate(sizes.tolist()):
            if size + bytes_ > most and size:
                held.append(batch.slice(begin, nth - begin))
                yield _one(held)
                held, size, begin = [], 0, nth
            size += bytes_
        held.append(batch.slice(begin))
    if held:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.concat_batches([b for b in batches if b.num_rows] or batches[:1])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, with the end of the last one."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def lang_column() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("und"))


def chunk_texts(documents: DataFrame, longest: int = LONGEST, trigger: int = TRIGGER) -> DataFrame:
    """The parse: (chunk, lang, is_last, n, begins). A chunk's words are joined by single spaces; ``is_last`` tells that its
    piece ends with it, so that all its words begin phrases, not only those before the closing window; ``begins`` counts them."""
    ready(documents.sparkSession)
    window = longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches):
            data, offsets = raw(slab.column(0))
            # A line break behind each text: an end of a piece, and of the words on both sides.
            spread = np.full(len(data) + len(slab), 10, dtype=np.uint8)
            spread[np.arange(len(data)) + np.repeat(np.arange(len(slab)), np.diff(offsets))] = FOLD[data]
            kind = KIND[spread]
            inside = np.concatenate(([False], kind == 0, [False]))
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            starts, ends = edges[::2], edges[1::2]
            if not len(starts):
                continue
            rows = np.searchsorted(offsets + np.arange(len(offsets)), starts, side="right") - 1
            # A word opens a piece if an end of one lies before it and behind the word before.
            broken = np.cumsum(kind == 2)
            opens = np.concatenate(([True], broken[starts[1:]] != broken[ends[:-1] - 1]))
            closes = np.concatenate((opens[1:], [True]))
            piece = np.cumsum(opens) - 1
            first_of = np.flatnonzero(opens)[piece]
            last_of = np.flatnonzero(closes)[piece]
            at = np.arange(len(starts))
            hashes = joined(word_hashes(spread, starts, ends), window)
            hashes = np.concatenate((hashes, np.zeros(len(starts) - len(hashes), dtype=np.uint64)))
            triggers = (hashes % np.uint64(trigger) == 0) & (at > first_of) & (at + window - 1 <= last_of)
            begins = np.flatnonzero(opens | triggers)
            # A chunk goes to the end of the next window, or to the end of its piece.
            after = np.concatenate((begins[1:], [len(starts)]))
            is_last = after > last_of[begins]
            final = np.where(is_last, last_of[begins], after + window - 1)
            # Words behind each other with one space between them.
            sizes = ends - starts + 1
            places = np.cumsum(sizes) - sizes
            packed = np.full(int(sizes.sum()), 32, dtype=np.uint8)
            packed[flat_ranges(places, sizes - 1)] = spread[flat_ranges(starts, sizes - 1)]
            found = gathered(packed, places[begins], places[final] + sizes[final] - 1, pa.string())
            langs = slab.column(1).take(pa.array(rows[begins]))
            counted = pa.array((np.where(is_last, final + 1, after) - begins).astype(np.int32))
            names = ["chunk", "lang", "is_last", "begins"]
            yield pa.RecordBatch.from_arrays([found, langs, pa.array(is_last), counted], names=names)

    schema = "chunk string, lang string, is_last boolean, begins int"
    parsed = documents.select("text", lang_column().alias("lang")).mapInArrow(run, schema)
    return parsed.groupBy("chunk", "lang", "is_last").agg(F.count("*").alias("n"), F.max("begins").alias("begins"))


@dataclass
class Chunks:
    """The words of a batch of distinct chunks, and what each of them counts for."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    last: np.ndarray  # of each word: the last word of its chunk
    weights: np.ndarray  # how often the word counts as the beginning of a phrase
    langs: pa.Array
    row: np.ndarray
    hashes: np.ndarray

    @staticmethod
    def read(batch: pa.RecordBatch, longest: int) -> Chunks:
        data, offsets = raw(batch.column(0))
        spaces = data == 32
        # A chunk begins and ends with a word, and single spaces stand between words.
        cuts = np.flatnonzero(spaces)
        starts = np.sort(np.concatenate((offsets[:-1], cuts + 1)))
        ends = np.sort(np.concatenate((cuts, offsets[1:])))
        row = np.searchsorted(offsets, starts, side="right") - 1
        last = np.searchsorted(row, np.arange(len(batch)), side="right")[row] - 1
        at = np.arange(len(starts))
        whole = np.asarray(batch.column(2)).astype(bool)[row]
        weights = np.where(whole | (at <= last - (longest - 1)), np.asarray(batch.column(3))[row], 0)
        coded = batch.column(1).dictionary_encode()
        own = np.array([_text_hash(text) for text in coded.dictionary.to_pylist()], dtype=np.uint64)
        # The language is part of the word, and so of all phrases.
        hashes = mixed(word_hashes(data, starts, ends) + own[np.asarray(coded.indices)][row])
        return Chunks(data, starts, ends, last, weights, batch.column(1), row, hashes)

    def begins(self, count: int) -> np.ndarray:
        """The words that begin a phrase of ``count`` words."""
        return np.flatnonzero((self.weights > 0) & (np.arange(len(self.starts)) + count - 1 <= self.last))


def _text_hash(text: str) -> int:
    own = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return int(word_hashes(own, np.array([0]), np.array([len(own)]))[0])


def hash_counts(chunks: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(h, n): occurrences of words and of pairs by hash. Phrases of different text may share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            own = Chunks.read(batch, longest)
            at = own.begins(2)
            words = np.flatnonzero(own.weights > 0)
            all_hashes = np.concatenate((own.hashes[words], joined(own.hashes, 2)[at]))
            weights = np.concatenate((own.weights[words], own.weights[at]))
            hashes, place = np.unique(all_hashes, return_inverse=True)
            sums = np.zeros(len(hashes), dtype=np.int64)
            np.add.at(sums, place, weights)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(sums)], names=["h", "n"])

    return chunks.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def bit_table(hashes: DataFrame) -> np.ndarray:
    """The hashes marked in a table of 2^k bits, 16 for each up to 2^26 in all. Spark puts the words of the table together;
    at most 2^20 of them reach the driver."""
    keys = hashes.count()
    bits = int(min(MOST_BITS, max(10, np.ceil(np.log2(max(1, keys) * BITS_A_KEY)))))
    place = F.shiftrightunsigned(F.col("h"), 64 - bits)
    word = F.shiftright(place, 6).alias("word")
    mark = F.expr("shiftleft(1L, cast(place & 63 as int))").alias("mark")
    marks = hashes.select(place.alias("place")).select(F.shiftright("place", 6).alias("word"), mark)
    found = marks.groupBy("word").agg(F.bit_or("mark").alias("mark")).toArrow()
    table = np.zeros(2 ** (bits - 6), dtype=np.int64)
    table[np.asarray(found["word"])] = np.asarray(found["mark"])
    return table


def marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(table).bit_length() - 1 + 6
    place = hashes >> np.uint64(64 - bits)
    word = table[(place >> np.uint64(6)).astype(np.int64)].view(np.uint64)
    return (word >> (place & np.uint64(63))) & np.uint64(1) == 1


def phrase_counts(chunks: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, words, f): exact occurrences of all words and phrases of up to ``longest`` words that occur at
    least ``least`` times."""
    spark = chunks.sparkSession
    frequent = staged(hash_counts(chunks, longest).filter(F.col("n") >= least).select("h"), "frequent")
    sent = spark.sparkContext.broadcast(bit_table(frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in slabs(batches):
            own = Chunks.read(batch, longest)
            parts = []
            good = marked(table, own.hashes)
            pairs = np.concatenate((marked(table, joined(own.hashes, 2)), [False]))
            run_of_pairs = np.ones(len(good), dtype=bool)
            for words in range(1, longest + 1):
                at = own.begins(words)
                if words > 1:  # the pair that begins with the word before last
                    run_of_pairs = run_of_pairs & np.concatenate((pairs[words - 2 :], np.zeros(words - 2, dtype=bool)))
                at = at[(good if words == 1 else run_of_pairs)[at]]
                if not len(at):
                    continue
                phrases = gathered(own.data, own.starts[at], own.ends[at + words - 1], pa.string())
                rows = pa.table(
                    {"lang": own.langs.take(pa.array(own.row[at])), "phrase": phrases, "f": pa.array(own.weights[at])}
                )
                summed = rows.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
                parts.append(summed.append_column("words", pa.array(np.full(len(summed), words, dtype=np.int32))))
            for part in parts:
                yield from part.select(["lang", "phrase", "words", "f_sum"]).rename_columns(
                    ["lang", "phrase", "words", "f"]
                ).to_batches()

    counted = chunks.mapInArrow(run, "lang string, phrase string, words int, f bigint")
    summed = counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return summed.filter(F.col("f") >= least)


def word_totals(chunks: DataFrame) -> DataFrame:
    """(lang, n): all words of each language, each counted where it begins a phrase."""
    return chunks.groupBy("lang").agg(F.sum(F.col("begins") * F.col("n")).alias("n"))


def collocations(
    documents: DataFrame,
    least: int = LEAST,
    within: int = WITHIN,
    best: int = BEST,
    longest: int = LONGEST,
    trigger: int = TRIGGER,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two to ``longest`` words of each language.

    a counts the phrase, l and r the two parts of its weakest cut, n all words; the score is
    floor(1000000 a a / (l r)). Decimals of 38 digits hold all products while counts stay below 10^15.
    """
    chunks = staged(chunk_texts(documents, longest, trigger), "chunks")
    counts = staged(phrase_counts(chunks, least, longest), "phrases")
    candidates = counts.filter("words > 1").withColumnRenamed("f", "a")
    # Each candidate once for every part of every cut; parts occur at least as often as the whole, so all are counted.
    split = candidates.withColumn("word", F.split("phrase", " ")).withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    sides = split.select(
        "lang",
        "phrase",
        "words",
        "a",
        "k",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("left"), F.array_join(F.slice("word", F.lit(1), F.col("k")), " ").alias("part")),
                F.struct(
                    F.lit(False).alias("left"),
                    F.array_join(F.slice("word", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("part"),
                ),
            )
        ).alias("side"),
    ).select("lang", "phrase", "words", "a", "k", "side.*")
    known = counts.select("lang", F.col("phrase").alias("part"), "f")
    found = sides.join(known, ["lang", "part"])
    cuts = found.groupBy("lang", "phrase", "words", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r")
    )
    a, product = F.col("a").cast("decimal(19,0)"), F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    scored = cuts.withColumn("wide", (a * a).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("product", product)
    scored = scored.withColumn("score", F.expr("wide div product"))
    weakest = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # What a longer phrase covers: each of its inner phrases with its own count.
    inner = candidates.filter("words > 2").select(
        "lang",
        F.col("a").alias("f"),
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1),"
                " at -> array_join(slice(split(phrase, ' '), at, n), ' '))))"
            )
        ).alias("phrase"),
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = weakest.join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    totals = word_totals(chunks)  # a row a language
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("bigint").alias("rank"),
        "phrase",
        "a",
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").cast("bigint").alias("score"),
    )
