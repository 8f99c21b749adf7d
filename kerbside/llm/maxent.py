"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The class is scored by log-linear features of the history,
hashed to rows of one weight table: the word before, the pair before, and the word before the last (skipping
one). The word is then chosen inside its class by the same features, in a second table: members are the leaves of
a Huffman tree with up to ``FAN`` branches a node, so that frequent words take few choices, and every node has its own
softmax over its branches, log(share of the node's tokens) + features of history and node. A class of up to ``FAN`` words
is one softmax over its members; the product over a larger class's tree adds up to one over all members too. The most
frequent words have places of their own in the vocabulary that all tasks hold; all other words, unseen ones
included, share a class, in which a word of count c has (c + 1) / (tokens + words + 1) of the class.

Counts cover all training tokens. Training makes one pass over all training tokens in rounds: in a round every
task starts from the same weights and follows its own gradient in small batches; the new weights are averaged
row by row, weighted by how often a task met the row. The sizes of batches and of tasks do not depend on the corpus.

Defined results: a null or blank text consists of the end token alone; rows without doc_id are in the training
fold of an empty id; repeated rows count and are scored one by one; if there is no training token, counts
are 0 and the model is uniform.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import fold, ready, staged

FOLDS, HELD_OUT = 7, 2
VOCABULARY = 1 << 18  # words with places of their own, in every task's memory
LONGEST = 64  # bytes of such a word
OWN_CLASS = 20  # most frequent words that are classes of their own
OWN_ENDINGS = 16  # most frequent word endings that are classes
CLASSES = 64
# All numbers of rows that hashes are cut to are powers of two: a mask is cheaper than a remainder.
WORD_ROWS, OWN_ROWS = 4096, 3072  # of the table, for a single word; the most frequent ones have their own row
PAIR_ROWS = 8192
ROWS = 1 + 2 * WORD_ROWS + PAIR_ROWS
FAN = 16  # branches of a node inside a class: more levels than with 64, but far fewer numbers a token and a row
INNER_FEATURE = 1 << 14  # rows of the table inside the classes, for each of the three features
INNER_ROWS = 3 * INNER_FEATURE
INNER_SQUARES = 1.0  # a first step there is small: most of these rows are met seldom
ROUNDS = 2
BATCH = 4096  # tokens of one gradient step; a task's first ones are smaller, see batch_sizes
FIRST_BATCH, STEPS_A_SIZE = 256, 500
TASK_TOKENS = 4_000_000  # that a training task goes through at least, as each sends its weights once
RATE = 0.1
LEAST_TOTAL = 1e-30  # of a softmax in single precision, whose numbers end near 1e-38 and 1e38
LARGE = 16  # tokens of a step that share a row, from which on they are summed by themselves
END = " "  # the end token; no word holds a space
FLUSH = 1_000_000  # words that a task gathers before it counts them


def token_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of a column of texts, A-Z lower-cased, in one array, and how many each text has."""
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lists = pc.ascii_split_whitespace(plain)
    lengths = np.asarray(lists.value_lengths()).astype(np.int64)
    blank = np.asarray(pc.equal(plain, "")).astype(bool)  # is split into one empty word
    if not blank.any():
        return lists.values, lengths
    kept = ~np.repeat(blank, lengths)
    return lists.values.filter(pa.array(kept)), np.where(blank, 0, lengths)


# Counts

def count_words(training: DataFrame) -> DataFrame:
    """word and n of all training tokens, the end token included."""
    ready(training.sparkSession)

    def rows(lists: list[pa.Array], texts: int) -> pa.RecordBatch:
        counts = pa.concat_arrays([*lists, pa.array([], pa.string())]).value_counts()
        words = pa.concat_arrays([counts.field(0), pa.array([END])])
        return pa.RecordBatch.from_arrays([words, pa.concat_arrays([counts.field(1), pa.array([texts])])], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, texts = [], 0
        for batch in batches:
            lists.append(token_lists(batch.column(0))[0])
            texts += batch.num_rows
            if sum(map(len, lists)) > FLUSH:
                yield rows(lists, texts)
                lists, texts = [], 0
        if texts:
            yield rows(lists, texts)

    parts = training.select("text").mapInArrow(run, "word string, n bigint")
    return staged(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


class Vocabulary:
    """Places of the frequent words by falling count, their classes, and the shares inside the classes.

    Place ``size`` stands for every other word, place ``size + 1`` for what is before a text.
    """

    def __init__(self, words: list[str], counts: list[int], tokens: int, distinct: int):
        self.spelled, self.size, self.tokens, self.distinct = words, len(words), tokens, distinct
        self.counts = np.array(counts, dtype=np.int64)
        self.end = words.index(END)
        self.classes = np.zeros(self.size + 1, dtype=np.int64)
        # The endings that most tokens have are classes of their own, the others share some by their hash.
        endings = [word.strip(".,!?;:|#$%&*")[-2:] for word in words]
        tokens_of: Counter = Counter()
        for ending, n in zip(endings[OWN_CLASS:], counts[OWN_CLASS:], strict=True):
            tokens_of[ending] += n
        shared = CLASSES - OWN_CLASS - OWN_ENDINGS - 2
        own = {ending: OWN_CLASS + nth for nth, (ending, _) in enumerate(tokens_of.most_common(OWN_ENDINGS))}
        for place, ending in enumerate(endings):
            other = CLASSES - 2 - shared + zlib.crc32(ending.encode()) % shared
            self.classes[place] = place if place < OWN_CLASS else own.get(ending, other)
        self.classes[self.end], self.classes[self.size] = CLASSES - 2, CLASSES - 1
        inside = np.bincount(self.classes[:-1], weights=self.counts, minlength=CLASSES)
        self.other_tokens = tokens - int(self.counts.sum())
        self.other_words = max(0, distinct - self.size)
        self.class_tokens = inside.copy()
        self.class_tokens[-1] = self.other_tokens
        # log10 of a word's share of its class; the words without a place are added where their counts are known.
        # The end token alone may have no count, if there are no training texts; it is then all of its class.
        self.shares = np.append(np.log10(np.maximum(self.counts, 1) / np.maximum(inside[self.classes[:-1]], 1)), 0.0)
        self.known = np.append(self.counts > 0, False)
        self.base = np.append(np.log10((self.counts + 1) / (tokens + distinct + 1)), 0.0)
        self._grow()

    def _grow(self) -> None:
        """The trees of the classes: on each level a word's node (-1: none) and branch, and each node's log shares.

        The first level is next to the words; a word in a class of its own, or without a place, has no node. Ties go by
        place, words before nodes, so the same counts give the same trees.
        """
        members = np.split(*self._by_class())
        known = np.maximum(self.counts, 1).tolist()
        parent, branch = np.full(2 * self.size + 1, -1, dtype=np.int32), np.zeros(2 * self.size + 1, dtype=np.int32)
        sums = []
        for places in members:
            heap = [(known[place], place) for place in places.tolist()]
            heapq.heapify(heap)
            width = (len(heap) - 2) % (FAN - 1) + 2  # of the first node, so that all others are full
            while len(heap) > 1:
                below = [heapq.heappop(heap) for _ in range(width)]
                for nth, (_, child) in enumerate(below):
                    parent[child], branch[child] = len(sums), nth
                sums.append([n for n, _ in below] + [0] * (FAN - width))
                heapq.heappush(heap, (sum(sums[-1]), self.size + 1 + len(sums) - 1))
                width = FAN
        table = np.array(sums, dtype=np.float64).reshape(-1, FAN)
        with np.errstate(divide="ignore"):
            self.nodes = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
        self.levels, at = [], np.arange(self.size + 1)
        while (parent[at] >= 0).any():
            self.levels.append((parent[at], branch[at]))
            at = np.where(parent[at] >= 0, self.size + 1 + parent[at], self.size)  # what has no parent: like no word

    def _by_class(self) -> tuple[np.ndarray, np.ndarray]:
        """All places by class, and where the classes after the first begin."""
        own = self.classes[:-1]
        return np.argsort(own, kind="stable"), np.cumsum(np.bincount(own, minlength=CLASSES))[:-1]

    def choices(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of tokens: which of them have a choice inside their class (as often as they are deep), node, branch."""
        made, at = [(np.zeros(0, dtype=np.int64),) * 3], np.arange(len(flat))
        for node, branch in self.levels:
            at = at[node[flat[at]] >= 0]  # a word without a node has none further up
            made.append((at, node[flat[at]], branch[flat[at]]))
        return tuple(np.concatenate(x) for x in zip(*made, strict=True))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The ``VOCABULARY`` most frequent words: a bounded list, whatever the corpus."""
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    short = counts.filter((F.octet_length("word") <= LONGEST) & (F.col("word") != END))
    best = short.orderBy(F.desc("n"), "word").limit(VOCABULARY - 1).toArrow()
    end = counts.filter(F.col("word") == END).first()
    words, numbers = best["word"].to_pylist(), best["n"].to_pylist()
    return Vocabulary([*words, END], [*numbers, end["n"] if end else 0], tokens, distinct)


# Encoded texts

def packed(offsets: np.ndarray, places: np.ndarray) -> pa.Array:
    """Lists of places as binary values of four bytes a place, little-endian, which Spark stores and hands on as they are."""
    bounds = pa.py_buffer((4 * offsets).astype(np.int64))
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, bounds, pa.py_buffer(places.astype("<i4"))])
    return values.cast(pa.binary())


def unpacked(values: pa.Array) -> pa.Array:
    """The lists of places that ``packed`` made."""
    joined = np.frombuffer(b"".join(values.to_pylist()), dtype="<i4")
    lengths = np.asarray(pc.binary_length(values)).astype(np.int64) // 4
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(joined))


def encode(documents: DataFrame, known) -> DataFrame:
    """key (unique), doc_id, held_out, places of the tokens (with the end, packed), others (words without a place)."""
    ready(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = known.value
        listed = pa.array(vocab.spelled, pa.string())
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            words, lengths = token_lists(batch.column(0))
            coded = words.dictionary_encode()
            at = pc.fill_null(pc.index_in(coded.dictionary, value_set=listed), vocab.size)
            at = np.asarray(at).astype(np.int32)[np.asarray(coded.indices)]
            rare = np.flatnonzero(at == vocab.size)
            ends = np.cumsum(lengths)
            # Offsets of the lists: of the places, with one end token more a text, and of the words without a place.
            offsets = np.append(0, ends + np.arange(1, len(ends) + 1))
            places = packed(offsets, np.insert(at, ends, np.int32(vocab.end)))
            bounds = pa.array(np.searchsorted(rare, np.append(0, ends)).astype(np.int32))
            others = pa.ListArray.from_arrays(bounds, words.take(pa.array(rare)))
            keys = pa.array(np.arange(key, key + batch.num_rows), pa.int64())
            key += batch.num_rows
            made = [keys, *batch.columns[1:], places, others]
            yield pa.RecordBatch.from_arrays(made, names=["key", "doc_id", "held_out", "places", "others"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    chosen = documents.select("text", "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    schema = f"key bigint, doc_id {kind}, held_out boolean, places binary, others array<string>"
    return staged(chosen.mapInArrow(run, schema), "encoded")


# Model

def word_rows(places: np.ndarray) -> np.ndarray:
    return np.where(places < OWN_ROWS, places, OWN_ROWS + (places * 40503 >> 4 & WORD_ROWS - OWN_ROWS - 1))


def histories(lists: pa.Array, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all tokens of a column, and the three table rows of each one's history."""
    flat = np.asarray(lists.flatten()).astype(np.int64)
    starts = np.asarray(lists.value_lengths()).cumsum() - np.asarray(lists.value_lengths())
    last = np.empty_like(flat)
    last[1:], last[starts] = flat[:-1], before
    other = np.empty_like(last)
    other[1:], other[starts] = last[:-1], before
    pairs = last * 1_000_003 + other * 8_191 + (last >> 3) & PAIR_ROWS - 1
    rows = np.stack((1 + word_rows(last), 1 + WORD_ROWS + word_rows(other), 1 + 2 * WORD_ROWS + pairs), axis=1)
    return flat, rows


def inner_rows(lists: pa.Array, before: int, at: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The three rows of the table inside the classes, for the histories of some tokens at some nodes."""
    flat = np.asarray(lists.flatten()).astype(np.int64)
    starts = np.asarray(lists.value_lengths()).cumsum() - np.asarray(lists.value_lengths())
    last = np.empty_like(flat)
    last[1:], last[starts] = flat[:-1], before
    other = np.empty_like(last)
    other[1:], other[starts] = last[:-1], before
    return hashed_rows(last[at], other[at], nodes)


def hashed_rows(last: np.ndarray, other: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    def row(nth: int, key: np.ndarray) -> np.ndarray:
        mixed = (key * 1_000_003 + nodes) * 0x9E3779B97F4A7C1 + nth
        return nth * INNER_FEATURE + ((mixed ^ (mixed >> 29)) >> 13 & INNER_FEATURE - 1)

    return np.stack((row(0, last), row(1, other), row(2, last * 8_191 + other)), axis=1)


def class_scores(weights: np.ndarray, rows: np.ndarray, base: np.ndarray | None = None) -> np.ndarray:
    """log P(class) for the histories with these rows; with ``base`` (of the nodes) log P(branch)."""
    line, _, totals = raw_scores(weights, rows, base)
    line -= np.log(totals)[:, None]
    return line


def raw_scores(weights: np.ndarray, rows: np.ndarray, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the rows' weights, up to one number a history, their exponentials and the sums of those."""
    line = weights.take(rows[:, 0], axis=0)
    line += weights.take(rows[:, 1], axis=0)
    line += weights.take(rows[:, 2], axis=0)
    line += weights[0] if base is None else base
    with np.errstate(over="ignore"):
        raised = np.exp(line)
        totals = np.einsum("ij->i", raised)
    # Taking off the largest of each history costs as much as all else, and is seldom needed.
    if len(totals) and not (totals.min() > LEAST_TOTAL and totals.max() < 1 / LEAST_TOTAL):
        line -= line.max(axis=1, keepdims=True)
        raised = np.exp(line)
        totals = np.einsum("ij->i", raised)
    return line, raised, totals


def sums_by_row(values: np.ndarray, at: np.ndarray, first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of ``values[at]`` over groups that begin at ``first`` and have ``times`` members, large groups first.

    Large groups are summed one by one, the many small ones together, one more member of each at a time.
    """
    sums = values.take(at[first], axis=0)
    large = np.count_nonzero(times > LARGE)
    for group in range(large):
        sums[group] = values.take(at[first[group] : first[group] + times[group]], axis=0).sum(axis=0)
    nth = 1
    while (some := np.count_nonzero(times > nth)) > large:
        sums[large:some] += values.take(at[first[large:some] + nth], axis=0)
        nth += 1
    return sums


def batch_sizes(seen: int) -> Iterator[int]:
    """The sizes of a task's gradient steps, the same for every corpus: small ones first, doubled every ``STEPS_A_SIZE`` steps.

    ``seen`` steps have been made already.
    """
    while True:
        yield min(BATCH, FIRST_BATCH << min(seen // STEPS_A_SIZE, 10))
        seen += 1


class Descent:
    """Gradient steps from given weights, with a step width of its own for each weight."""

    def __init__(self, weights: np.ndarray, squares: float = 1e-2):
        self.weights = weights.copy()
        self.squares = np.full_like(self.weights, squares)
        self.met = np.zeros(len(weights), dtype=np.int64)
        self.steps = 0

    def follow(self, rows: np.ndarray, classes: np.ndarray, base: np.ndarray | None = None, of: np.ndarray | None = None) -> None:
        """Steps over all tokens of a batch of texts; ``base`` by node, and the nodes (``of``) of the tokens."""
        at = 0
        for size in batch_sizes(self.steps):
            if at >= len(classes):
                return
            some = slice(at, at + size)
            self.step(rows[some], classes[some], None if base is None else base[of[some]])
            self.steps += 1
            at += size

    def step(self, rows: np.ndarray, classes: np.ndarray, base: np.ndarray | None = None) -> None:
        _, error, totals = raw_scores(self.weights, rows, base)
        error /= totals[:, None]
        error[np.arange(len(classes)), classes] -= 1
        # Rows of either table, and three times a batch, fit in 16 bits, which are sorted by counting.
        flat = rows.reshape(-1).astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        times = np.diff(np.append(first, len(flat)))
        falling = np.argsort((len(flat) - times).astype(np.uint16), kind="stable")
        first, times = first[falling], times[falling]
        touched, slope = ranked[first].astype(np.int64), sums_by_row(error, order // 3, first, times)
        if base is None:  # row 0 is every history's
            touched, times = np.append(0, touched), np.append(len(rows), times)
            slope = np.concatenate((error.sum(axis=0)[None, :], slope))
        self.met[touched] += times
        squares = self.squares.take(touched, axis=0)
        squares += slope * slope
        self.squares[touched] = squares
        slope *= np.float32(RATE)
        slope /= np.sqrt(squares, out=squares)
        weights = self.weights.take(touched, axis=0)
        weights -= slope
        self.weights[touched] = weights


def train(encoded: DataFrame, vocab: Vocabulary, known) -> tuple[np.ndarray, np.ndarray]:
    """The weight tables for the classes and for the words inside them. ``encoded`` holds the training texts.

    A task sends its rows in pieces of ``FAN`` numbers, so that both tables go through one sum.
    """
    spark = encoded.sparkSession
    outer, inner = np.zeros((ROWS, CLASSES), dtype=np.float32), np.zeros((INNER_ROWS, FAN), dtype=np.float32)
    outer[0] = np.log((vocab.class_tokens + 0.5) / (vocab.tokens + 0.5 * CLASSES))
    names = ["row", "n", *[f"w{c}" for c in range(FAN)]]
    schema = "row int, n bigint, " + ", ".join(f"w{c} float" for c in range(FAN))
    folds = CLASSES // FAN  # pieces of a row of the first table
    tasks = max(1, -(-vocab.tokens // (ROUNDS * TASK_TOKENS)))
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((outer, inner))  # their size is fixed by the constants above

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocab, (first, second) = known.value, shared.value
            classes, words = Descent(first), Descent(second, INNER_SQUARES)
            for batch in batches:
                lists = unpacked(batch.column(0))
                flat, rows = histories(lists, vocab.size + 1)
                classes.follow(rows, vocab.classes[flat])
                at, nodes, branches = vocab.choices(flat)
                words.follow(inner_rows(lists, vocab.size + 1, at, nodes), branches, vocab.nodes, nodes)
            pieces = (
                (0, np.repeat(classes.met, folds), classes.weights.reshape(-1, FAN)),
                (ROWS * folds, words.met, words.weights),
            )
            for start, times, weights in pieces:
                met = np.flatnonzero(times)
                for some in (met[k : k + 8192] for k in range(0, len(met), 8192)):
                    moved = weights[some] * times[some][:, None].astype(np.float32)
                    columns = [pa.array((start + some).astype(np.int32)), pa.array(times[some]), *map(pa.array, moved.T.copy())]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        part = encoded.filter(F.pmod(F.xxhash64("key"), F.lit(ROUNDS)) == turn).select("places").coalesce(tasks)
        # Sums by row need no more memory than one row, however many tasks there were.
        sums = part.mapInArrow(run, schema).groupBy("row").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow()
        rows = np.asarray(sums["row"].combine_chunks())
        if len(rows):
            n = np.asarray(sums["n"].combine_chunks()).astype(np.float64)
            table = np.stack([np.asarray(sums[c].combine_chunks()) for c in names[2:]], axis=1) / n[:, None]
            both = np.concatenate((outer.reshape(-1, FAN), inner))
            both[rows] = table.astype(np.float32)
            outer, inner = both[: ROWS * folds].reshape(ROWS, CLASSES).copy(), both[ROWS * folds :].copy()
    return outer, inner


def score(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every document."""
    spark = documents.sparkSession
    counts = count_words(documents.filter(fold("doc_id", FOLDS) != HELD_OUT))
    vocab = vocabulary(counts)
    known = spark.sparkContext.broadcast(vocab)  # at most VOCABULARY words of LONGEST bytes
    encoded = encode(documents, known)
    weights = spark.sparkContext.broadcast(train(encoded.filter(~F.col("held_out")), vocab, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, (table, inner) = known.value, weights.value
        for batch in batches:
            lists = unpacked(batch.column(3))
            flat, rows = histories(lists, vocab.size + 1)
            chosen = np.empty(len(flat))
            for at in range(0, len(flat), BATCH):
                some = slice(at, at + BATCH)
                line, _, totals = raw_scores(table, rows[some])
                chosen[some] = line[np.arange(len(line)), vocab.classes[flat[some]]] - np.log(totals)
            token, nodes, branches = vocab.choices(flat)
            rows = inner_rows(lists, vocab.size + 1, token, nodes)
            inside = np.empty(len(nodes))
            for at in range(0, len(nodes), BATCH):
                some = slice(at, at + BATCH)
                line, _, totals = raw_scores(inner, rows[some], vocab.nodes[nodes[some]])
                inside[some] = line[np.arange(len(line)), branches[some]] - np.log(totals)
            chosen += np.bincount(token, weights=inside, minlength=len(flat))
            lengths = np.asarray(lists.value_lengths()).astype(np.int64)
            starts = lengths.cumsum() - lengths
            sums = [np.add.reduceat(x, starts) for x in (chosen / np.log(10), vocab.base[flat])]
            placed = np.add.reduceat(vocab.known[flat].astype(np.int64), starts)
            made = [*batch.columns[:3], *map(pa.array, (lengths, placed, *sums))]
            yield pa.RecordBatch.from_arrays(made, names=["key", "doc_id", "held_out", "n_tokens", "placed", "model", "base"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"key bigint, doc_id {kind}, held_out boolean, n_tokens bigint, placed bigint, model double, base double"
    placed = encoded.select("key", "doc_id", "held_out", "places").mapInArrow(run, schema)
    # The other words: each is rarer than every word with a place, or longer than LONGEST bytes.
    met = encoded.select("key", F.explode("others").alias("word")).join(counts, "word", "left")
    rest = met.groupBy("key").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0))).alias("logs"),
        F.count("*").alias("times"),
        F.sum((F.coalesce("n", F.lit(0)) > 0).cast("bigint")).alias("known"),
    ).withColumnRenamed("key", "of")
    none = F.lit(0)
    logs, times = F.coalesce("logs", F.lit(0.0)), F.coalesce("times", none)
    everywhere = float(np.log10(vocab.tokens + vocab.distinct + 1))
    inside = float(np.log10(vocab.other_tokens + vocab.other_words + 1))
    return placed.join(rest, F.col("key") == F.col("of"), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("placed") + F.coalesce("known", none)).alias("n_known"),
        F.lit(vocab.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs - times * everywhere).alias("base_score"),
        (F.col("model") + logs - times * inside).alias("score"),
    )
