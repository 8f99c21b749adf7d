"""Approximate nearest neighbours on shifted space-filling curves.

Each curve turns the vectors by a random rotation, keeps a few axes, shifts them, and orders all vectors
along a Hilbert curve through those axes. An ordering is cut by places into blocks of a constant number of
vectors, about ``BLOCK``; a query is compared with all vectors in its own block and in the ones next to it.
What the curves find is merged and ranked by the exact measure. So a query costs the same in a table of any
size, and the work grows with the rows. A table of fewer rows than three blocks is compared as a whole. On vectors
without any structure recall falls as the windows become a smaller share of the table; wider blocks or
more curves raise it.

The index is fitted on a bounded sample (``SAMPLE`` rows with the smallest digests): middle and spread of
the projected values. All vectors are indexed. Equal vectors are one entry of the index with the smallest ids that
can be asked for, so a vector that fills a third of the table crowds nothing out. Different vectors with the same
key are ordered by one projection in full precision and cut into blocks like all others.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part; rows without vec_id neither; equal rows with equal ids count once. Of equally near
candidates that a query meets, those with the smallest ids are kept, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from kerbside.llm.common import order_key, ready, staged
from kerbside.session import scratch_dir

CURVES = 12
AXES = 8
BITS = 6  # per axis: 48-bit keys
BLOCK = 2_500  # vectors; a query meets three blocks of every curve, whatever the size of the table
SAMPLE = 20_000
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place along the Hilbert curve of each row of cell numbers (0 .. 2**bits - 1 on each axis)."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    # From cell numbers to the transposed index: undo the turns of each level, then Gray code.
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(axes):
            swap = (x[0] ^ x[i]) & below
            flip = (x[i] & level) != 0
            x[0] ^= np.where(flip, below, swap)
            x[i] ^= np.where(flip, 0, swap)
        level >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    keys = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            keys = (keys << 1) | ((x[i] >> bit) & 1)
    return keys


class Curves:
    """Rotations and shifts of all curves, and the spread of the projected values."""

    def __init__(self, sample: np.ndarray, curves: int, axes: int, bits: int):
        draw = np.random.default_rng(SEED)
        size = sample.shape[1]
        axes = min(axes, size)
        self.curves, self.bits = curves, bits
        self.turns = [np.linalg.qr(draw.normal(size=(size, size)))[0][:, :axes] for _ in range(curves)]
        self.shifts = draw.random((curves, axes))
        self.spread = [np.maximum((sample @ turn).std(axis=0), 1e-12) for turn in self.turns]
        self.middle = [(sample @ turn).mean(axis=0) for turn in self.turns]

    def places(self, vectors: np.ndarray, curve: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys along the curve, and a projection that orders vectors of the same key."""
        z = (vectors @ self.turns[curve] - self.middle[curve]) / self.spread[curve]
        even = 1 / (1 + np.exp(-1.702 * np.clip(z, -30, 30)))  # close to the normal distribution's shares
        cells = ((even + self.shifts[curve]) / 2 * (1 << self.bits)).astype(np.int64)
        return hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1), self.bits), z[:, 0]


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def distinct_vectors(embeddings: DataFrame, asked: int, every: int) -> tuple[DataFrame, DataFrame]:
    """The entries of the index, and the usable rows (vec_id, vector, digest).

    Of an entry: digest, entry (its smallest id), ids (one more than is asked for), asks, vector.

    The limit on ids works before the shuffle, so copies of one vector do not meet in a task.
    """
    vectors = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    vectors = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    common = vectors.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    vectors = vectors.filter(F.size("vector") == (common["n"] if common else 0)).dropDuplicates(["vec_id", "vector"])
    vectors = vectors.withColumn("digest", F.sha2(_bytes("vector"), 256))
    vectors = staged(vectors, "vectors")
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))
    firsts = vectors.select("digest", "vec_id").withColumn("nth", nth).filter(F.col("nth") <= asked + 1)
    ids = firsts.groupBy("digest").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = vectors.groupBy("digest").agg(
        F.min("vec_id").alias("entry"), F.max((F.col("vec_id") % every == 0).cast("int")).alias("asks")
    )
    named = entries.join(ids, "digest").select("digest", "entry", "ids", (F.col("asks") == 1).alias("asks"))
    one = vectors.select("vec_id", "vector")
    return staged(named.join(one, F.col("entry") == F.col("vec_id")).drop("vec_id"), "entries"), vectors


def _bytes(column: str) -> Column:
    return F.array_join(F.transform(column, lambda v: v.cast("string")), ",")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1)


def _packed(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    matrix = np.ascontiguousarray(matrix)
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix[:0].strides[0]
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(matrix)])


def _unpacked(column: pa.Array, kind: str) -> np.ndarray:
    """The rows of ``_packed`` in double precision."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]].view(kind)
    return values.reshape(len(column), -1).astype(float)


def ordered_blocks(entries: DataFrame, fitted: Curves, rows: int, block: int) -> DataFrame:
    """curve, block, entry, asks: all entries once a curve, in blocks of about ``block`` that follow each other along it.

    The orderings are range-partitioned, sorted and stored; a place in an ordering is the number of rows in
    the files before and the row's own place in its file. Blocks are cut by places, not by keys, so their
    size follows neither the size of the table nor how the vectors crowd.
    """
    spark = entries.sparkSession
    shared = spark.sparkContext.broadcast(fitted)  # bounded by the parameters: curves, axes, length of a vector

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value
        for batch in batches:
            x = _matrix(batch.column(2))
            for curve in range(made.curves):
                keys, fine = made.places(x, curve)
                columns = [pa.array(np.full(len(x), curve, dtype=np.int32)), pa.array(keys), pa.array(fine)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, batch.column(0), batch.column(1)], names=["curve", "key", "fine", "entry", "asks"]
                )

    schema = "curve int, key bigint, fine double, entry bigint, asks boolean"
    placed = entries.select("entry", "asks", "vector").mapInArrow(place, schema)
    order = ("curve", "key", "fine", "entry")
    path = scratch_dir(spark, "orderings")
    sorted_rows = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.select("curve", "entry", "asks").write.option("maxRecordsPerFile", 0).parquet(path)
    stored = spark.read.schema("curve int, entry bigint, asks boolean").parquet(path).select(
        "*",
        F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    # A row for each file and curve in it: where the curve begins in the file, and its rows in the files before.
    pieces = stored.groupBy("curve", "file").agg(F.min("at").alias("begins"), F.count("*").alias("held"))
    before = Window.partitionBy("curve").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("curve", "file", "begins", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    blocks = max(1, rows // block)
    nth = F.col("start") + F.col("at") - F.col("begins")
    return stored.join(starts, ["curve", "file"]).select(
        "curve", F.floor(nth * blocks / F.lit(rows)).cast("bigint").alias("block"), "entry", "asks"
    )


FOUND = pa.schema([("query", pa.int64()), ("found", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])


def search(
    embeddings: DataFrame,
    k: int = 20,
    every: int = 20,
    curves: int = CURVES,
    axes: int = AXES,
    bits: int = BITS,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every`` the ``k`` nearest found.

    Nearness is the inner product in double precision; ties go to the smaller id.
    """
    spark = embeddings.sparkSession
    ready(spark)
    entries, vectors = distinct_vectors(embeddings, k, every)
    rows = entries.count()
    if rows == 0:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = entries.select("vector", order_key("entry").alias("place")).orderBy("place").limit(SAMPLE)
    fitted = Curves(np.array([r[0] for r in sample.select("vector").collect()]), curves, axes, bits)
    placed = staged(ordered_blocks(entries, fitted, rows, max(block, k + 1)), "blocks")
    # Vectors travel as bytes, and in the precision they came in, which loses nothing.
    single = isinstance(embeddings.schema["embedding"].dataType.elementType, FloatType)
    kind = "float32" if single else "float64"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0), _packed(_matrix(batch.column(1)).astype(kind))]
            yield pa.RecordBatch.from_arrays(columns, names=["entry", "packed"])

    packed = entries.select("entry", "vector").mapInArrow(pack, "entry bigint, packed binary")
    last = placed.groupBy("curve").agg(F.max("block").alias("last"))
    near = F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))
    asked = placed.filter("asks").join(F.broadcast(last), "curve")  # a row for each curve
    asked = asked.select("curve", near.alias("block"), "entry", F.lit(True).alias("query"), "last")
    asked = asked.filter(F.col("block").between(0, F.col("last"))).drop("last")
    meeting = placed.select("curve", "block", "entry", F.lit(False).alias("query")).union(asked).join(packed, "entry")

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        is_query = np.asarray(group["query"])
        entry = np.asarray(group["entry"])
        x = _unpacked(group["packed"].chunk(0), kind)
        candidates, queries = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        sizes = np.sqrt((x * x).sum(axis=1))
        ids, found, scores = [], [], []
        for start in range(0, len(queries), 256):
            some = queries[start : start + 256]
            if not len(candidates):
                continue
            rough = x[some] @ x[candidates].T
            kept = min(len(candidates), k + 1)  # the query may be one of them
            edge = np.partition(rough, len(candidates) - kept, axis=1)[:, len(candidates) - kept]
            # All that may be as near as the last one kept, once rounding is taken off; then exactly, ties by id.
            slack = 4 * x.shape[1] * np.finfo(float).eps * sizes[some] * sizes[candidates].max()
            for q, line, least in zip(some, rough, edge - slack, strict=True):
                chosen = candidates[line >= least]
                exact = (x[chosen] * x[q]).sum(axis=1)  # the same for a pair wherever it is met
                order = np.lexsort((entry[chosen], -exact))[:kept]
                ids.append(entry[q])
                found.append(entry[chosen[order]])
                scores.append(exact[order])
        return pa.table([pa.array(ids, pa.int64()), pa.array(found, FOUND[1].type), pa.array(scores, FOUND[2].type)], schema=FOUND)

    met = meeting.groupBy("curve", "block").applyInArrow(
        compare, "query bigint, found array<bigint>, scores array<double>"
    )
    pairs = met.select("query", F.inline(F.arrays_zip("found", "scores")))
    best = pairs.groupBy("query", "found").agg(F.max("scores").alias("score"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "found"))
    best = best.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    # From entries back to rows: every row that asks, and the smallest ids of each entry found.
    members = entries.select(F.col("entry").alias("of"), "ids")
    listed = best.join(members, F.col("found") == F.col("of")).select("query", "score", F.explode("ids").alias("vec_id"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    listed = listed.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    lists = staged(listed.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("list")), "lists")
    asking = (
        vectors.filter(F.col("vec_id") % every == 0)
        .select("vec_id", "digest")
        .join(entries.select("digest", "entry"), "digest")
        .select(F.col("vec_id").alias("query_id"), "entry")
    )
    rest = F.slice(F.filter("list", lambda r: r["vec_id"] != F.col("query_id")), 1, k)
    return (
        asking.join(lists, F.col("entry") == F.col("query"))
        .select("query_id", F.posexplode(rest).alias("at", "row"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "row.vec_id", "row.score")
    )
