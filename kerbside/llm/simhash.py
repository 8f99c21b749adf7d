"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most two bits differ in at most
two bytes, so they share at least six positional bytes: the guaranteed minimum of the count filter. A
posting of the index holds the fingerprints that agree in four given positional bytes (two of four byte
pairs; at least two pairs are untouched by two differing bits, so a linked pair meets in a posting). For each
pair in a posting the shared positional bytes are tallied, pairs with six or more stay, and their bits are
compared.

Postings with more than ``POSTING`` members are not spread into pairs. Their members are linked exactly in
another way: each gives itself and its 64 one-bit neighbours as keys, and two fingerprints have a key in
common just when they differ in at most two bits. All members of a key are then within two bits of each
other, so a star replaces the pairs: 65 rows a fingerprint, whatever the posting's size.

Defined results: null and blank texts have the fingerprint zero and are linked like others; a row without
doc_id keeps a null id, and a component without any id has a null component_id; repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import LOWER, ready, staged
from kerbside.llm.components import components

SHINGLE = 3
MAX_BITS = 2
MIN_BYTES = 8 - MAX_BITS
POSTING = 64  # members of a posting that are compared in pairs
SEED = 42
BLOCK = 1 << 16  # shingles hashed at once
PAIRS = [(i, j) for i in range(4) for j in range(i + 1, 4)]  # of the four byte pairs


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in more than half of the hashes of the word shingles, repeats included."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(LOWER), dtype=np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    # The words with one space between: a blank stays if a word ended just before it.
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    data = np.where(blank, np.uint8(32), raw)[keep]
    if len(data) and data[0] == 32:
        data = data[1:]
    if len(data) and data[-1] == 32:
        data = data[:-1]
    if not len(data):
        return 0
    cuts = np.flatnonzero(data == 32)
    starts = np.concatenate(([0], cuts + 1))
    ends = np.concatenate((cuts, [len(data)]))
    if len(starts) >= shingle:
        starts, ends = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    bytes_, digest = data.tobytes(), xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(bytes_[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for part in range(0, len(bits), 255):  # sums of up to 255 bits fit a byte
            ones += bits[part : part + 255].sum(axis=0, dtype=np.uint8)
    set_bits = ones * 2 > len(starts)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``fp`` (bigint) of every document."""
    ready(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in batch.column(0)]
            fps = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], fps], names=[*keep, "fp"])

    source = documents.select("text", *keep)
    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kinds}, fp bigint")


def _group(n: int):
    return F.shiftrightunsigned("fp", 16 * n).bitwiseAND(F.lit(0xFFFF))


def postings(distinct: DataFrame) -> DataFrame:
    """combo (which two byte pairs), bytes (their values) and fp: six rows a fingerprint."""
    rows = [
        F.struct(F.lit(k).alias("combo"), (_group(i) * 65536 + _group(j)).alias("bytes"))
        for k, (i, j) in enumerate(PAIRS)
    ]
    return distinct.select("fp", F.inline(F.array(*rows)))


def _shared_bytes(x):
    """Positional bytes that are equal, given the exclusive or of two fingerprints."""
    return sum((F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(255)) == 0).cast("int") for k in range(8))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges a, b between distinct fingerprints (column fp) at ``max_bits`` (2) or fewer differing bits.

    All such pairs are connected: pairs of small postings directly, those of large ones by stars.
    """
    if max_bits != MAX_BITS:
        raise ValueError("the postings guarantee two bits")
    posted = postings(distinct)
    # The limit is applied before the shuffle too, so a large posting sends at most POSTING + 1 rows a task.
    nth = F.row_number().over(Window.partitionBy("combo", "bytes").orderBy("fp"))
    firsts = posted.withColumn("nth", nth).filter(F.col("nth") <= POSTING + 1)
    lists = firsts.groupBy("combo", "bytes").agg(F.sort_array(F.collect_list("fp")).alias("members"))
    lists = staged(lists.filter(F.size("members") > 1), "postings")

    pairs = (
        lists.filter(F.size("members") <= POSTING)
        .select("combo", "members", F.posexplode("members").alias("at", "a"))
        .select("combo", "a", F.explode(F.expr("slice(members, at + 2, size(members))")).alias("b"))
    )
    x = F.col("a").bitwiseXOR(F.col("b"))
    close = pairs.filter(_shared_bytes(x) >= MIN_BYTES).filter(F.bit_count(x) <= max_bits).select("a", "b")

    large = lists.filter(F.size("members") > POSTING).select("combo", "bytes")
    crowded = posted.join(large, ["combo", "bytes"], "left_semi").select("fp").distinct()
    masks = F.array(*[F.lit(m).cast("bigint") for m in (0, *(1 << k for k in range(63)), -(1 << 63))])
    balls = F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))
    near = crowded.select("fp", F.explode(balls).alias("ball"))
    centre = near.groupBy("ball").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).filter("a <> last")
    stars = near.join(centre, "ball").filter("fp <> a").select("a", F.col("fp").alias("b"))
    return close.union(stars).distinct()


def grouped(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp and component_id of every row of documents."""
    marked = staged(fingerprints(documents, shingle), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    rooted = components(links(distinct, max_bits))
    nodes = distinct.join(rooted, distinct["fp"] == rooted["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    nodes = staged(nodes, "nodes")
    ids = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = nodes.join(ids, "root").select(F.col("fp").alias("node_fp"), "component_id")
    return marked.join(labels, F.col("fp") == F.col("node_fp")).select("doc_id", "fp", "component_id")


def deduplicated(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with the columns of documents: the one with the smallest doc_id.

    Of several rows with that id (or of rows without one) the one with the smallest digest of text,
    source and language stays, and of exact copies any one.
    """
    columns = documents.columns
    rest = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    packed = documents.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), rest.alias("rest"))
    marked = staged(fingerprints(packed, shingle, ("doc_id", "rest")), "fingerprints")
    distinct = staged(
        marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rest")).alias("first")),
        "distinct",
    )
    rooted = components(links(distinct, max_bits))
    nodes = distinct.join(rooted, distinct["fp"] == rooted["node"], "left").select(
        "first", F.coalesce("root", "fp").alias("root")
    )
    kept = nodes.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.rest").alias("kept_rest")
    )
    chosen = packed.join(
        kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("rest") == F.col("kept_rest"))
    )
    return chosen.dropDuplicates(["doc_id", "rest"]).select("doc.*")
