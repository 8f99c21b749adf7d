"""Token ids in binary files of patched frame-of-reference blocks.

File layout, all numbers little-endian:

    magic
    blocks          each: minimum u32, ids u16, width u8, bytes of a patch u8, exceptions u16,
                    the low ``width`` bits of id - minimum, packed,
                    then the exceptions: places u8, and the bits above ``width`` as patches
    documents       doc_id i64, has_id u8, ids u32 of each document, as three columns
    block starts    u64 each
    footer          blocks u64, documents u64, ids u64, end of the blocks u64, magic

A block holds 256 ids. Its width covers the 90th percentile of its distances from the block's minimum;
larger ones are patched from the exception list.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm import files
from kerbside.llm.common import chunks, flat_ranges, ready, staged
from kerbside.session import scratch_dir

MAGIC = b"PFORTOK1"
BLOCK = 256
PERCENTILE = 0.9
FOOTER = np.dtype([("blocks", "<u8"), ("documents", "<u8"), ("ids", "<u8"), ("end", "<u8")])
HEAD = np.dtype([("minimum", "<u4"), ("ids", "<u2"), ("width", "u1"), ("patch", "u1"), ("exceptions", "<u2")])
END = 0  # the id after each document
CACHED = 500_000  # distinct pieces of text whose ids a worker remembers
# Letters and the punctuation after them are always different pieces to the tokenizer.
LETTER_MARK = r"([A-Za-zÀ-ÖØ-öø-ɏ])([!-/:-@\[-`{-~])"
JOINED = "\x01"  # stands before a piece that has no space before it; texts that hold it are encoded whole
# A piece of text that can be encoded by itself: no white space in the widest sense, but for one newline before it.
PIECE = re.compile(r"[\n\x01]?[^\s\x01\x1c-\x1f\x85\u180e\u200b\u2060\ufeff]+")


class Encoder:
    """Ids of whole texts from a tokenizer file.

    The tokenizer's pattern never joins what stands before a single space or newline to what follows, nor a
    letter to punctuation. So a text without longer white space is encoded piece by piece, and each
    distinct piece only once: many pieces, each after a newline of its own, go to the library as one text,
    and the newline's id cuts the result. Any other text goes to the library whole, and so does one that holds a special
    token's string, such as ``<|endoftext|>``, which gets that token's id.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The library gives such a string in a text its one id; texts that hold one go to it whole.
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.newline = self.library(["\n"])[0]
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {"": 0}  # place 0: cannot be encoded by itself
        self.starts = np.zeros(1024, dtype=np.int64)
        self.lengths = np.zeros(1024, dtype=np.int64)
        self.hits = np.zeros(1024, dtype=np.int64)
        self.flat = np.zeros(4096, dtype=np.uint32)
        self.used, self.next = 0, 1

    def forget_rare(self) -> None:
        """Keeps the pieces that occurred more than once, or nothing if they are too many themselves."""
        kept = [(piece, place) for piece, place in self.places.items() if self.hits[place] > 1 and place]
        old_starts, old_lengths, old_flat = self.starts, self.lengths, self.flat
        self.forget()
        if kept and len(kept) <= CACHED // 2:
            at = np.array([place for _, place in kept])
            lengths, last = old_lengths[at], len(kept) + 1
            self.flat = old_flat[flat_ranges(old_starts[at], lengths)]
            self.starts = np.append(0, np.cumsum(lengths) - lengths)
            self.lengths, self.hits = np.append(0, lengths), np.zeros(last, dtype=np.int64)
            self.places.update((piece, n) for n, (piece, _) in enumerate(kept, 1))
            self.used, self.next = len(self.flat), last

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> None:
        """A piece after a newline has the newline's id, a piece after JOINED none; any other follows a space."""
        self.places.update(dict.fromkeys(pieces, 0))
        good = list(filter(PIECE.fullmatch, pieces)) if len(self.newline) == 1 else []
        for some in chunks(good, 20_000):
            text = "".join([p if p[0] == "\n" else "\n" + p[1:] if p[0] == JOINED else "\n " + p for p in some])
            ids = np.array(self.library([text])[0], dtype=np.uint32)
            cuts = np.flatnonzero(ids == self.newline[0])
            if len(cuts) == len(some):
                starts, ends = cuts + 1, np.append(cuts[1:], len(ids))
                starts -= np.fromiter((p[0] == "\n" for p in some), dtype=np.int64, count=len(some))
                self._add(some, ids, starts, ends - starts)

    def _add(self, pieces: list[str], ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        last = self.next + len(pieces)
        self.starts, self.lengths = _room(self.starts, last), _room(self.lengths, last)
        self.hits, self.flat = _room(self.hits, last), _room(self.flat, self.used + len(ids))
        self.starts[self.next : last] = self.used + starts
        self.lengths[self.next : last] = lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.places.update(zip(pieces, range(self.next, last), strict=True))
        self.used, self.next = self.used + len(ids), last

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts in one array, and how many each text has. A null text is empty."""
        if len(self.places) > CACHED:
            self.forget_rare()
        # A newline put before the first piece makes it like those after a newline; its id is left out again.
        texts = pc.fill_null(texts, "")
        marked = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        marked = pc.replace_substring_regex(marked, LETTER_MARK, rf"\1 {JOINED}\2")
        lists = pc.split_pattern(marked, " ")
        # What stands before the first space is nothing, so each list is read from its second piece on.
        firsts = np.asarray(lists.offsets)[:-1] + 1
        ends = np.asarray(lists.offsets)[1:]
        pieces = lists.values.dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        fresh = [p for p in distinct if p not in self.places]
        if fresh:
            self.learn(fresh)
        places = np.fromiter(map(self.places.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        index = np.asarray(pieces.indices)
        at = places[index]
        at[firsts - 1] = 0
        self.hits[: self.next] += np.bincount(at, minlength=self.next)
        starts, lengths = self.starts[at], self.lengths[at]
        starts[firsts] += 1
        lengths[firsts] -= 1
        odd = np.concatenate(([0], np.cumsum(at == 0)))
        whole = odd[ends] > odd[firsts]  # texts with a piece that cannot be encoded by itself
        whole |= np.asarray(pc.match_substring(texts, JOINED))
        held = (texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes()  # one look at all texts; next to none hold any
        for special in self.special:
            if special.encode() in held:
                whole |= np.asarray(pc.match_substring(texts, special))
        lengths[np.repeat(whole, ends - firsts + 1)] = 0
        sums = np.concatenate(([0], np.cumsum(lengths)))
        counts = sums[ends] - sums[firsts]
        ids = self.flat[flat_ranges(starts, lengths)]
        if not whole.any():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for nth in np.flatnonzero(whole).tolist():
            parts[nth] = np.array(self.library([texts[nth].as_py()])[0], dtype=np.uint32)
        return np.concatenate(parts), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))


def _room(values: np.ndarray, needed: int) -> np.ndarray:
    if needed <= len(values):
        return values
    grown = np.zeros(max(needed, 2 * len(values)), dtype=values.dtype)
    grown[: len(values)] = values
    return grown


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.int64(1) << np.arange(33, dtype=np.int64), values.astype(np.int64), side="right")


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of a run of ids; all but the last are full."""
    full = len(ids) // BLOCK
    blocks = _encode_rows(ids[: full * BLOCK].reshape(full, BLOCK)) if full else []
    if len(ids) > full * BLOCK:
        blocks += _encode_rows(ids[full * BLOCK :].reshape(1, -1))
    return blocks


def _encode_rows(rows: np.ndarray) -> list[bytes]:
    count = rows.shape[1]
    minima = rows.min(axis=1)
    apart = rows - minima[:, None]
    at = min(count - 1, int(PERCENTILE * count))
    widths = _bit_lengths(np.partition(apart, at, axis=1)[:, at])
    heads = np.zeros(len(rows), dtype=HEAD)
    heads["minimum"], heads["ids"], heads["width"] = minima, count, widths
    high = apart >> widths[:, None].astype(np.uint32)
    heads["exceptions"] = np.count_nonzero(high, axis=1)
    row, place = np.nonzero(high)
    ends = np.concatenate(([0], np.cumsum(heads["exceptions"].astype(np.int64))))
    heads["patch"] = np.choose((high.max(axis=1) > 0xFF).astype(int) + (high.max(axis=1) > 0xFFFF), (1, 2, 4))
    places, patches = place.astype(np.uint8), high[row, place]
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths).tolist():
        chosen = np.flatnonzero(widths == width)
        size = 2 if width <= 16 else 4
        raw = apart[chosen].astype(f"<u{size}").view(np.uint8).reshape(-1, size)
        bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :width]
        packed = np.packbits(bits.reshape(len(chosen), -1), axis=1, bitorder="little")
        for k, block in zip(chosen.tolist(), packed, strict=True):
            a, b = ends[k], ends[k + 1]
            out[k] = heads[k].tobytes() + block.tobytes() + places[a:b].tobytes() + _patches(patches[a:b], heads["patch"][k])
    return out


def _patches(values: np.ndarray, size: int) -> bytes:
    return values.astype(f"<u{size}").tobytes()


def decode_block(data: bytes, at: int = 0) -> np.ndarray:
    """The ids of the block that starts at a place."""
    head = np.frombuffer(data, dtype=HEAD, count=1, offset=at)[0]
    count, width, patched = int(head["ids"]), int(head["width"]), int(head["exceptions"])
    at += HEAD.itemsize
    packed = (count * width + 7) // 8
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, packed, at), count=count * width, bitorder="little")
        wide = np.zeros((count, 32), dtype=np.uint8)
        wide[:, :width] = bits.reshape(count, width)
        values = np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1).copy()
    else:
        values = np.zeros(count, dtype=np.uint32)
    if patched:
        places = np.frombuffer(data, np.uint8, patched, at + packed)
        high = np.frombuffer(data, f"<u{int(head['patch'])}", patched, at + packed + patched).astype(np.uint32)
        values[places] |= high << np.uint32(width)
    return values + head["minimum"]


class Writer:
    """Writes documents to a stream; whole blocks leave memory at once."""

    def __init__(self, stream):
        self.stream, self.at, self.left = stream, len(MAGIC), np.zeros(0, dtype=np.uint32)
        self.block_starts: list[int] = []
        self.doc_ids, self.has_ids, self.counts = [], [], []
        stream.write(MAGIC)

    def _blocks(self, ids: np.ndarray) -> None:
        blocks = encode_blocks(ids)
        sizes = np.fromiter(map(len, blocks), dtype=np.int64, count=len(blocks))
        self.block_starts.append(self.at + np.cumsum(sizes) - sizes)
        data = b"".join(blocks)
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.doc_ids.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.has_ids.append(np.asarray(doc_ids.is_valid()).astype(np.uint8))
        self.counts.append(counts.astype("<u4"))
        ids = np.concatenate((self.left, ids))
        whole = len(ids) // BLOCK * BLOCK
        for start in range(0, whole, BLOCK * 4096):
            self._blocks(ids[start : min(whole, start + BLOCK * 4096)])
        self.left = ids[whole:]

    def close(self) -> int:
        """Returns the number of ids in the file."""
        if len(self.left):
            self._blocks(self.left)
        starts = np.concatenate([*self.block_starts, np.zeros(0, dtype=np.int64)]).astype("<u8")
        counts = np.concatenate([*self.counts, np.zeros(0, dtype="<u4")])
        for column in (
            np.concatenate([*self.doc_ids, np.zeros(0, dtype="<i8")]),
            np.concatenate([*self.has_ids, np.zeros(0, dtype=np.uint8)]),
            counts,
            starts,
        ):
            self.stream.write(column.tobytes())
        total = int(counts.sum(dtype=np.int64))
        footer = np.array([(len(starts), len(counts), total, self.at)], dtype=FOOTER)
        self.stream.write(footer.tobytes() + MAGIC)
        return total


def read_documents(stream) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids of all documents before it in the file, its ids) of each document of a file."""
    size = stream.size()
    tail = FOOTER.itemsize + len(MAGIC)
    last = stream.read_at(tail, size - tail)
    if last[FOOTER.itemsize :] != MAGIC or stream.read_at(len(MAGIC), 0) != MAGIC:
        raise ValueError("not a token file")
    footer = np.frombuffer(last, dtype=FOOTER, count=1)[0]
    blocks, documents, end = int(footer["blocks"]), int(footer["documents"]), int(footer["end"])
    index = stream.read_at(size - tail - end, end)
    doc_ids = np.frombuffer(index, "<i8", documents)
    has_ids = np.frombuffer(index, np.uint8, documents, 8 * documents)
    counts = np.frombuffer(index, "<u4", documents, 9 * documents).astype(np.int64)
    starts = np.frombuffer(index, "<u8", blocks, 13 * documents).astype(np.int64)
    bounds = np.concatenate((starts, [end]))
    loaded, first = np.zeros(0, dtype=np.uint32), 0  # ids in memory, and the place of their first
    next_block, begin = 0, 0
    for doc_id, has_id, count in zip(doc_ids.tolist(), has_ids.tolist(), counts.tolist(), strict=True):
        while begin + count > first + len(loaded):
            upto = min(blocks, next_block + max(512, -(-count // BLOCK)))
            data = stream.read_at(int(bounds[upto] - bounds[next_block]), int(bounds[next_block]))
            base = int(bounds[next_block])
            more = decode_blocks(data, bounds[next_block:upto] - base)
            loaded, first = np.concatenate((loaded[begin - first :], more)), begin
            next_block = upto
        yield (doc_id if has_id else None), begin, loaded[begin - first : begin - first + count]
        begin += count


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of several blocks; full ones of the same width are unpacked together."""
    raw = np.frombuffer(data, np.uint8)
    heads = raw[flat_ranges(starts, np.full(len(starts), HEAD.itemsize))].view(HEAD)
    counts, widths = heads["ids"].astype(np.int64), heads["width"].astype(np.int64)
    values = np.zeros((len(starts), BLOCK), dtype=np.uint32)
    for width in np.unique(widths).tolist():
        chosen = np.flatnonzero((widths == width) & (counts == BLOCK))
        if not width or not len(chosen):
            continue
        packed = raw[
            flat_ranges(starts[chosen] + HEAD.itemsize, np.full(len(chosen), BLOCK * width // 8))
        ].reshape(len(chosen), -1)
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(-1, width)
        size = 2 if width <= 16 else 4
        wide = np.zeros((len(bits), 8 * size), dtype=np.uint8)
        wide[:, :width] = bits
        values[chosen] = np.packbits(wide, axis=1, bitorder="little").view(f"<u{size}").reshape(len(chosen), BLOCK)
    for size in (1, 2, 4):
        patched = np.flatnonzero((heads["exceptions"] > 0) & (counts == BLOCK) & (heads["patch"] == size))
        if not len(patched):
            continue
        amount = heads["exceptions"][patched].astype(np.int64)
        at = starts[patched] + HEAD.itemsize + BLOCK * widths[patched] // 8
        places = raw[flat_ranges(at, amount)]
        high = raw[flat_ranges(at + amount, size * amount)].view(f"<u{size}").astype(np.uint32)
        row = np.repeat(patched, amount)
        values[row, places] |= high << widths[row].astype(np.uint32)
    values += heads["minimum"][:, None]
    if len(starts) and counts[-1] < BLOCK:  # only the last block of a file is short
        return np.concatenate((values[:-1].reshape(-1), decode_block(data, int(starts[-1]))))
    return values.reshape(-1)


def write_token_files(documents: DataFrame, folder: str, tokenizer: str, end: int = END) -> DataFrame:
    """Encodes texts and writes one file per range of doc_id. Returns the manifest: file, path, documents, ids.

    Files are in ascending order of doc_id, as are the documents in each; rows without an id come last,
    and rows with equal ids lie in one file, in the order of their texts. A null text is empty.
    """
    ready(documents.sparkSession)
    order = [F.col("doc_id").asc_nulls_last()]
    ranged = documents.select("doc_id", "text").repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order, F.col("text").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, documents_, opened, writer, path = encoder(tokenizer).encode, 0, None, None, None
        part = TaskContext.get().partitionId()
        try:
            for batch in batches:
                if opened is None:
                    opened = files.new_file(folder, ".tok")
                    path, stream = opened.__enter__()
                    writer = Writer(stream)
                ids, counts = encode(batch.column(1))
                ends = np.cumsum(counts)
                closed = np.insert(ids, ends, np.uint32(end))
                writer.add(batch.column(0), closed, counts + 1)
                documents_ += batch.num_rows
            total = writer.close() if writer else 0
        finally:
            if opened is not None:
                opened.__exit__(None, None, None)
        if documents_:
            row = {"file": [part], "path": [path], "documents": [documents_], "ids": [total]}
            yield pa.RecordBatch.from_pydict(row, schema=MANIFEST)

    return staged(ordered.mapInArrow(run, "file int, path string, documents bigint, ids bigint"), "token-manifest")


MANIFEST = pa.schema([("file", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    ready(manifest.sparkSession)
    # One row a file: a few dozen bytes for each partition of the range shuffle meet in one task.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("bigint"))
    # A set number of partitions, or adaptive execution would put all files into one task.
    spread = placed.select("path", "base").repartition(max(1, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[list] = [[], [], [], []]
                with files.open_file(path) as stream:
                    for doc_id, start, ids in read_documents(stream):
                        for column, value in zip(rows, (doc_id, base + start, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                            column.append(value)
                        if len(rows[0]) == 10_000:
                            yield _rows(rows)
                            rows = [[], [], [], []]
                yield _rows(rows)

    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _rows(rows: list[list]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)


def token_digest(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the token files of documents to the shared folder and returns what they hold, by document."""
    folder = scratch_dir(documents.sparkSession, "token-files")
    return read_token_files(write_token_files(documents, folder, tokenizer))
