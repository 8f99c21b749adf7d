"""Token counts by a two-tier lookup of pre-tokens.

No piece of the vocabulary goes on after a letter with a space, so a text falls apart before each run of spaces, and the tokens
of a text are those of its pre-tokens, a run of spaces with what follows. Their lengths are looked up where the text is:

1. in a table of frequent pre-tokens, sent to all executors: at most ``TABLE`` entries of at most ``LONGEST`` letters;
2. else in a cache of the worker process; what it lacks is encoded by the library, all new ones of a text together.

Pre-tokens are never shuffled. The table is counted in one task on a bounded, repeatable sample of documents; it decides
only where a length is found, never its value.

Defined results: a null text counts as empty; an empty text has no tokens; further columns are ignored; each row of the
table is answered by itself, so repeated rows and ids stay. A vocabulary with pieces that go on after a space is counted
on whole texts.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import ready, staged
from kerbside.llm.linear import sample_rows

MARK = "▁"  # stands for a space in the model file, and counts as one in texts
RUN = re.compile(" +[^ ]*")
TABLE = 65_536  # frequent pre-tokens sent to every executor
LONGEST = 32  # letters of one
SAMPLE = 4_000  # documents that the table is counted on
CACHED = 400_000  # pre-tokens that a worker remembers
COUNTED = 2_000_000  # pre-tokens counted at once on the sample
STRETCH = 1_000_000  # letters of a text that are cut at once
LIMIT = 4096


class Lengths(dict):
    """Lengths of pre-tokens in tokens of a SentencePiece model file: the second tier, remembered by a worker."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        super().__init__()
        self.model = SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.divides = not any(MARK in piece.lstrip(MARK) for piece in pieces)
        # The library gives an empty text no tokens, so a single space at the end is measured behind a letter.
        self.space = len(self.model.encode("a ")) - len(self.model.encode("a"))

    def cut(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, each with the spaces before it; the first gets the one that the library adds."""
        if not text:
            return
        if not self.divides:
            yield [f" {text}"]
            return
        text = f" {text.replace(MARK, ' ')}"
        begin = 0
        while len(text) - begin > STRETCH:
            end = text.find(" ", begin + STRETCH)
            while end > 0 and text[end - 1] == " ":  # inside a run of spaces
                end = text.find(" ", end + 1)
            if end < 0:
                break
            yield RUN.findall(text, begin, end)
            begin = end
        yield RUN.findall(text, begin) if begin else RUN.findall(text)

    def learn(self, new: Iterable[str]) -> None:
        new = [part for part in dict.fromkeys(new) if part not in self]
        # The library puts a space before every text.
        for part, ids in zip(new, self.model.encode([part[1:] for part in new], num_threads=1), strict=True):
            self[part] = len(ids)
        if " " in new:
            self[" "] = self.space


def frequent(documents: DataFrame, model: str, table: int = TABLE, sample: int = SAMPLE) -> tuple[pa.Array, np.ndarray]:
    """The most frequent pre-tokens of a bounded sample of the documents, and their lengths in tokens."""
    ready(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = Lengths(model), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for parts in own.cut(text or ""):
                    counts.update(part for part in parts if len(part) <= LONGEST)
                if len(counts) > COUNTED:
                    counts = Counter(dict(counts.most_common(COUNTED // 2)))
        best = sorted(((-n, part) for part, n in counts.items() if n > 1))[:table]
        parts = [part for _, part in best]
        own.learn(parts)
        sizes = pa.array([own[part] for part in parts], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), sizes], names=["part", "tokens"])

    chosen = staged(sample_rows(documents.select("doc_id", "text"), sample).select("text"), "pre-tokens")
    found = chosen.coalesce(1).mapInArrow(run, "part string, tokens int").toArrow().combine_chunks()
    parts = found["part"].chunk(0) if found.num_rows else pa.array([], pa.string())
    return parts, np.asarray(found["tokens"]).astype(np.uint16)


# Of a worker process: the lengths by model file, and the first tier last used.
_LENGTHS: dict[str, Lengths] = {}
_TABLES: dict[str, dict[str, int]] = {}


def lengths_of(path: str) -> Lengths:
    if path not in _LENGTHS:
        _LENGTHS[path] = Lengths(path)
    return _LENGTHS[path]


def count_tokens(
    documents: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), table: int = TABLE, sample: int = SAMPLE
) -> DataFrame:
    """The kept columns, n_bytes and n_tokens of every whole text."""
    spark = documents.sparkSession
    ready(spark)
    sent = spark.sparkContext.broadcast(frequent(documents, model, table, sample))

    name = uuid.uuid4().hex

    def first_tier() -> dict[str, int]:
        if name not in _TABLES:
            _TABLES.clear()
            parts, sizes = sent.value
            _TABLES[name] = dict(zip(parts.to_pylist(), sizes.tolist(), strict=True))
        return _TABLES[name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = first_tier(), lengths_of(model)
        for batch in batches:
            if len(second) > CACHED:
                second.clear()
            totals = []
            for text in batch.column(0).to_pylist():
                total = 0
                for parts in second.cut(text or ""):
                    found = list(map(first.get, parts))
                    missed = [part for part, n in zip(parts, found, strict=True) if n is None]
                    second.learn(missed)
                    total += sum(filter(None, found)) + sum(map(second.__getitem__, missed))
                totals.append(total)
            yield pa.RecordBatch.from_arrays(
                [*batch.column(1).flatten(), pa.array(totals, pa.int64())], names=[*keep, "n_bytes", "n_tokens"]
            )

    kinds = "".join(f"`{c}` {documents.schema[c].dataType.simpleString()}, " for c in keep)
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    kept = F.struct(*[F.col(f"`{c}`") for c in keep], size.alias("n_bytes"))
    return documents.select("text", kept.alias("kept")).mapInArrow(run, f"{kinds}n_bytes bigint, n_tokens bigint")
