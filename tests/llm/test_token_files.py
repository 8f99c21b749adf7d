"""Token files: the format's round trip, and equality with the library on whole texts."""

import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from conftest import *  # noqa: F403
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kerbside.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", None, " ", "  a", " a", "a ", "a  b", "x\n\ny", "\n", "a\n b", "a \nb", "It's 'quoted'... don't!! 12,5%", "é漢 字\tq",
    "<|endoftext|> a", "a b c  d", "a.\nb", "O'neil's", "ab'", "'s t", "a\x01b", "x×. yǀ.,", "it's. don't,no", "a.b.c--d",
]


PLAIN = Tokenizer.from_file(PATH)


def library(texts):
    """The plain call: strings of special tokens get their one id."""
    return [e.ids for e in PLAIN.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def encoded(texts):
    ids, counts = token_files.encoder(PATH).encode(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_ids_of_whole_texts():
    assert encoded(ODD) == library(ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sté .,\n\t-#1\x01 漢"), max_size=25), min_size=1, max_size=5))
def test_ids_of_any_text(texts):
    assert encoded(texts) == library(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab' .\n-<|", "<|endoftext|>", "<|endoftext", "|>", "the"]), max_size=12).map("".join), min_size=1, max_size=4))
def test_special_strings(texts):
    assert encoded(texts) == library(texts)


def test_a_special_string_is_one_id():
    assert encoded(["a<|endoftext|>b", "<|endoftext|>", "a <|endoftext |>"])[:2] == [[64, 50256, 65], [50256]]


def test_cache_can_overflow(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED", 20)
    for seed in range(6):
        texts = [words(seed, 30), words(0, 30)]  # noqa: F405
        assert encoded(texts) == library(texts)


class Stream(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, length, at):
        return self.getvalue()[at : at + length]


@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 2**32])
@pytest.mark.parametrize("sizes", [[0], [1], [255, 1, 0, 700], [10_000, 3], []])
def test_round_trip(high, sizes):
    draw = np.random.default_rng(high)
    docs = [draw.integers(0, high, n, dtype=np.uint64).astype(np.uint32) for n in sizes]
    for ids in docs:
        ids[:: max(1, len(ids) // 9)] = high - 1  # outliers
    out = Stream()
    writer = token_files.Writer(out)
    for nth, ids in enumerate(docs):
        writer.add(pa.array([None if nth == 1 else nth], pa.int64()), ids, np.array([len(ids)]))
    assert writer.close() == sum(sizes)
    found = list(token_files.read_documents(out))
    assert [i for i, _, _ in found] == [None if n == 1 else n for n in range(len(docs))]
    assert all(np.array_equal(a, b) for (_, _, a), b in zip(found, docs, strict=True))
    assert [s for _, s, _ in found] == [sum(sizes[:n]) for n in range(len(sizes))]


def test_blocks_are_found_by_their_index():
    ids = np.arange(1000, dtype=np.uint32) * 7
    blocks = token_files.encode_blocks(ids)
    assert np.array_equal(np.concatenate([token_files.decode_block(b) for b in blocks]), ids)


def test_documents_against_library(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    found = token_files.token_digest(odd, PATH).collect()
    assert len(found) == len(rows)
    expected = sorted(
        ((r["doc_id"] is None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "") for r in rows)
    )
    start = 0
    for want, got in zip(expected, sorted(found, key=lambda r: (r["start"], r["n_tokens"])), strict=True):
        ids = [*library([want[3]])[0], 0]
        assert got["doc_id"] == (None if want[0] else want[1])
        assert (got["start"], got["n_tokens"]) == (start, len(ids))
        assert got["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    assert token_files.token_digest(empty, PATH).collect() == []
