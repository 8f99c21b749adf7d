"""N-best segmentation against all segmentations, and exact decoding."""

import time

import pyarrow as pa
import public_tokenizers
import pytest
from conftest import *  # noqa: F403
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def every_way(text, model, most):
    """All segmentations of a text, by trying each piece at each place."""
    text, out = " " + text, []

    def go(at, ids, score):
        if at == len(text):
            out.append((score, ids))
            return
        single = False
        for end in range(at + 1, min(len(text), at + 16) + 1):
            entry = model.table.get(text[at:end])
            if entry:
                single = single or end == at + 1
                go(end, [*ids, entry[0]], score + entry[1])
        if not single:
            raw = text[at].encode()
            go(at + 1, [*ids, *(model.byte_ids[b] for b in raw)], score + sum(model.byte_scores[b] for b in raw))

    go(0, [], 0.0)
    return sorted(out, key=lambda x: -x[0])[:most]


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("theanr .,\n漢▁\x01é"), min_size=1, max_size=11))
def test_against_all_segmentations(text):
    own = pieces.segmenter(PATH)
    found, expected = own.n_best(text, 4), every_way(text, own.model, 4)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in expected])
    assert all(own.model.decode(ids).decode() == text for _, ids in found)
    assert len({tuple(ids) for _, ids in found}) == len(found)
    ((ids, scores),) = own.segment(pa.array([text]), 4)
    assert scores == pytest.approx([s for s, _ in expected])
    assert own.model.decode(ids.tolist()).decode() == text


def k_best(text, model, most):
    """The scores of the best segmentations, by keeping the best lists of every place."""
    text = " " + text
    lists = [[0.0]] + [[] for _ in text]
    for start in range(len(text)):
        here, single = sorted(lists[start], reverse=True)[:most], False
        for end in range(start + 1, min(len(text), start + 16) + 1):
            entry = model.table.get(text[start:end])
            if entry:
                single = single or end == start + 1
                lists[end] += [score + entry[1] for score in here]
        if not single:
            bytes_ = sum(model.byte_scores[b] for b in text[start].encode())
            lists[start + 1] += [score + bytes_ for score in here]
    return sorted(lists[-1], reverse=True)[:most]


@pytest.mark.parametrize("unit", ["er", " ", "banana", "ab", "a", "\n", "- ", "the", "aé漢"])
@pytest.mark.parametrize("size", [1_000, 50_000])
def test_repeated_text_does_not_blow_up(unit, size):
    """Texts with more equal ways than atoms in the world, as long as a page and as a book."""
    text = "x" + unit * (size // len(unit)) + "y"
    own = pieces.Segmenter(pieces.segmenter(PATH).model)
    began = time.process_time()
    ((ids, scores, others),) = own.segment_all(pa.array([text]), 3)
    assert time.process_time() - began < (1 if size == 1_000 else 12)
    assert own.model.decode(ids.tolist()).decode() == text
    ways = {tuple(ids.tolist()), *(tuple(pieces.full(ids.tolist(), changes)) for changes in others)}
    assert len(ways) == len(scores)
    if size == 1_000:
        assert scores == k_best(text, own.model, 3)
        assert own.model.best(" " + text, 7) and [s for s, _ in own.model.best(" " + text, 7)] == k_best(text, own.model, 7)


def test_against_the_library(tmp_path):
    """A unigram model of the same pieces and scores, which the library can search itself."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import math

    import sentencepiece

    model = proto.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = 1
    for nth, piece in enumerate(model.pieces):
        piece.score = -math.log(nth + 2)
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "m.model"))
    own = pieces.segmenter(PATH)
    for text in ("the theory", "an interesting entry.", "lower houses", "être là"):
        ids = own.n_best(text, 3)
        score = {nth: p.score for nth, p in enumerate(model.pieces)}
        expected = [sum(score[i] for i in found) for found in library.nbest_encode_as_ids(text, 3)]
        assert [s for s, _ in ids] == pytest.approx(expected, abs=1e-4)


def test_cache_can_overflow(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 30)
    own = pieces.Segmenter(pieces.Model(PATH))
    reference = pieces.Segmenter(own.model)
    for seed in range(5):
        texts = [words(seed, 40), words(0, 40)]  # noqa: F405
        for text, (ids, scores) in zip(texts, own.segment(pa.array(texts), 3), strict=True):
            assert scores == pytest.approx([s for s, _ in reference.n_best(text, 3)])
            assert own.model.decode(ids.tolist()).decode() == text


def test_documents(odd, empty):
    found = pieces.encode_texts(odd, PATH, keep=("doc_id", "score")).collect()
    assert len(found) == odd.count() and all(r.decodes for r in found)
    blank = [r for r in found if r.doc_id in (2, 3)]
    assert all(r.pieces == [] and r.scores == [0.0] for r in blank)
    assert all(r.scores == sorted(r.scores, reverse=True) for r in found)
    assert pieces.encode_texts(empty, PATH).collect() == []


def test_all_segmentations_of_a_document_are_returned(odd):
    own = pieces.segmenter(PATH)
    texts = {r.doc_id: r.text for r in odd.select("doc_id", "text").collect() if r.doc_id is not None}
    found = [r for r in pieces.encode_texts(odd, PATH).collect() if texts.get(r.doc_id)]
    several = 0
    for r in found:
        every = [list(r.pieces), *(pieces.full(r.pieces, changes) for changes in r.others)]
        assert len(every) == len(r.scores) == len({tuple(ids) for ids in every})
        several += len(every) == 3
        for ids, score in zip(every, r.scores, strict=True):
            assert len(texts[r.doc_id]) > 2000 or sum(-pieces.math.log(n + 2) for n in ids) == pytest.approx(score)
    assert several > 3
    text = "the theory of an  interesting entry"
    ((ids, scores, others),) = own.segment_all(pa.array([text]), 3)
    assert [(s, pieces.full(ids.tolist(), c)) for s, c in zip(scores, [[], *others], strict=True)] == [
        (pytest.approx(s), i) for s, i in own.n_best(text, 3)
    ]
    assert all(own.model.decode(pieces.full(ids.tolist(), c)).decode() == text and own.model.same(ids, c) for c in others)
    assert not own.model.same(ids, [(0, 1, (int(ids[-1]),))])
