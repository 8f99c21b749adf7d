"""SentencePiece encoding and decoding with the N best segmentations.

A text is a lattice: an edge for every vocabulary piece that matches somewhere, and an edge of byte pieces
for a character without one. Forward Viterbi scores tell for each place the best way to it, so they are an
exact heuristic for a backward A* search from the end, which finds segmentations best first. Scores are whole numbers of
2^-26, so sums are exact in any order and equal ways are equal: of these the search follows the one that is nearest to the start.
As the heuristic is exact, a place is reached by its best rests first, and only the first N of them can belong to the N best
segmentations; so no place is gone on from more than N times, however many equal ways a text of repeated letters or blanks has.

No piece reaches over two adjacent characters that occur side by side in no piece, so the lattice falls
apart there: the parts are segmented by themselves, each distinct one once in a worker, and the best
combinations of their alternatives are those of the whole text.

All N segmentations are returned: the best in full, each other one as the places where it differs from the best
(``full`` gives its pieces). Each is decoded: pieces decode one by one, so an alternative gives back the text just
if the best does and what it puts in place decodes to what it replaces.

The model file's pieces are ranked (it was built by merges); a piece of rank r has the score -ln(r + 2), rounded to 2^-26.

Defined results: a null or empty text has no pieces, score 0 and one segmentation; text is not normalised, so that
decoding gives back exactly what was encoded, whatever white space or rare characters it holds; of equal
scores the segmentation that the search meets first counts, in the same order on every run.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush, nsmallest
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import chunks, flat_ranges, ready

MARK = "▁"  # stands for a space in the model file
CACHED = 900_000  # distinct parts of text that a worker remembers
BEST = 3
EXACT = 1 << 26  # scores are whole numbers of this part: sums below 2^27 are exact in double precision
RUN = re.compile(r" +[^ ]*")
LETTER = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]")
JOINED = "\x01"  # stands before a part that has no space before it; texts that hold it are cut at spaces only
MISSING = object()
Change = tuple[int, int, tuple[int, ...]]  # first of the best segmentation's pieces, how many, and those in their place


class Model:
    """Pieces with ids and scores, read from a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text: list[bytes] = [b""] * size  # what each piece decodes to
        self.byte_ids = [-1] * 256
        found: dict[str, tuple[int, float]] = {}
        scores = {}
        for nth in range(size):
            piece = model.id_to_piece(nth)
            scores[nth] = round(-math.log(nth + 2) * EXACT) / EXACT
            if model.is_byte(nth):
                self.byte_ids[int(piece[3:5], 16)] = nth
                self.text[nth] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(nth) or model.is_unknown(nth) or model.is_unused(nth)):
                plain = piece.replace(MARK, " ")
                found[plain] = (nth, scores[nth])
                self.text[nth] = plain.encode()
        # Beginnings of pieces are in the table too, so that a search for longer ones can stop early.
        self.table: dict[str, tuple[int, float] | None] = {}
        for piece in found:
            for end in range(1, len(piece)):
                self.table.setdefault(piece[:end], None)
        self.table.update(found)
        self.pairs = {piece[k : k + 2] for piece in found for k in range(len(piece) - 1)}
        # Punctuation that follows a letter in no piece; texts are cut before it.
        after = {pair[1] for pair in self.pairs if LETTER.fullmatch(pair[0])}
        closing = "".join(re.escape(c) for c in string.punctuation if c not in after)
        self.closing = f"({LETTER.pattern})([{closing}])" if closing else None
        self.byte_scores = [scores[i] if i >= 0 else -math.inf for i in self.byte_ids]

    def lattice(self, part: str) -> tuple[list[list[tuple[int, int | tuple[int, ...], float]]], list[float]]:
        """For each end the edges to it, (start, id or byte ids, score), and the score of the best way to it."""
        table, n = self.table, len(part)
        into: list[list] = [[] for _ in range(n + 1)]
        forward = [0.0] + [-math.inf] * n
        for start in range(n):
            # All edges to this place are known, so its forward score is final.
            here, single = forward[start], False
            for end in range(start + 1, n + 1):
                entry = table.get(part[start:end], MISSING)
                if entry is MISSING:
                    break
                if entry is not None:
                    piece, score = entry
                    into[end].append((start, piece, score))
                    if here + score > forward[end]:
                        forward[end] = here + score
                    if end == start + 1:
                        single = True
            if not single:
                raw = part[start].encode("utf-8", "surrogatepass")
                score = sum(self.byte_scores[b] for b in raw)
                into[start + 1].append((start, tuple(self.byte_ids[b] for b in raw), score))
                forward[start + 1] = max(forward[start + 1], here + score)
        return into, forward

    def best(self, part: str, most: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``most`` best segmentations of a part, best first, as (score, ids)."""
        into, forward = self.lattice(part)
        # Entries: what the whole path scores at best (negative), place, order of entry, score from here to the
        # end, and the pieces after. The forward score is exact, so paths arrive at the start best first.
        entered = 0
        heap: list = [(-forward[-1], len(part), 0, 0.0, None)]
        found = []
        visits = bytearray(len(part) + 1) if most < 256 else [0] * (len(part) + 1)
        while heap:
            _, at, _, behind, path = heappop(heap)
            if visits[at] == most:
                continue
            visits[at] += 1
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    piece, path = path
                    if isinstance(piece, int):
                        ids.append(piece)
                    else:
                        ids.extend(piece)
                found.append((behind, tuple(ids)))
                if len(found) == most:
                    break
                continue
            for start, piece, score in into[at]:
                if visits[start] < most:
                    entered += 1
                    total = behind + score
                    heappush(heap, (-(forward[start] + total), start, entered, total, (piece, path)))
        return found

    def decode(self, ids) -> bytes:
        return b"".join(map(self.text.__getitem__, ids))[1:]

    def same(self, ids: np.ndarray, changes: list[Change]) -> bool:
        """Whether a segmentation decodes to what the best one (``ids``) does."""
        text = self.text.__getitem__
        return all(b"".join(map(text, new)) == b"".join(map(text, ids[at : at + n].tolist())) for at, n, new in changes)


class Segmenter:
    """Remembers the best ids, the score and the distance to the second best of distinct parts of texts.

    A part is written without the one space before it; a part without such a space has JOINED before it.
    """

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.scores, self.gaps = np.zeros(1024), np.zeros(1024)
        self.starts, self.lengths = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64)
        self.hits = np.zeros(1024, dtype=np.int64)
        self.flat, self.used = np.zeros(4096, dtype=np.int32), 0

    def forget_rare(self) -> None:
        """Keeps the parts that occurred more than once, or nothing if they are too many themselves."""
        kept = [(part, place) for part, place in self.places.items() if self.hits[place] > 1]
        old = self.starts, self.lengths, self.flat, self.scores, self.gaps
        self.forget()
        if kept and len(kept) <= CACHED // 2:
            at = np.array([place for _, place in kept])
            self.lengths, self.scores, self.gaps = old[1][at], old[3][at], old[4][at]
            self.starts, self.hits = np.cumsum(self.lengths) - self.lengths, np.zeros(len(at), dtype=np.int64)
            self.flat = old[2][flat_ranges(old[0][at], self.lengths)]
            self.used = len(self.flat)
            self.places.update((part, n) for n, (part, _) in enumerate(kept))

    def cut(self, part: str) -> list[str]:
        """A part with its space, cut where no piece can reach over."""
        pairs, out, begin = self.model.pairs, [], 0
        for k in range(1, len(part)):
            if part[k - 1 : k + 1] not in pairs:
                out.append(part[begin:k])
                begin = k
        out.append(part[begin:])
        return out

    def spelled(self, part: str) -> str:
        return part[1:] if part.startswith(JOINED) else " " + part

    def learn(self, parts: list[str]) -> None:
        """Segments new parts. Where they fall apart further, the pieces of text are parts themselves."""
        for some in chunks(parts, 20_000):
            cuts = [[c[1:] if c[0] == " " and len(c) > 1 else JOINED + c for c in self.cut(self.spelled(p))] for p in some]
            new = list(dict.fromkeys(c for own in cuts for c in own if c not in self.places))
            ids, scores, gaps = [], [], []
            for key in new:
                two = self.model.best(self.spelled(key), 2)
                scores.append(two[0][0])
                gaps.append(two[0][0] - two[1][0] if len(two) > 1 else math.inf)
                ids.append(two[0][1])
            self._add(new, ids, scores, gaps)
            whole = [(p, own) for p, own in zip(some, cuts, strict=True) if p not in self.places]
            places = [[self.places[c] for c in own] for _, own in whole]
            self.hits[np.fromiter((k for own in places for k in own), dtype=np.int64)] += 1
            self._add(
                [p for p, _ in whole],
                [np.concatenate([self.flat[self.starts[k] : self.starts[k] + self.lengths[k]] for k in own]) for own in places],
                [math.fsum(self.scores[own]) for own in places],
                [min(self.gaps[own]) for own in places],
            )

    def _add(self, keys: list[str], ids: list, scores: list[float], gaps: list[float]) -> None:
        if not keys:
            return
        first, last = len(self.places), len(self.places) + len(keys)
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.concatenate([np.asarray(i, dtype=np.int32) for i in ids])
        grow = lambda a, n: a if n <= len(a) else np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))
        self.scores, self.gaps = grow(self.scores, last), grow(self.gaps, last)
        self.starts, self.lengths = grow(self.starts, last), grow(self.lengths, last)
        self.hits = grow(self.hits, last)
        self.flat = grow(self.flat, self.used + len(flat))
        self.scores[first:last], self.gaps[first:last], self.lengths[first:last] = scores, gaps, lengths
        self.starts[first:last] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.places.update(zip(keys, range(first, last), strict=True))

    def parts(self, text: str) -> list[str]:
        """The parts of a text of any kind: where spaces meet, they stay with what follows."""
        return [JOINED + run for run in RUN.findall(" " + text)] if text else []

    def segment(self, texts: pa.Array, most: int) -> Iterator[tuple[np.ndarray, list[float]]]:
        """For each text the ids of the best segmentation and the scores of the ``most`` best."""
        for ids, scores, _ in self.segment_all(texts, most):
            yield ids, scores

    def segment_all(self, texts: pa.Array, most: int) -> Iterator[tuple[np.ndarray, list[float], list[list[Change]]]]:
        """For each text the ids of the best segmentation, the scores of the ``most`` best, and how the others differ."""
        if len(self.places) > CACHED:
            self.forget_rare()
        texts = pc.fill_null(texts, "")
        odd = np.asarray(pc.match_substring(texts, JOINED)).astype(bool)
        if self.model.closing:
            marked = pc.replace_substring_regex(texts, self.model.closing, rf"\1 {JOINED}\2")
        lists = pc.split_pattern(marked if self.model.closing else texts, " ")
        bounds = np.asarray(lists.offsets)
        pieces = lists.values.dictionary_encode()
        distinct, index = pieces.dictionary.to_pylist(), np.asarray(pieces.indices)
        empty = np.array([not p for p in distinct], dtype=bool)
        # Texts where spaces meet or stand at an end are cut in another way.
        odd = odd | (np.add.reduceat(empty[index].astype(np.int64), bounds[:-1]) > 0) if len(texts) else odd
        special = {n: self.parts(texts[n].as_py()) for n in np.flatnonzero(odd).tolist()}
        # Only what other texts are made of: an odd text's raw pieces may hold JOINED themselves.
        used = [distinct[n] for n in np.unique(index[~np.repeat(odd, np.diff(bounds))]).tolist()]
        fresh = [p for p in dict.fromkeys([*used, *chain.from_iterable(special.values())]) if p not in self.places]
        if fresh:
            self.learn(fresh)
        places = np.fromiter((self.places.get(p, 0) for p in distinct), dtype=np.int64, count=len(distinct))
        for nth in range(len(texts)):
            if nth in special:
                parts = special[nth]
                at = np.array([self.places[p] for p in parts], dtype=np.int64)
            else:
                own = index[bounds[nth] : bounds[nth + 1]]
                parts, at = _Named(distinct, own), places[own]
            self.hits[at] += 1
            ids = self.flat[flat_ranges(self.starts[at], self.lengths[at])] if len(at) else np.zeros(0, dtype=np.int32)
            found = self._best(parts, at, most)
            first = np.cumsum(self.lengths[at]) - self.lengths[at]
            others = [
                [(int(first[place]), int(self.lengths[at[place]]), new) for place, new in sorted(changes.items())]
                for _, changes in found[1:]
            ]
            yield ids, [score for score, _ in found], others

    def _best(self, parts: Sequence[str], at: np.ndarray, most: int) -> list[tuple[float, dict[int, tuple[int, ...]]]]:
        """The best combinations, as score and the parts that differ from the best segmentation.

        Only the ``most`` - 1 parts whose second best is nearest can differ: a change anywhere else is
        worse than the change of each of these alone.
        """
        base = float(np.sum(self.scores[at]))
        found: list[tuple[float, dict[int, tuple[int, ...]]]] = [(0.0, {})]
        gaps = self.gaps[at]
        near = min(most - 1, len(at))
        if near:
            edge = np.partition(gaps, near - 1)[near - 1]
            nearest = np.flatnonzero(gaps <= edge)
            nearest = nearest[np.argsort(gaps[nearest], kind="stable")][:near]
            for place in nearest.tolist():
                if gaps[place] == math.inf:
                    continue
                options = self._options(parts[place], most)
                joined = [
                    (loss + options[0][0] - score, {**changes, place: ids} if nth else changes)
                    for loss, changes in found
                    for nth, (score, ids) in enumerate(options)
                ]
                found = sorted(joined, key=lambda x: x[0])[:most]
        return [(base - loss, changes) for loss, changes in found]

    def _options(self, part: str, most: int) -> list[tuple[float, tuple[int, ...]]]:
        """The best segmentations of one part. Where it falls apart further, only the ``most`` - 1 pieces of it whose second
        best is nearest can differ, as in ``_best``."""
        cuts = self.cut(self.spelled(part))
        ways = {own: self.model.best(own, most) for own in dict.fromkeys(cuts)}
        if len(cuts) == 1:
            return ways[cuts[0]]
        gaps = [(ways[own][0][0] - ways[own][1][0], nth) for nth, own in enumerate(cuts) if len(ways[own]) > 1]
        found: list[tuple[float, dict[int, tuple[int, ...]]]] = [(0.0, {})]
        for _, nth in nsmallest(most - 1, gaps):
            best = ways[cuts[nth]]
            joined = [
                (loss + best[0][0] - score, {**changes, nth: ids} if other else changes)
                for loss, changes in found
                for other, (score, ids) in enumerate(best)
            ]
            found = sorted(joined, key=lambda x: x[0])[:most]
        base = math.fsum(ways[own][0][0] for own in cuts)
        whole = lambda changes: chain.from_iterable(changes.get(nth) or ways[own][0][1] for nth, own in enumerate(cuts))
        return [(base - loss, tuple(whole(changes))) for loss, changes in found]

    def n_best(self, text: str, most: int) -> list[tuple[float, list[int]]]:
        """The best segmentations of a text as (score, ids)."""
        parts = self.parts(text)
        self.learn(sorted(set(parts).difference(self.places)))
        at = np.array([self.places[p] for p in parts], dtype=np.int64)
        out = []
        for score, changes in self._best(parts, at, most):
            ids: list[int] = []
            for nth, place in enumerate(at.tolist()):
                start = self.starts[place]
                ids.extend(changes.get(nth) or self.flat[start : start + self.lengths[place]].tolist())
            out.append((score, ids))
        return out


class _Named:
    """The parts of a text by their places in a list of distinct ones, spelled out only where asked for."""

    def __init__(self, distinct: list[str], index: np.ndarray):
        self.distinct, self.index = distinct, index

    def __getitem__(self, nth: int) -> str:
        return self.distinct[self.index[nth]]


def full(pieces: Sequence[int], changes: Sequence) -> list[int]:
    """The pieces of another segmentation: those of the best with its changes (at, n, pieces), rising by place."""
    out, done = [], 0
    for at, n, new in changes:
        out += [*pieces[done:at], *new]
        done = at + n
    return [*out, *pieces[done:]]


_SEGMENTERS: dict[str, Segmenter] = {}


def segmenter(path: str) -> Segmenter:
    """One for each worker process and model file."""
    if path not in _SEGMENTERS:
        _SEGMENTERS[path] = Segmenter(Model(path))
    return _SEGMENTERS[path]


OTHERS = pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("pieces", pa.list_(pa.int32()))])))


def encode_texts(documents: DataFrame, model: str, most: int = BEST, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, pieces (ids of the best segmentation), scores (of the best ones), others (of each further
    segmentation the changes to the best, see ``full``) and decodes (whether decoding each gives back the text)
    of every document."""
    ready(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model)
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            ids, scores, others, same = [], [], [], []
            for text, (pieces, best, rest) in zip(texts, own.segment_all(batch.column(0), most), strict=True):
                ids.append(pieces)
                scores.append(best)
                others.append([[{"at": at, "n": n, "pieces": new} for at, n, new in changes] for changes in rest])
                whole = own.model.decode(pieces.tolist()) == (text.as_py() or b"")
                same.append(whole and all(own.model.same(pieces, changes) for changes in rest))
            made = [pa.array(ids, pa.list_(pa.int32())), pa.array(scores, pa.list_(pa.float64()))]
            made += [pa.array(others, OTHERS), pa.array(same, pa.bool_())]
            names = [*keep, "pieces", "scores", "others", "decodes"]
            yield pa.RecordBatch.from_arrays([*batch.column(1).flatten(), *made], names=names)

    kinds = "".join(f"`{c}` {documents.schema[c].dataType.simpleString()}, " for c in keep)
    changes = "array<array<struct<at: int, n: int, pieces: array<int>>>>"
    schema = f"{kinds}pieces array<int>, scores array<double>, others {changes}, decodes boolean"
    kept = F.struct(*[F.col(f"`{c}`") for c in keep])
    return documents.select("text", kept.alias("kept")).mapInArrow(run, schema)
