"""Operator 6: count-only Viterbi token counts over a unigram vocabulary.

An Aho-Corasick automaton lists all vocabulary matches of a segment; dynamic
programming carries, for each place, the best score and the number of ids of
the best path. Ties go as in the tokenizer's lattice search: a path is replaced
only by a better one, and starts are tried from the left, so the longest piece
wins. A character without a piece of its own may be an unknown of the least
score less 10, written as its bytes.

No piece goes on from another character to a space mark, so a text is cut
there: segments are counted once per worker and added up. Matches are taken as
the automaton finds them, end after end, so a segment of any length holds no more
places than the longest piece has characters. Scores are summed
in double precision, which is exact for this vocabulary.

Edge cases: a null or empty text has no ids; a literal space mark counts as a
space; repeated rows give equal results; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED = 600_000
#: Longer segments are counted but not kept; longer texts are counted segment by segment.
LONG_KEY = 256
LONG_TEXT = 1 << 20
#: Settled places that may wait to be given back.
TRIM = 4096
NORMAL, USER_DEFINED = 1, 4


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Normal pieces and scores of a sentencepiece model."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return [(p.piece, float(p.score)) for p in model.pieces if p.type == NORMAL]


class Unigram:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        if any(MARK in p.lstrip(MARK) for p, _ in vocabulary):
            raise ValueError("a piece goes on from another character to a space mark")
        self.reach = max(len(p) for p, _ in vocabulary)
        self.cache: dict[str, tuple[int, float]] = {}
        self.segment = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def count(self, segment: str) -> tuple[int, float]:
        """Ids and score of the best path through one segment. Only the places that a piece can reach back to are held."""
        best, ids = [0.0], [0]  # of the places up to the one in hand; the last entry is the place before the next character
        single, unknown, reach, most = self.single, self.unknown, self.reach, self.reach + TRIM
        at, top, many, wide = 0, None, 0, 0

        def settle(upto: int) -> None:
            """Ends are settled in order; an end without a piece of its own character may be an unknown."""
            nonlocal at, top, many, wide
            while at < upto:
                c = segment[at]
                if c not in single:
                    s = best[-1] + unknown
                    if top is None or s > top:
                        top, many = s, ids[-1] + len(c.encode())
                best.append(top)
                ids.append(many)
                if len(best) > most:
                    del best[:-reach], ids[:-reach]
                at, top, wide = at + 1, None, 0

        for end, (length, score) in self.automaton.iter(segment):
            if at < end:
                settle(end)
            s = best[-length] + score
            # Among equal scores the earliest start stays.
            if top is None or s > top or (s == top and length > wide):
                top, many, wide = s, ids[-length] + 1, length
        settle(len(segment))
        return ids[-1], best[-1]

    def segments(self, text: str | None) -> list[str]:
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return self.segment.findall(MARK + text.replace(" ", MARK))
        return text.split(" ")  # each stands for itself behind a mark

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        keys = [self.segments(t) if t and len(t) <= LONG_TEXT else [] for t in texts]
        new = set().union(*keys).difference(self.cache)
        if len(self.cache) + len(new) > CACHED:
            self.cache = {}
            new = set().union(*keys)
        long = {}
        for k in new:
            (self.cache if len(k) <= LONG_KEY else long)[k] = self.count(k if k.startswith(MARK) else MARK + k)
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        every = chain.from_iterable(keys)
        flat = [self.cache.get(k) or long[k] for k in every] if long else list(map(self.cache.__getitem__, every))
        found = np.array(flat, np.float64).reshape(-1, 2)
        out = np.zeros((len(texts), 2))
        if len(found):
            full = sizes > 0
            out[full] = np.add.reduceat(found, (np.cumsum(sizes) - sizes)[full], axis=0)
        for i, t in enumerate(texts):
            if t and len(t) > LONG_TEXT:
                out[i] = self.long_count(t)
        return out[:, 0].astype(np.int64), out[:, 1]

    def long_count(self, text: str) -> tuple[int, float]:
        """As :meth:`counts`, one segment after another: the segments of a very long text are never listed."""
        n, score = 0, 0.0
        for m in self.segment.finditer(MARK + text.replace(" ", MARK)):
            k = m.group()
            found = self.cache.get(k)
            if found is None:
                found = self.count(k)
                if len(k) <= LONG_KEY and len(self.cache) < CACHED:
                    self.cache[k] = found
            n, score = n + found[0], score + found[1]
        return n, score


_BUILT: dict[str, Unigram] = {}


def built(path: str) -> Unigram:
    if path not in _BUILT:
        _BUILT[path] = Unigram(read_vocabulary(path))
    return _BUILT[path]


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, score of the best segmentation. The model file must be at ``path`` on every executor."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path
        if where is None:
            import public_tokenizers

            where = public_tokenizers.path("piece_bpe_32k.model")
        model = built(where)
        for b in batches:
            n, score = model.counts(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(score)], ["doc_id", "n_tokens", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, score double")
