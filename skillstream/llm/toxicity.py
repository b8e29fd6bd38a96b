"""Operator 9: toxicity by a convolutional text classifier.

Each word is the sum of hashed embeddings of itself and of its beginnings and
ending; filters of several widths run over the words, each keeps its largest
value in the text, and a logistic layer scores those. It learns from every
labelled row, whole texts, in Spark tasks: the embeddings start from the
buckets' log odds in all these rows; then, in each of a few rounds, every task
takes steps on its own rows and the changes are averaged. The threshold of
each language (guessed from the text's own stop words, never from a column) is
calibrated on a quarter of the texts by a second model that learns from the
others alone, and shifted to 0.5.

Edge cases: a null or empty text is scored as one blank word; a null id counts
as held out; repeated rows score alike; without labels of both kinds every
score is 0; an empty table gives an empty result; other columns are ignored by
:func:`scores` and kept by :func:`clean_documents`.
"""

from __future__ import annotations

import re
import sys
import warnings
from collections.abc import Iterator
from itertools import repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STORE_BYTES, by_size, enter, ship, store
from .labelled import held_out, labelled

BUCKETS = 1 << 20
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 12
CUT = 0.5
#: Passes over all labelled rows, at least and at most: as many as visit VISITS rows.
ROUNDS, VISITS = (1, 6), 24_000
#: A task learns from about so many rows or more between two averages, in steps of BATCH.
LEARNER_ROWS, BATCH = 4000, 64
RATE, SEEN = 0.05, np.float32(1e-3)
#: Changes are summed in whole numbers of 1 / UNIT; logits are counted in cells of 1 / CELLS.
UNIT, CELLS = 1 << 20, 256
#: Rows that a task gives back at once.
SENT_ROWS = 10_000
#: Bytes of a kept word besides its letters; words are kept up to STORE_BYTES.
WORD_BYTES = 190
#: Characters that are scored at once; a longer text goes through the filters piece by piece.
PIECE = 1 << 20
WORD = re.compile(r"\w+")
WHITE = re.compile(r"\s")
#: Frequent words by which a text's language is guessed.
STOP_WORDS = {
    "en": "the of and to in is that for it with as on are this be at by or an",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine",
    "fr": "de la le et les des en un du une que est pour qui dans par au sur pas",
    "es": "de la que el en y los del las por con una su para es al lo como más",
}
LANGUAGES = [*STOP_WORDS, "other"]
UNKNOWN = 2
#: By code point: whether it belongs to words (1, 0), found when it is first met.
_LETTERS = np.full(sys.maxunicode + 1, UNKNOWN, np.uint8)
_LETTERS[:128] = [bool(WORD.match(chr(c))) for c in range(128)]
_ASCII = np.concatenate([_LETTERS[:128], np.zeros(128, np.uint8)])


def _in_words(raw: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 whether its character belongs to a word (1, 0)."""
    out = _ASCII[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if not len(lead):
        return out
    width = 2 + (raw[lead] >= 0xE0) + (raw[lead] >= 0xF0)
    for n in (2, 3, 4):
        at = lead[width == n]
        points = raw[at].astype(np.int64) & (0xFF >> (n + 1))
        for k in range(1, n):
            points = points << 6 | raw[at + k] & 0x3F
        for c in np.unique(points[_LETTERS[points] == UNKNOWN]):
            _LETTERS[c] = bool(WORD.match(chr(c)))
        for k in range(n):
            out[at + k] = _LETTERS[points]
    return out


def features(words: list[str]) -> np.ndarray:
    """Buckets of each word: itself, its beginnings of 4 and 5 letters, its last 4 letters; short words only have themselves."""
    h = xxhash.xxh3_64_intdigest
    seen: dict[str, int] = {"": BUCKETS}

    def part(p: str) -> int:
        if (b := seen.get(p)) is None:
            b = seen[p] = h(p) % BUCKETS
        return b

    columns = ([h(w) % BUCKETS for w in words], [part("<" + w[:4] if len(w) > 4 else "") for w in words],
               [part("<" + w[:5] if len(w) > 5 else "") for w in words], [part(w[-4:] + ">" if len(w) > 4 else "") for w in words])
    return np.array(columns, np.int64).T


def _stops() -> dict[str, int]:
    """Word → languages that have it, one bit each."""
    out: dict[str, int] = {}
    for i, words in enumerate(STOP_WORDS.values()):
        for w in words.split():
            out[w] = out.get(w, 0) | 1 << i
    return out


class Texts:
    """Words as numbers of a bounded vocabulary; number 0 is the blank word."""

    def __init__(self, most: float = STORE_BYTES):
        self.stops, self.most = _stops(), most  # bytes
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.letters = 0
        self.buckets = np.full((1, 4), BUCKETS, np.int32)
        self.langs = np.zeros(1, np.int8)

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers end to end with blanks between the texts, and where each text starts; numbers hold until the next call."""
        lower = [t.lower() if t else "" for t in texts]
        raw = np.frombuffer("\n".join(lower).encode(), np.uint8)
        kind = _in_words(raw)
        step = np.diff(kind.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        bounds = np.concatenate([[0], np.cumsum(end - first)]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(raw[kind.view(bool)])).dictionary_encode()
        ids = self._numbers(words.dictionary.to_pylist())[words.indices.to_numpy()]
        begins = np.cumsum([0, *[len(t) + 1 if t.isascii() else len(t.encode()) + 1 for t in lower]])
        return self._laid(ids, np.diff(np.searchsorted(first, begins)))

    def numbered(self, words: list[str]) -> np.ndarray:
        """The same for the words of one text."""
        distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
        at = np.fromiter(map(distinct.__getitem__, words), np.int64, len(words))
        return self._laid(self._numbers(list(distinct))[at], np.array([len(words)]))[0]

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of words that differ."""
        ids = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        if (missing := np.flatnonzero(ids < 0)).size:
            new = [words[i] for i in missing]
            if WORD_BYTES * (len(self.number) + len(new)) + self.letters > self.most:
                self.clear()
                new, missing = words, np.arange(len(words))
            self.letters += sum(map(len, new))
            have = len(self.number) + 1
            ids[missing] = np.arange(have, have + len(new))
            self.number.update(zip(new, range(have, have + len(new)), strict=True))
            self.buckets = np.concatenate([self.buckets, features(new).astype(np.int32)])
            self.langs = np.concatenate([self.langs, np.array([self.stops.get(w, 0) for w in new], np.int8)])
        return ids

    @staticmethod
    def _laid(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sizes: words of each text."""
        gap = max(WIDTHS)
        starts = np.cumsum(sizes + gap) - sizes - gap
        out = np.zeros(int(sizes.sum()) + gap * len(sizes), np.int64)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)) * gap, sizes)] = ids
        return out, starts

    def stop_words(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How many stop words of each language the texts have."""
        bits = self.langs[ids].astype(np.int64)
        return np.stack([np.add.reduceat((bits >> k) & 1, starts) for k in range(len(STOP_WORDS))], axis=1)

    def language(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The language with most stop words; the last one stands for none."""
        return _most_frequent(self.stop_words(ids, starts)) if len(starts) else np.zeros(0, np.int64)


def _most_frequent(counts: np.ndarray) -> np.ndarray:
    return np.where(counts.max(axis=1) > 0, counts.argmax(axis=1), len(STOP_WORDS))


def word_lists(text: str) -> Iterator[tuple[list[str], list[str]]]:
    """The words of a long text, of about PIECE characters at a time, each list with the words that follow it.

    As many follow as a filter reaches beyond its first word, none at the end. No word goes beyond white space.
    """
    reach, held, at = max(WIDTHS) - 1, [], 0
    while at < len(text):
        gap = WHITE.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        held += WORD.findall(text[at:end].lower())
        at = end
        if at < len(text) and len(held) > reach:
            yield held[:-reach], held[-reach:]
            held = held[-reach:]
    yield held, []


class Cnn:
    def __init__(self, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.emb = np.zeros((BUCKETS + 1, DIM), np.float32)
        self.kernel = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        for k in self.kernel:  # half of the filters look for the log odds, half against them
            k[:, 0, : FILTERS // 2] = np.abs(k[:, 0, : FILTERS // 2])
            k[:, 0, FILTERS // 2:] = -np.abs(k[:, 0, FILTERS // 2:])
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.base = np.zeros(1, np.float32)
        self.shift = np.zeros(len(LANGUAGES))

    def hidden(self, words: np.ndarray, ids: np.ndarray, starts: np.ndarray, argmax: bool = False):
        """words: embeddings of the numbers in ids. The largest value of each filter in each text (and where)."""
        ends = np.concatenate([starts[1:], [len(ids)]])
        last = ends - max(WIDTHS)  # windows start in the text's words, or at its first blank
        tops, wheres = [], []
        for k in self.kernel:
            width = len(k)
            n = len(ids) - width + 1
            s = np.zeros((n, FILTERS), np.float32)
            for j in range(width):
                s += (words @ k[j])[ids[j:j + n]]
            for g in range(max(WIDTHS)):  # windows that start in the blanks between texts reach into the next one
                at = last + g
                s[at[(at < n) & (at != starts)]] = -np.inf
            tops.append(np.maximum.reduceat(s, starts))
            if argmax:
                wheres.append(np.stack([a + s[a:b].argmax(axis=0) for a, b in zip(starts, np.minimum(ends, n), strict=True)]))
        return np.concatenate(tops, axis=1) + self.bias, wheres

    def logits(self, words: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        return np.maximum(self.hidden(words, ids, starts)[0], 0) @ self.out + self.base[0]

    def embed(self, buckets: np.ndarray) -> np.ndarray:
        return self.emb[buckets].sum(axis=-2)

    def pooled(self, buckets: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
        """hidden, and by width and place the buckets of the words where each filter has its largest value (texts, filters, 4).

        buckets: those of the words that the ids number.
        """
        h, where = self.hidden(self.embed(buckets), ids, starts, argmax=True)
        return h, [[buckets[ids[w + j]] for j in range(len(k))] for w, k in zip(where, self.kernel, strict=True)]

    def start(self, buckets: np.ndarray, held: np.ndarray, n: np.ndarray) -> None:
        """First coordinate: log odds of a bucket between the classes, less the rarer it is; the others: small noise.

        held: by class, the texts that have each of the buckets; n: the texts of the classes.
        """
        odds = np.log((held[1] + 0.5) / (n[1] + 1)) - np.log((held[0] + 0.5) / (n[0] + 1))
        total = held.sum(axis=0)
        order = np.argsort(buckets)
        order = order[total[order] > 0]
        at = buckets[order]
        self.emb[at] = np.random.default_rng(11).normal(0, 0.02, (len(at), DIM))
        self.emb[at, 0] = (odds * total / (total + 15))[order] * 0.3
        self.emb[BUCKETS] = 0

    def dense(self) -> list[np.ndarray]:
        """The parameters besides the embedding."""
        return [*self.kernel, self.bias, self.out, self.base]

    def move(self, rows: np.ndarray, by: np.ndarray) -> None:
        """Changes of the rows that Learner.changes numbers."""
        of_words = rows < BUCKETS
        self.emb[rows[of_words]] += by[of_words]
        flat = np.zeros(-(-sum(p.size for p in self.dense()) // DIM) * DIM, np.float32)
        for row, values in zip(rows[~of_words] - BUCKETS - 1, by[~of_words], strict=True):
            flat[row * DIM:(row + 1) * DIM] = values
        at = 0
        for p in self.dense():
            p += flat[at:at + p.size].reshape(p.shape)
            at += p.size

    def calibrate(self, lang: np.ndarray, low: np.ndarray, high: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> None:
        """Per language: the middle of the logits between the classes at which fewest rows are wrong (clean ones weigh more).

        The rows come as cells of equal language and nearly equal logits: smallest and largest logit, rows by class.
        """
        def best(own: np.ndarray) -> float:
            own = own[np.argsort(low[own], kind="stable")]
            wrong = np.concatenate([[0], np.cumsum(toxic[own])]) + 2 * (clean[own].sum() - np.concatenate([[0], np.cumsum(clean[own])]))
            at = np.flatnonzero(wrong == wrong.min())
            at = at[len(at) // 2]
            below = high[own][at - 1] if at else low[own][0] - 1
            return float((below + (low[own][at] if at < len(own) else high[own][-1] + 1)) / 2)

        every = np.arange(len(lang))
        general = best(every) if toxic.sum() and clean.sum() else 0.0
        for k in range(len(LANGUAGES)):
            own = np.flatnonzero(lang == k)
            self.shift[k] = best(own) if toxic[own].sum() >= 10 and clean[own].sum() >= 10 else general

    def packed(self) -> dict:
        """What the workers need: the rows of the embedding that are not 0."""
        rows = np.flatnonzero(np.abs(self.emb).max(axis=1) > 1e-3)
        return {"rows": rows, "emb": self.emb[rows], "kernel": self.kernel, "bias": self.bias, "out": self.out, "base": self.base, "shift": self.shift}

    @classmethod
    def unpacked(cls, p: dict) -> Cnn:
        m = cls()
        m.emb[p["rows"]] = p["emb"]
        m.kernel, m.bias, m.out, m.base, m.shift = p["kernel"], p["bias"], p["out"], p["base"], p["shift"]
        return m


def _used(model: Cnn, v: Texts, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings of the words that occur, and ids as rows of those."""
    numbers, local = np.unique(ids, return_inverse=True)
    return model.embed(v.buckets[numbers]), local


def _pieces(v: Texts, text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Word numbers of a long text's pieces and of what follows each, and how many are the piece's own."""
    first = True
    for own, following in word_lists(text):
        if own or first:
            ids = v.numbered(own + following)
            # What follows stands in the place of the blanks, where no window starts.
            yield ids[:len(own) + max(WIDTHS)], len(own)
            first = False


def _is_long(texts: list[str | None]) -> bool:
    return len(texts) == 1 and texts[0] is not None and len(texts[0]) > PIECE


ONE = np.zeros(1, np.int64)


def _long_text(model: Cnn, v: Texts, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Logit and stop words of one long text: the largest value of each filter over its pieces, counts added up."""
    top, counts = None, 0
    for ids, own in _pieces(v, text):
        words, local = _used(model, v, ids)
        here = model.hidden(words, local, ONE)[0]
        top = here if top is None else np.maximum(top, here)
        counts = counts + v.stop_words(np.concatenate([ids[:own], ONE]), ONE)
    return np.maximum(top, 0) @ model.out + model.base[0], counts


def judged(model: Cnn, v: Texts, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Logits of texts, and their languages."""
    z, langs = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for run in by_size(texts, PIECE):
        some = texts[run]
        if _is_long(some):
            z[run], counts = _long_text(model, v, some[0])
            langs[run] = _most_frequent(counts)
        else:
            ids, starts = v.read(some)
            z[run], langs[run] = model.logits(*_used(model, v, ids), starts), v.language(ids, starts)
    return z, langs


def _batches(ids: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """BATCH texts at a time: the numbers that occur, ids as places among those, and where each text starts."""
    for k in range(0, len(starts), BATCH):
        begins = starts[k:k + BATCH]
        end = starts[k + BATCH] if k + BATCH < len(starts) else len(ids)
        yield *np.unique(ids[begins[0]:end], return_inverse=True), begins - begins[0]


def texts_of_buckets(v: Texts, texts: list[str | None], held: np.ndarray) -> None:
    """Adds 1 to the buckets of each text."""
    for run in by_size(texts, PIECE):
        some = texts[run]
        if _is_long(some):
            met = np.unique(np.concatenate([np.unique(v.buckets[np.unique(ids)]) for ids, _ in _pieces(v, some[0])]))
            held[met] += 1
        else:
            ids, starts = v.read(some)
            for numbers, local, begins in _batches(ids, starts):
                n = len(numbers)
                pairs = np.unique(np.repeat(np.arange(len(begins)) * n, np.diff([*begins, len(local)])) + local)
                pairs = np.unique((pairs // n)[:, None] * (BUCKETS + 1) + v.buckets[numbers[pairs % n]])
                np.add.at(held, pairs % (BUCKETS + 1), 1)


def _pooled_pieces(model: Cnn, v: Texts, text: str) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """Cnn.pooled of a long text."""
    top = places = None
    for ids, _ in _pieces(v, text):
        numbers, local = np.unique(ids, return_inverse=True)
        h, at = model.pooled(v.buckets[numbers], local, ONE)
        if top is None:
            top, places = h, at
            continue
        for w, of_width in enumerate(at):
            more = (h > top)[:, w * FILTERS:(w + 1) * FILTERS, None]
            places[w] = [np.where(more, a, b) for a, b in zip(of_width, places[w], strict=True)]
        top = np.maximum(top, h)
    return top, places


class Learner:
    """One task's copy of a model, which learns from the rows of the task by adaptive gradient steps."""

    def __init__(self, packed: dict, weight: np.ndarray):
        self.packed, self.weight, self.rows = packed, weight, 0
        self.model = Cnn.unpacked(packed)
        self.model.kernel = [k.copy() for k in self.model.kernel]
        self.model.bias, self.model.out, self.model.base = self.model.bias.copy(), self.model.out.copy(), self.model.base.copy()
        self.seen = [np.full(p.shape, SEEN, np.float32) for p in self.model.dense()]
        self.seen_words = np.full(BUCKETS + 1, SEEN, np.float32)

    def learn(self, v: Texts, texts: list[str | None], y: np.ndarray) -> None:
        """One step for each BATCH texts, fewer where they are long."""
        for run in by_size(texts, PIECE):
            some = texts[run]
            if _is_long(some):
                self.step(*_pooled_pieces(self.model, v, some[0]), y[run])
                continue
            ids, starts = v.read(some)
            at = run.start
            for numbers, local, begins in _batches(ids, starts):
                part = slice(at, at := at + len(begins))
                self.step(*self.model.pooled(v.buckets[numbers], local, begins), y[part])

    def step(self, h: np.ndarray, at: list[list[np.ndarray]], y: np.ndarray) -> None:
        """One step on pooled texts."""
        m = self.model
        self.rows += len(y)
        a = np.maximum(h, 0)
        p = 1 / (1 + np.exp(-np.clip(a @ m.out + m.base[0], -30, 30)))
        d = ((p - y) * self.weight[y] / BATCH).astype(np.float32)
        dh = d[:, None] * m.out[None, :] * (h > 0)
        grads, buckets, moves = [], [], []
        for w, k in enumerate(m.kernel):
            g = np.zeros_like(k)
            dhw = dh[:, w * FILTERS:(w + 1) * FILTERS]
            texts, filters = np.nonzero(dhw)
            for j in range(len(k)):
                g[j] = np.einsum("tf,tfd->df", dhw, m.embed(at[w][j]))
                buckets.append(at[w][j][texts, filters])
                moves.append(dhw[texts, filters][:, None] * k[j].T[filters])
            grads.append(g + 1e-4 * k)
        grads += [dh.sum(axis=0), a.T @ d + 1e-4 * m.out, np.array([d.sum()])]
        for p_, s_, g_ in zip(m.dense(), self.seen, grads, strict=True):
            s_ += g_ * g_
            p_ -= RATE * g_ / np.sqrt(s_)
        flat = np.concatenate(buckets).ravel()
        if not len(flat):
            return
        order = np.argsort(flat, kind="stable")
        met, first = np.unique(flat[order], return_index=True)
        g_ = np.add.reduceat(np.repeat(np.concatenate(moves), 4, axis=0)[order], first) + 1e-5 * m.emb[met]
        self.seen_words[met] += (g_ * g_).mean(axis=1)
        m.emb[met] -= RATE * g_ / np.sqrt(self.seen_words[met])[:, None]
        m.emb[BUCKETS] = 0  # the blank

    def changes(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of DIM parameters that moved, and how far: of the embedding by bucket, of the others from BUCKETS + 1 on."""
        met = np.flatnonzero(self.seen_words[:BUCKETS] != SEEN)
        moved = self.model.emb[met]
        rows = self.packed["rows"]  # in order
        if len(rows):
            at = np.minimum(np.searchsorted(rows, met), len(rows) - 1)
            moved = moved - np.where((rows[at] == met)[:, None], self.packed["emb"][at], 0)
        before = [*self.packed["kernel"], self.packed["bias"], self.packed["out"], self.packed["base"]]
        flat = np.concatenate([(p - b).ravel() for p, b in zip(self.model.dense(), before, strict=True)])
        flat = np.concatenate([flat, np.zeros(-len(flat) % DIM, np.float32)]).reshape(-1, DIM)
        return np.concatenate([met, BUCKETS + 1 + np.arange(len(flat))]), np.concatenate([moved, flat])


def _counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, and by fold (0, left out) and class the texts that have them: summed by Spark, one row a bucket."""
    columns = [f"n{fold}{y}" for fold in (0, 1) for y in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity learning", lambda: None)
        v, held = Texts(), np.zeros((4, BUCKETS + 1), np.int32)
        for b in batches:
            texts = b.column(0).to_pylist()
            kind = 2 * b.column(2).to_numpy() + b.column(1).to_numpy()
            for k in range(4):
                texts_of_buckets(v, [texts[i] for i in np.flatnonzero(kind == k)], held[k])
        met = np.flatnonzero(held[:, :BUCKETS].any(axis=0))
        for k in range(0, len(met), SENT_ROWS):
            some = met[k:k + SENT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(n[some].astype(np.int64)) for n in held]], ["bucket", *columns])

    each = rows.select("text", "label", "fold").mapInArrow(run, "bucket int, " + ", ".join(f"{c} long" for c in columns))
    got = each.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    return got.column("bucket").to_numpy().astype(np.int64), np.stack([got.column(c).to_numpy() for c in columns]).reshape(2, 2, -1)


def _round(rows: DataFrame, model: Cnn, weight: np.ndarray, number: int) -> None:
    """Every task learns from all its rows; the changes are averaged by the rows that they come from.

    A bucket's change is averaged over the tasks that have met it. Sums are of whole numbers, so that their order
    does not matter.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model.packed(), weight))
    columns = [f"d{k}" for k in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity learning", lambda: None)
        learner, v, rng = None, Texts(), np.random.default_rng(10 + number)
        for b in batches:
            learner = learner or Learner(*shared.value)
            b = b.take(pa.array(rng.permutation(b.num_rows)))
            learner.learn(v, b.column(0).to_pylist(), b.column(1).to_numpy().astype(np.int64))
        if learner and learner.rows:
            at, by = learner.changes()
            for k in range(0, len(at), SENT_ROWS):
                some = at[k:k + SENT_ROWS].astype(np.int32)
                moved = np.rint(by[k:k + SENT_ROWS].astype(float) * learner.rows * UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.full(len(some), learner.rows, np.int64)), *[pa.array(c) for c in moved.T]],
                                                 ["row", "n", *columns])

    each = rows.select("text", "label").mapInArrow(run, "row int, n long, " + ", ".join(f"{c} long" for c in columns))
    mean = each.groupBy("row").agg(*[(F.sum(c) / F.sum("n") / UNIT).cast("float").alias(c) for c in columns])
    got = mean.toArrow()  # at most one row of DIM numbers for each bucket met
    model.move(got.column("row").to_numpy().astype(np.int64), np.stack([got.column(c).to_numpy() for c in columns], axis=1))
    shared.destroy()


def _calibrated(rows: DataFrame, model: Cnn) -> None:
    """Thresholds from the rows: their logits are counted in narrow cells, which do not grow with the rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model.packed())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity learning", lambda: None)
        own, v = Cnn.unpacked(shared.value), Texts()
        for b in batches:
            z, langs = judged(own, v, b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(langs.astype(np.int32)), pa.array(np.clip(z, -30, 30)), b.column(1)], ["lang", "z", "label"])

    each = rows.select("text", "label").mapInArrow(run, "lang int, z double, label int")
    cells = each.groupBy("lang", F.floor(F.col("z") * CELLS).alias("cell")).agg(
        F.min("z").alias("low"), F.max("z").alias("high"), F.sum(1 - F.col("label")).alias("clean"), F.sum("label").alias("toxic"))
    got = cells.toArrow()  # at most 60 * CELLS rows a language
    model.calibrate(*[got.column(c).to_numpy() for c in ("lang", "low", "high", "clean", "toxic")])
    shared.destroy()


def fit(rows: DataFrame) -> dict | None:
    """A model from all rows (text, label, fold); None without rows of both labels.

    The model that stays learns from every row. The thresholds are set on the rows of fold 1, every fourth text, by a
    second model that learns in the same way and has not seen them. What reaches the driver is as large as the model.
    """
    n = np.zeros((2, 2), np.int64)  # by fold and class
    for r in rows.groupBy("fold", "label").count().collect():
        n[r["fold"], r["label"]] = r["count"]
    total = int(n.sum())
    if not n.sum(axis=0).all():
        return None
    rows = rows.coalesce(max(1, total // LEARNER_ROWS))
    buckets, held = _counted(rows)
    rounds = max(ROUNDS[0], min(ROUNDS[1], -(-VISITS // total)))

    def trained(some: DataFrame, folds: list[int]) -> Cnn:
        model, of_class = Cnn(), n[folds].sum(axis=0)
        model.start(buckets, held[folds].sum(axis=0), of_class)
        for number in range(rounds):
            _round(some, model, of_class.sum() / (2 * of_class), number)
        return model

    model = trained(rows, [0, 1])
    if n.all():
        trial = trained(rows.where("fold = 0"), [0])
        _calibrated(rows.where("fold = 1"), trial)
        model.shift = trial.shift
    else:
        _calibrated(rows, model)
    return model.packed()


_MODELS: dict[str, tuple[Cnn, Texts]] = {}


def score_texts(packed: dict, key: str, texts: list[str | None]) -> np.ndarray:
    """Scores of texts; the unpacked model and the vocabulary stay in the worker under ``key``."""
    enter("toxicity", _MODELS.clear)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Cnn.unpacked(packed), Texts()
    model, v = _MODELS[key]
    z, langs = judged(model, v, texts)
    return 1 / (1 + np.exp(-np.clip(z - model.shift[langs], -30, 30)))


def learn(docs: DataFrame, labels: DataFrame) -> dict | None:
    """A model from every document with a label that may be learnt from; None without such rows of both labels."""
    ship(docs.sparkSession)
    rows = labelled(docs, labels, "toxic")
    # Equal texts share a fold; rows are dealt and sorted by a hash, so that reruns agree.
    rows = rows.select("text", "label", (F.pmod(F.xxhash64("text"), F.lit(4)) == 3).cast("int").alias("fold"), F.xxhash64("doc_id").alias("_at"))
    model = fit(store(rows.sortWithinPartitions("_at", "text"), "toxicity-rows"))
    if model is None:
        warnings.warn("no labelled texts with toxic = 0 and toxic = 1: nothing to learn from, every row gets the same score", stacklevel=2)
    return model


def with_score(docs: DataFrame, model: dict | None, to: str = "__toxicity", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) and the score ``to``."""
    spark = docs.sparkSession
    ship(spark)
    keep = keep if keep is not None else docs.columns
    if model is None:
        return docs.select(*keep, F.lit(0.0).alias(to))
    # A text that is kept travels once.
    at = keep.index("text") if "text" in keep else len(keep)
    given = docs.select(*keep) if "text" in keep else docs.select(*keep, F.col("text").alias("__text"))
    shared = spark.sparkContext.broadcast(model)  # at most a row of 32 bytes for each bucket met in the labelled rows
    schema, key = docs.select(*keep).schema.add(to, "double"), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score_texts(shared.value, key, b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(s)], [*keep, to])

    return given.mapInArrow(run, schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    out = with_score(docs, learn(docs, labels), "score", ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not judged toxic, with their own columns."""
    return with_score(docs, learn(docs, labels)).where(F.col("__toxicity") < CUT).select(*docs.columns)
