"""Operator 7: quality by a factorisation machine.

A text is a sparse vector: its hashed words by their share, and the binned
values of structure statistics and metadata (its length). The score is
w0 + sum w x + the pairwise interactions, each pair weighted by the dot product
of two low-rank vectors, computed in linear time as half of (sum v x)^2 less
sum (v x)^2. Trained in numpy on a bounded labelled sample and calibrated so
that the cut lies between the classes.

Edge cases: a null or empty text is scored by its statistics alone (all 0); a
null id counts as held out; repeated rows score alike; without labels of both
kinds every score is 1 (nothing is rejected); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .labelled import held_out, sample

#: The most labelled rows learnt from, by label.
PER_CLASS = {0: 1500, 1: 3000}
BUCKETS = 1 << 18
RANK = 4
BINS = 16
EPOCHS = 8
CUT = 0.3
CACHED = 400_000
STATS = ("log_chars", "log_words", "symbols", "digits", "spaces", "stops", "exclaims", "non_ascii", "word_length", "distinct_lines",
         "line_length", "upper_words", "marked_words", "capital_words", "distinct_words", "commonest_word")
SIZE = BUCKETS + len(STATS) * BINS


def statistics(text: str, words: list[str]) -> list[float]:
    """What is counted on the text; the statistics of single words are added by :meth:`Reader.words`."""
    n, k = max(1, len(text)), max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    has = text.count
    return [np.log1p(len(text)), np.log1p(len(words)), sum(map(has, "#*$%&|<>{}[]\\^~=_")) / n, sum(map(has, "0123456789")) / n,
            (has(" ") + has("\n")) / n, (has(".") + has(",")) / k, (has("!") + has("?")) / k, (len(text.encode()) - len(text)) / n,
            sum(map(len, words)) / k, len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines)))]


def _code(word: str) -> int:
    """Bucket, and above it a bit each for: all upper case, ends in a mark, begins in upper case."""
    flags = word.isupper() | (not word[-1].isalnum()) << 1 | word[0].isupper() << 2
    return xxhash.xxh3_64_intdigest(word.lower()) % BUCKETS + flags * BUCKETS


class Reader:
    """Texts as sparse rows; keeps the buckets of a bounded number of words."""

    def __init__(self, edges: np.ndarray | None = None):
        self.code: dict[str, int] = {}
        self.edges = edges  # (statistic, BINS - 1): where bins end

    def words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, bucket) as one number each, how often, words of each text, statistics of each text."""
        cut = [t.split() if t else [] for t in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = list(chain.from_iterable(cut))
        codes = np.fromiter(map(self.code.get, flat, repeat(-1)), np.int64, len(flat))
        if (missing := np.flatnonzero(codes < 0)).size:
            if len(self.code) > CACHED:
                self.code = {}
            new = [flat[i] for i in missing]
            self.code.update({w: _code(w) for w in set(new)})
            codes[missing] = np.fromiter(map(self.code.__getitem__, new), np.int64, len(new))
        row, ids, flags = np.repeat(np.arange(len(cut)), sizes), codes % BUCKETS, codes // BUCKETS
        key, count = np.unique(row * BUCKETS + ids, return_counts=True)
        most = np.zeros(len(cut))
        np.maximum.at(most, key // BUCKETS, count)
        n = len(cut)
        per_word = [np.bincount(row, (flags >> k) & 1, n) for k in range(3)] + [np.bincount(key // BUCKETS, minlength=n), most]
        of_text = np.array([statistics(t or "", w) for t, w in zip(texts, cut, strict=True)])
        stats = np.concatenate([of_text.reshape(n, len(STATS) - 5), np.stack(per_word, axis=1) / np.maximum(1, sizes)[:, None]], axis=1)
        return key, count, sizes, stats

    def rows(self, key: np.ndarray, count: np.ndarray, sizes: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, values and row of each entry, ordered by row: words by the root of their share, one bin of each statistic."""
        n = len(sizes)
        row = key // BUCKETS
        value = np.sqrt(count / sizes[row]) if len(row) else np.zeros(0)
        bins = np.stack([np.searchsorted(self.edges[k], stats[:, k], side="right") for k in range(len(STATS))], axis=1)
        own = BUCKETS + np.arange(len(STATS)) * BINS + bins
        feature = np.concatenate([key % BUCKETS, own.ravel()])
        value = np.concatenate([value, np.ones(own.size)])
        row = np.concatenate([row, np.repeat(np.arange(n), len(STATS))])
        order = np.argsort(row, kind="stable")
        return feature[order], value[order], row[order]


class Machine:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w0, self.w = 0.0, np.zeros(SIZE)
        self.v = rng.normal(0, 0.02, (SIZE, RANK))
        self.shift = 0.0

    def score(self, feature: np.ndarray, value: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores and the sums of v x of n rows; every row has entries."""
        if not n:
            return np.zeros(0), np.zeros((0, RANK))
        starts = np.searchsorted(row, np.arange(n))
        vx = self.v[feature] * value[:, None]
        total = np.add.reduceat(vx, starts)
        pairs = 0.5 * (total**2 - np.add.reduceat(vx * vx, starts)).sum(axis=1)
        return self.w0 + np.add.reduceat(self.w[feature] * value, starts) + pairs, total

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, size: int = 64, decay: float = 1e-4) -> None:
        rng = np.random.default_rng(8)
        sw, sv = np.full(SIZE, 1e-3), np.full((SIZE, RANK), 1e-3)
        weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // size)):
                feature = np.concatenate([rows[i][0] for i in part])
                value = np.concatenate([rows[i][1] for i in part])
                row = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
                z, total = self.score(feature, value, row, len(part))
                d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * weight[part] / len(part)
                self.w0 -= rate * d.sum()
                at, back = np.unique(feature, return_inverse=True)
                gw, gv = np.zeros(len(at)), np.zeros((len(at), RANK))
                np.add.at(gw, back, d[row] * value)
                np.add.at(gv, back, d[row, None] * value[:, None] * (total[row] - self.v[feature] * value[:, None]))
                gw += decay * self.w[at]
                gv += decay * self.v[at]
                sw[at] += gw * gw
                sv[at] += gv * gv
                self.w[at] -= rate * gw / np.sqrt(sw[at])
                self.v[at] -= 0.2 * rate * gv / np.sqrt(sv[at])


def fit(rows: list[tuple[str, int]]) -> tuple[Machine, np.ndarray] | None:
    """A model and the bins of the statistics; None without rows of both labels."""
    y = np.array([label for _, label in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    r = Reader()
    read = r.words([t for t, _ in rows])
    r.edges = np.quantile(read[-1], np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    feature, value, row = r.rows(*read)
    bounds = np.searchsorted(row, np.arange(len(rows) + 1))
    each = [(feature[a:b], value[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    # The cut is set on every fourth row, by a model that has not seen them; the model that stays learns from all.
    check = np.arange(len(rows)) % 4 == 3
    shift = 0.0
    if len(set(y[check].tolist())) == 2 and len(set(y[~check].tolist())) == 2:
        trial = Machine()
        trial.train([each[i] for i in np.flatnonzero(~check)], y[~check])
        some = np.flatnonzero(check)
        z = trial.score(np.concatenate([each[i][0] for i in some]), np.concatenate([each[i][1] for i in some]),
                        np.repeat(np.arange(len(some)), [len(each[i][0]) for i in some]), len(some))[0]
        order = np.argsort(z)
        z, t = z[order], y[check][order]
        wrong = np.concatenate([[0], np.cumsum(t == 1)]) + (t == 0).sum() - np.concatenate([[0], np.cumsum(t == 0)])
        best = np.flatnonzero(wrong == wrong.min())
        best = best[len(best) // 2]
        low, high = z[best - 1] if best else z[0] - 1, z[best] if best < len(z) else z[-1] + 1
        shift = float((low + high) / 2)
    model = Machine()
    model.train(each, y)
    model.shift = shift - np.log(CUT / (1 - CUT))  # the middle between the classes scores CUT
    return model, r.edges


_READERS: dict[str, Reader] = {}


def score_texts(model: Machine, edges: np.ndarray, key: str, texts: list[str | None]) -> np.ndarray:
    if key not in _READERS:
        _READERS.clear()
        _READERS[key] = Reader(edges)
    r = _READERS[key]
    z = model.score(*r.rows(*r.words(texts)), len(texts))[0] - model.shift
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    spark = docs.sparkSession
    ship(spark)
    fitted = fit(sample(docs, labels, "quality", PER_CLASS))
    if fitted is None:
        out = docs.select("doc_id", F.lit(1.0).alias("score"))
    else:
        model, edges = fitted
        model.w, model.v = model.w.astype(np.float32), model.v.astype(np.float32)
        shared = spark.sparkContext.broadcast((model, edges))  # 20 bytes a feature, whatever the data

        key = uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                s = score_texts(*shared.value, key, b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

        out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
