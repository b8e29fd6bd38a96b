"""Operator 5: byte-level BPE encoding and decoding.

A text is cut into pieces by the tokenizer's pattern. Distinct pieces are laid
out as padded numpy matrices of byte tokens, bucketed by length; each round,
every row merges its leftmost pair of least rank (found by a hashed pair
lookup) and closes the gap; rows without a pair leave the matrix. A piece that
is itself a token needs no merge.

Pieces longer than ``MATRIX_BYTES`` (a matrix costs the square of its width)
are merged by a heap of pairs, with the same ties.

Edge cases: a null or empty text has no ids; repeated rows give equal results;
an empty table gives an empty result; other columns are ignored by
:func:`digests` and kept by :func:`encode` and :func:`decode`.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import STORE_BYTES, by_size, enter, ship

NONE = np.int32(2**31 - 1)
MATRIX_BYTES = 128
#: Most keys that a worker keeps, if their bytes do not bound them before.
CACHED = 600_000
#: Characters of texts that are encoded at once; a longer text goes by itself.
CHARS = 1 << 20
#: Bytes of a cached key besides its letters and ids.
KEY_BYTES = 140
#: White space other than the space and the line feed.
ODD_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PairTable:
    """(left id, right id) → id of the joined token; open addressing over numpy arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        key, value = np.array(keys, np.uint64), np.array(values, np.int32)
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE)
        self.steps = 0
        slot, left = self._slot(key), np.arange(len(key))
        while len(left):
            self.steps += 1
            free = self.keys[slot[left]] == np.uint64(2**64 - 1)
            want = left[free]
            _, first = np.unique(slot[want], return_index=True)
            put = want[first]
            self.keys[slot[put]], self.values[slot[put]] = key[put], value[put]
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Joined ids, NONE where there is none or an id is padding (below 0)."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32).astype(np.uint64)
        slot = self._slot(key)
        out = np.full(key.shape, NONE)
        seen = self.keys[slot]
        hit = seen == key
        out[hit] = self.values[slot[hit]]
        more = np.flatnonzero(~hit.ravel() & (seen.ravel() != np.uint64(2**64 - 1)))
        key, slot, flat = key.ravel()[more], slot.ravel()[more], out.ravel()
        while len(more):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot]
            hit = seen == key
            flat[more[hit]] = self.values[slot[hit]]
            on = ~hit & (seen != np.uint64(2**64 - 1))
            more, key, slot = more[on], key[on], slot[on]
        return flat.reshape(out.shape)


class Bpe:
    """Encoder and decoder over one rank file. Built once per Python worker; holds a bounded cache of pieces."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")
                                     .replace(r"\S", r"\P{White_Space}"))
        self.pairs = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for t, r in self.ranks.items():
            tokens[r] = t
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        said = [b"%d," % i for i in range(size)]
        self.said_starts = np.concatenate([[0], np.cumsum([len(t) for t in said])]).astype(np.int64)
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self._forget()

    def _forget(self) -> None:
        """An empty cache: the number of a key, and under that number where its ids lie in ``flat``."""
        self.cache: dict[str, int] = {}
        self.letters = 0
        self.first, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length, all at once."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        m = np.full((len(pieces), int(lengths.max())), -1, np.int32)
        m[np.arange(m.shape[1]) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rows, out = np.arange(len(pieces)), [None] * len(pieces)
        while len(rows):
            if m.shape[1] > 1:
                joined = self.pairs.find(m[:, :-1], m[:, 1:])
                at = joined.argmin(axis=1)  # the leftmost of the least
                best = joined[np.arange(len(rows)), at]
            else:
                best = np.full(len(rows), NONE)
            go = best != NONE
            ended = m[~go]
            n = (ended >= 0).sum(axis=1)
            for i, ids in zip(rows[~go], np.split(ended[ended >= 0], np.cumsum(n)[:-1]) if len(n) else [], strict=True):
                out[i] = ids
            if not go.any():
                break
            m, rows, at, best = m[go], rows[go], at[go], best[go]
            here = np.arange(len(rows))
            m[here, at] = best
            keep = np.ones(m.shape, bool)
            keep[here, at + 1] = False
            m = m[keep].reshape(len(rows), -1)
            width = int((m >= 0).sum(axis=1).max())  # drop columns that are padding in every row
            m = m[:, :width]
        return out

    def _heap(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: a heap of (rank, place) over a linked list."""
        ids = [int(self.byte_ids[b]) for b in piece]
        text = [piece[i:i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids) and (r := self.ranks.get(text[i] + text[j])) is not None:
                heapq.heappush(heap, (r, i, len(text[i]), len(text[j])))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if text[i] is None or len(text[i]) != a or j >= len(ids) or len(text[j]) != b:
                continue
            ids[i], text[i], text[j] = r, text[i] + text[j], None
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([x for x, t in zip(ids, text, strict=True) if t is not None], np.int32)

    def _pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of each piece."""
        found: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        raws = [p.encode() for p in pieces]
        for i, raw in enumerate(raws):
            if (r := self.ranks.get(raw)) is not None:
                found[i] = np.array([r], np.int32)
            elif len(raw) > MATRIX_BYTES:
                found[i] = self._heap(raw)
            else:
                buckets.setdefault((len(raw) + 3) // 4, []).append(i)
        for some in buckets.values():
            for k in range(0, len(some), 8192):
                part = some[k:k + 8192]
                for i, ids in zip(part, self._matrix([raws[i] for i in part]), strict=True):
                    found[i] = ids
        return found

    def _learn(self, keys: list[str]) -> None:
        """Put the ids of new keys in the cache."""
        cut = [self.pattern.findall(k[1:] if k[0] == " " else " " + k) for k in keys]
        pieces = list(dict.fromkeys(chain.from_iterable(cut)))
        at = dict(zip(pieces, range(len(pieces)), strict=True))
        found = self._pieces(pieces)
        start = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        flat = np.concatenate([np.zeros(0, np.int32), *found])
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        numbers = np.fromiter(map(at.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        n = start[numbers + 1] - start[numbers]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(counts)]
        have = len(self.cache)
        self.letters += sum(map(len, keys))
        self.cache.update(zip(keys, range(have, have + len(keys)), strict=True))
        self.first = np.concatenate([self.first, ends + len(self.flat)])
        self.flat = np.concatenate([self.flat, _gather(flat, start[numbers], n)])

    def _keys(self, text: str | None) -> list[str]:
        """Cache keys of a text: ``word`` stands for a space and what follows it up to the next, ``" " + x`` for x itself.

        No piece goes on beyond a lone space between two words, so a text is
        cut there; where spaces meet other white space, it is cut into the
        pattern's pieces.
        """
        if not text:
            return []
        if "  " in text or " \n" in text or "\n " in text or text[-1] == " " or ODD_SPACE.search(text):
            return [p[1:] if p[0] == " " and len(p) > 1 and p[1] != " " else " " + p for p in self.pattern.findall(text)]
        keys = text.split(" ")
        keys[0] = " " + keys[0]
        return keys

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        keys = [self._keys(t) for t in texts]
        counts = np.fromiter(map(len, keys), np.int64, len(keys))
        numbers = np.fromiter(map(self.cache.get, chain.from_iterable(keys), repeat(-1)), np.int64, int(counts.sum()))
        if (missing := np.flatnonzero(numbers < 0)).size:
            flat = list(chain.from_iterable(keys))
            new = list(dict.fromkeys([flat[i] for i in missing]))
            keys_after = len(self.cache) + len(new)
            if keys_after > CACHED or KEY_BYTES * keys_after + self.letters + self.flat.nbytes > STORE_BYTES:
                self._forget()
                new, missing = list(dict.fromkeys(flat)), np.arange(len(flat))
            self._learn(new)
            numbers[missing] = np.fromiter(map(self.cache.__getitem__, [flat[i] for i in missing]), np.int64, len(missing))
        n = self.first[numbers + 1] - self.first[numbers]
        ids = _gather(self.flat, self.first[numbers], n)
        upto = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ids, 65,536 tokens at a time."""
        parts = (ids[i:i + 65536] for i in range(0, len(ids), 65536))
        return b"".join(_gather(self.bytes, self.starts[p], self.starts[p + 1] - self.starts[p]).tobytes() for p in parts)

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        parts = (ids[i:i + 65536] for i in range(0, len(ids), 65536))
        return b"".join(_gather(self.said, self.said_starts[p], self.said_starts[p + 1] - self.said_starts[p]).tobytes() for p in parts)[:-1]


def _gather(flat: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """flat[start:start + n] of every run, end to end."""
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - n), n)]


_BUILT: dict[tuple[str, str], Bpe] = {}


def built(path: str, pattern: str) -> Bpe:
    enter("bpe", _BUILT.clear)  # first, so that what others keep is gone before the tables are built
    if (path, pattern) not in _BUILT:
        _BUILT[path, pattern] = Bpe(path, pattern)
    return _BUILT[path, pattern]


def _public() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", to: str = "ids") -> DataFrame:
    """Adds the column ``to``: array<int> of token ids. The rank file must be at ``path`` on every executor."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = built(*((path, pattern) if path else _public()))
        for b in batches:
            ids = pa.array(bpe.encode(b.column(text).to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], [*b.schema.names, to])

    return docs.drop(to).mapInArrow(run, docs.drop(to).schema.add(to, T.ArrayType(T.IntegerType())))


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the column ``to``: binary, the bytes of the tokens."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, pattern = _public()
        bpe = built(path or where, pattern)
        for b in batches:
            out = [bpe.decode(np.array(x or [], np.int32)) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, to])

    return rows.drop(to).mapInArrow(run, rows.drop(to).schema.add(to, T.BinaryType()))


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, encoded and decoded in one pass: only digests leave the worker."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = built(*((path, pattern) if path else _public()))
        for b in batches:
            n, said, back = [], [], []
            texts = b.column("text").to_pylist()
            for some in by_size(texts, CHARS):
                for ids in bpe.encode(texts[some]):
                    n.append(len(ids))
                    said.append(hashlib.sha256(bpe.decimals(ids)).hexdigest())
                    back.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(said, pa.string()), pa.array(back, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
