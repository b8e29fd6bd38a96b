"""Operator 13: fill-in-middle transformation by a wavelet matrix over character classes.

A unit is a word with the white space before it, or the white space that ends
a text. Each character becomes one of eight symbols: its kind (white space,
letter, digit, other) and whether it ends a unit. A wavelet matrix over the
symbols of many texts, end to end, answers rank queries (how often a symbol
occurs before a place) from packed bits and one running count per 64 of them;
the ranks of the symbols that end a unit add up to the number of boundaries
before a place. The two cuts of every text are found by bisection on that
number, all texts at a time.

A cut text becomes ``<P>``prefix``<S>``suffix``<M>``middle (psm) or
``<S>``suffix``<P>``prefix``<M>``middle (spm); which text, which form and
where follow from a hash of seed and doc_id, so reruns agree.

Edge cases: a null text counts as empty; texts that are empty or hold a
sentinel stay plain; a null doc_id is hashed as the empty string; rows with
equal ids draw equal numbers; an empty table gives an empty result. Other
columns are ignored by :func:`fill_in_middle` and kept by
:func:`transformed_documents`, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of 100 texts, so many are cut; of 100 of these, so many put the suffix first.
CUT, SUFFIX_FIRST = 50, 80
#: Characters that enter one matrix, unless a single text is longer.
TOGETHER = 1 << 20
#: Symbols: the kind of a character, plus ENDS where a unit ends.
WHITE, LETTER, DIGIT, OTHER, ENDS = 0, 1, 2, 3, 4
BITS = 3


def _kinds() -> np.ndarray:
    """Kinds of the ASCII characters, and of all others at the end."""
    kinds = np.full(129, OTHER, np.uint8)
    for kind, chars in ((WHITE, "\x20\t\n\x0b\x0c\r"), (DIGIT, "0123456789")):
        kinds[[ord(c) for c in chars]] = kind
    for first in "aA":
        kinds[ord(first):ord(first) + 26] = LETTER
    return kinds


KINDS = _kinds()


class Bits:
    """A bit vector with rank: 64-bit words and the number of ones before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)


class WaveletMatrix:
    """Sequence of ``bits``-bit symbols with rank of each symbol."""

    def __init__(self, symbols: np.ndarray, bits: int = BITS):
        self.length, self.bits, self.levels, self.zeros = len(symbols), bits, [], []
        for level in reversed(range(bits)):
            bit = (symbols >> level) & 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            # A stable partition: the zeros in their order, then the ones.
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.starts = [int(self._place(s, np.zeros(1, np.int64))[0]) for s in range(1 << bits)]

    def _place(self, symbol: int, i: np.ndarray) -> np.ndarray:
        for level, bits, zeros in zip(reversed(range(self.bits)), self.levels, self.zeros, strict=True):
            ones = bits.rank(i)
            i = zeros + ones if symbol >> level & 1 else i - ones
        return i

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before place i."""
        return self._place(symbol, i) - self.starts[symbol]


class Units:
    """Units of several texts: their numbers and the places where they end."""

    def __init__(self, texts: list[str]):
        size = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = KINDS[np.minimum(code, 128)]
        last = np.zeros(len(kind), bool)
        last[self.ends[size > 0] - 1] = True
        white = kind == WHITE
        # A word ends before white space; what ends a text ends a unit, white space too.
        ends = last.copy()
        ends[:-1] |= ~white[:-1] & white[1:]
        self.matrix = WaveletMatrix(kind + ENDS * ends.astype(np.uint8))
        self.base = self.boundaries(self.starts)
        self.counts = self.boundaries(self.ends) - self.base

    def boundaries(self, i: np.ndarray) -> np.ndarray:
        """Unit ends before place i: the ranks of all symbols that end one."""
        return sum(self.matrix.rank(kind + ENDS, i) for kind in (WHITE, LETTER, DIGIT, OTHER))

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Characters of each text up to the end of its k-th unit: the least place with so many boundaries before it."""
        low, high = self.starts.copy(), self.ends.copy()
        while (low < high).any():
            mid = (low + high) >> 1
            short = self.boundaries(mid) - self.base < k
            low, high = np.where(short & (low < high), mid + 1, low), np.where(short, high, mid)
        return low - self.starts


def draws(doc_id: object, seed: object = SEED) -> list[int]:
    """Four numbers below 2^32 from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def _together(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about TOGETHER characters."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > TOGETHER:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def transform(ids: list, texts: list[str], seed: object = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> list[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of every text."""
    h = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    units = Units(texts)
    one, two = h[:, 0] % (units.counts + 1), h[:, 1] % (units.counts + 1)
    first, second = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
    out = []
    for i, t in enumerate(texts):
        n, a, b = int(units.counts[i]), int(first[i]), int(second[i])
        if not t or h[i, 2] % 100 >= cut or any(s in t for s in (PREFIX, SUFFIX, MIDDLE)):
            out.append((n, "plain", None, None, t))
        elif h[i, 3] % 100 < suffix_first:
            out.append((n, "spm", a, b - a, "".join((SUFFIX, t[b:], PREFIX, t[:a], MIDDLE, t[a:b]))))
        else:
            out.append((n, "psm", a, b - a, "".join((PREFIX, t[:a], SUFFIX, t[b:], MIDDLE, t[a:b]))))
    return out


def fill_in_middle(docs: DataFrame, seed: object = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output, map-side only."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc_id"), [t or "" for t in b.column("text").to_pylist()]
            for some in _together(texts):
                at = range(len(texts))[some]
                rows = transform(ids[at.start:at.stop].to_pylist(), texts[some], seed, cut, suffix_first)
                n, form, prefix, middle, out = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids[at.start:at.stop], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(out, pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def transformed_documents(docs: DataFrame, seed: object = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """The documents as given, each text replaced by its output (a null text stays null)."""
    ship(docs.sparkSession)
    place, id_place = docs.columns.index("text"), docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, given = b.column(id_place).to_pylist(), b.column(place).to_pylist()
            out: list = []
            for some in _together([t or "" for t in given]):
                out += [r[4] for r in transform(ids[some], [t or "" for t in given[some]], seed, cut, suffix_first)]
            out = [o if t is not None else None for o, t in zip(out, given, strict=True)]
            yield b.set_column(place, "text", pa.array(out, pa.string()))

    return docs.mapInArrow(run, docs.schema)


def restored(output: Column, form: Column) -> Column:
    """The text as it was, from output and form: the parts between the sentinels, which no cut text holds itself."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256."""
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


INFILL_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
d AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM h),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
             coalesce(array_to_string(units[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
