"""Operator 12: hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are turned into whole numbers; a row's score is its exact inner
product with the anchor. All rows are written in the order of a Hilbert curve
through eight fixed projections, as Parquet rows of up to ``BLOCK`` vectors, each
block with the least and greatest number of every dimension (its zone map).
For an anchor, interval arithmetic over a zone map bounds all scores in the
block from both sides, which tells whether it must be read:

* for the positives, if it may hold a row of the anchor's label that comes
  before the fifth best of the anchor's own block;
* for the negatives, if its bounds meet a window of scores that one of the
  positives opens, above the fifth best that the own block has in the window.

Anchors go in chunks of neighbours on the curve. A chunk meets a block once,
for those of its anchors that must read it, and a task keeps the best rows of
each window over all blocks it sees. No row is left out by a limit: a block is
skipped only where its bounds prove that it cannot matter. Anchors are a stated
share of all rows, and where vectors have no structure every block may matter
to every anchor, so the work then grows with anchors times rows.

Edge cases: rows with a null id, a null label, a null vector or a null or
non-finite component take no part, nor do rows with a component beyond
``MOST`` (scores would not fit into 64 bits); a shorter vector counts as if
zeros followed; rows with equal ids or equal vectors all take part, each
anchor row for itself; ties go by id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import running_totals, ship, store

UNIT = 256
POSITIVES = NEGATIVES = 5
#: A negative has at least this share (per cent) of its positive's score, and no more than all of it.
LEAST_SHARE = 80
BLOCK, CHUNK, ZONES = 512, 256, 64
#: The curve: so many projections, of so many bits each.
AXES, AXIS_BITS = 8, 7
SEED = 12
#: Components of quantised vectors lie below this.
MOST = 1 << 26
#: Scores of the anchor's own block that are kept to begin the windows with.
HOME = 32
BROADCAST_BYTES = 32 << 20


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below 2^bits, one point a row."""
    x = x.astype(np.int64).copy()
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(x.shape[1]):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(on, p, swap)
            x[:, i] ^= swap
    for i in range(1, x.shape[1]):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> b & 1, (1 << b) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(x.shape[1]):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


def quantised(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their whole numbers, one row each, zeros behind shorter vectors)."""
    size = np.array([0 if s is None else s for s in vectors.value_lengths().to_pylist()], np.int64)
    flat = vectors.flatten()
    value = np.floor(UNIT * flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64))
    row = np.repeat(np.arange(len(size)), size)
    bad = np.zeros(len(size), bool)
    bad[row[~(np.abs(value) < MOST)]] = True
    bad |= vectors.is_null().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), dim), np.int64)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    fine = ~bad[row]
    out[row[fine], place[fine]] = value[fine]
    use = np.flatnonzero(~bad)
    return use, out[use]


def _clean(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").try_cast("long").alias("vec_id"), F.col("label").try_cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding")).where(
        "vec_id is not null and label is not null and embedding is not null")


class Shape:
    """What all tasks agree on: dimensions, the spread of the vectors, and whether floats hold every score."""

    def __init__(self, rows: DataFrame):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                e = b.column("embedding")
                dim = max((s or 0 for s in e.value_lengths().to_pylist()), default=0)
                _, q = quantised(e, dim)
                yield pa.RecordBatch.from_pydict({"dim": [dim], "n": [len(q)], "most": [int(np.abs(q).max(initial=0))],
                                                  "squares": [float((q.astype(np.float64) ** 2).sum())]})

        r = rows.select("embedding").mapInArrow(run, "dim long, n long, most long, squares double").agg(
            F.max("dim"), F.sum("n"), F.max("most"), F.sum("squares")).first()
        self.dim, self.rows, most = int(r[0] or 0), int(r[1] or 0), int(r[2] or 0)
        # A projection on a unit direction has this deviation, as far as the vectors have no preferred direction.
        self.spread = float(np.sqrt((r[3] or 0) / max(1, self.rows * self.dim))) or 1.0
        self.exact = most * most * max(1, self.dim) < 2**53

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of all rows: exact, as floats where these hold them."""
        return a.astype(np.float64) @ b.T.astype(np.float64) if self.exact else a.astype(np.int64) @ b.T.astype(np.int64)

    def bounds(self, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each anchor may have in each block."""
        a, low, high = (x.astype(np.float64) for x in (a, low, high))
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
        if not self.exact:
            slack = 1e-9 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T) + 1
            least, most = least - slack, most + slack
        return least, most


def _blocks(rows: DataFrame, shape: Shape) -> DataFrame:
    """block, ids, labels, q (whole numbers of the rows, in the order of the curve), low, high (zone map), label_low, label_high."""
    dim, spread = shape.dim, shape.spread
    axes = np.linalg.qr(np.random.default_rng(SEED).normal(size=(max(dim, AXES), AXES)))[0][:dim]

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            use, q = quantised(b.column("embedding"), dim)
            ids, labels = (b.column(c).to_numpy()[use] for c in ("vec_id", "label"))
            labels = np.where(ids % 7 == 0, (labels + 1) % 10, labels)
            cells = 1 << AXIS_BITS
            place = np.floor((q @ axes / spread + 3) / 6 * cells)  # three deviations to both sides
            k = hilbert(np.clip(place, 0, cells - 1), AXIS_BITS)
            raw = [r.tobytes() for r in q.astype("<i4")]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(labels), pa.array(k), pa.array(raw, pa.binary())], ["vec_id", "label", "key", "q"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, rest = TaskContext.get().partitionId(), 0, None
        for b in _and_none(batches):
            held = [x for x in (rest, b) if x is not None]
            if not held:
                return
            t = pa.Table.from_batches(held).combine_chunks()
            whole = t.num_rows - (t.num_rows % BLOCK if b is not None else 0)
            for i in range(0, whole, BLOCK):
                s = t.slice(i, min(BLOCK, whole - i))
                q = np.frombuffer(b"".join(s.column("q").to_pylist()), "<i4").reshape(s.num_rows, dim)
                ids, labels = (s.column(c).to_numpy() for c in ("vec_id", "label"))
                yield pa.RecordBatch.from_pydict({
                    "block": [part << 32 | number], "ids": [ids.astype("<i8").tobytes()], "labels": [labels.astype("<i8").tobytes()], "q": [q.tobytes()],
                    "low": [q.min(axis=0).tobytes()], "high": [q.max(axis=0).tobytes()], "label_low": [int(labels.min())], "label_high": [int(labels.max())]})
                number += 1
            left = t.slice(whole).combine_chunks().to_batches()
            rest = left[0] if left else None

    keyed = rows.mapInArrow(key, "vec_id long, label long, key long, q binary")
    ordered = keyed.repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id")
    return store(ordered.mapInArrow(
        pack, "block long, ids binary, labels binary, q binary, low binary, high binary, label_low long, label_high long"), "hard-blocks")


def _and_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _ints(raw: bytes, kind: str, dim: int | None = None) -> np.ndarray:
    a = np.frombuffer(raw, kind)
    return a if dim is None else a.reshape(-1, dim)


def _best(scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, score, id) of the first k allowed columns of each row: higher scores first, then smaller ids."""
    none = -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min
    s = np.where(ok, scores, none)
    if s.shape[1] > k:  # all that reach the k-th best
        ok = ok & (s >= np.partition(s, s.shape[1] - k, axis=1)[:, [s.shape[1] - k]])
    row, col = np.nonzero(ok)
    score, name = scores[row, col].astype(np.int64), ids[col]
    return _first(row, score, name, k)


def _first(row: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((name, -score, row))
    row, score, name = row[order], score[order], name[order]
    start = np.searchsorted(row, row)
    use = np.arange(len(row)) - start < k
    return row[use], score[use], name[use]


def _anchors(blocks: DataFrame, shape: Shape, every: int) -> DataFrame:
    """place (dense, along the curve), anchor_id, label, home (its block), q, and of its block: the best positives, the best scores of negatives."""
    dim = shape.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, labels, q = _ints(r["ids"], "<i8"), _ints(r["labels"], "<i8"), _ints(r["q"], "<i4", dim)
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                s = shape.scores(q[at], q)
                same = labels[at][:, None] == labels
                other = ~same
                same[np.arange(len(at)), at] = False
                row, score, name = _best(s, same, ids, POSITIVES)
                far, hard, _ = _best(s, other, ids, HOME)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), r["block"])), pa.array(at.astype(np.int64)), pa.array(ids[at]), pa.array(labels[at]),
                    pa.array([q[i].tobytes() for i in at], pa.binary()), pa.array([score[row == i].tolist() for i in range(len(at))], pa.list_(pa.int64())),
                    pa.array([name[row == i].tolist() for i in range(len(at))], pa.list_(pa.int64())),
                    pa.array([hard[far == i].tolist() for i in range(len(at))], pa.list_(pa.int64()))],
                    ["home", "at", "anchor_id", "label", "q", "near_scores", "near_ids", "far_scores"])

    found = blocks.select("block", "ids", "labels", "q").mapInArrow(
        run, "home long, at long, anchor_id long, label long, q binary, near_scores array<long>, near_ids array<long>, far_scores array<long>")
    found = running_totals(found.withColumn("one", F.lit(1).cast("long")), ["home", "at"], ["one"], "hard-anchors")
    return store(found.withColumnRenamed("one_before", "place").drop("one", "at"), "hard-anchors")


def _chunks(anchors: DataFrame) -> DataFrame:
    """Rows of up to CHUNK neighbouring anchors, as one array of structs."""
    members = F.array_sort(F.collect_list(F.struct("place", *[c for c in anchors.columns if c != "place"])))
    return store(anchors.groupBy(F.floor(F.col("place") / CHUNK).cast("long").alias("chunk")).agg(members.alias("anchors")), "hard-chunks")


def _zones(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Rows of up to ZONES zone maps, numbered from 0, and how many there are."""
    z = running_totals(blocks.select("block", "low", "high", "label_low", "label_high", F.lit(1).cast("long").alias("one")), ["block"], ["one"], "hard-zones")
    z = z.groupBy(F.floor(F.col("one_before") / ZONES).cast("long").alias("zone")).agg(
        F.collect_list(F.struct("block", "low", "high", "label_low", "label_high")).alias("maps"))
    z = store(z, "hard-zones")
    return z, z.count()


def _chosen(chunks: DataFrame, zones: DataFrame, n_zones: int, shape: Shape, needed) -> DataFrame:
    """(chunk, block, need): which anchors of a chunk (bits) must read which block, by the bounds of its zone map."""
    dim = shape.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                a, z = r["anchors"], r["maps"]
                q = _ints(b"".join(x["q"] for x in a), "<i4", dim)
                low, high = (_ints(b"".join(x[c] for x in z), "<i4", dim) for c in ("low", "high"))
                least, most = shape.bounds(q, low, high)
                number, label_low, label_high = (np.array([x[c] for x in z], np.int64) for c in ("block", "label_low", "label_high"))
                need = needed(a, least, most, number, label_low, label_high)
                some = np.flatnonzero(need.any(axis=0))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(some), r["chunk"], np.int64)), pa.array(number[some]),
                    pa.array([np.packbits(need[:, j]).tobytes() for j in some], pa.binary())], ["chunk", "block", "need"])

    # Every chunk meets every row of zone maps: anchors are a stated set of queries, zone maps a small part of the table.
    dealt = chunks.withColumn("zone", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_zones - 1).cast("long"))))
    return store(dealt.join(zones, "zone").mapInArrow(run, "chunk long, block long, need binary"), "hard-chosen")


def _scanned(chosen: DataFrame, blocks: DataFrame, chunks: DataFrame, n_anchors: int, shape: Shape, wanted, k: int) -> DataFrame:
    """(place, window, score, id): the first k rows of every window among the chosen blocks."""
    dim, spark = shape.dim, blocks.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for window, (row, score, ids) in kept.items():
                row, score, ids = _first(row, score, ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.full(len(row), window, np.int64)), pa.array(score), pa.array(ids)],
                                                 ["place", "window", "score", "id"])
            kept.clear()

        for b in batches:
            for r in b.to_pylist():
                need = np.flatnonzero(np.unpackbits(np.frombuffer(r["need"], np.uint8))[:len(r["anchors"])])
                a = [r["anchors"][i] for i in need]
                ids, labels = _ints(r["ids"], "<i8"), _ints(r["labels"], "<i8")
                scores = shape.scores(_ints(b"".join(x["q"] for x in a), "<i4", dim), _ints(r["q"], "<i4", dim))
                place = np.array([x["place"] for x in a], np.int64)
                same = np.array([x["label"] for x in a], np.int64)[:, None] == labels
                for window, ok in wanted(a, scores, same):
                    row, score, names = _best(scores, ok, ids, k)
                    got = (place[row], score, names)
                    old = kept.get(window)
                    got = got if old is None else tuple(np.concatenate(x) for x in zip(old, got, strict=True))
                    kept[window] = got if len(got[0]) < 50_000 else _first(*got, k)
                if sum(len(x[0]) for x in kept.values()) > 400_000:  # best rows of very many anchors
                    yield from emit()
        yield from emit()

    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    small = n_anchors * (4 * dim + 600) <= BROADCAST_BYTES
    both = chosen.repartition(n, "block").join(blocks.select("block", "ids", "labels", "q"), "block")
    both = both.join(F.broadcast(chunks) if small else chunks, "chunk")
    return both.select("need", "anchors", "ids", "labels", "q").mapInArrow(run, "place long, window long, score long, id long")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The first k rows of each (place, window), with their rank; tasks have cut to k before."""
    order = Window.partitionBy("place", "window").orderBy(F.desc("score"), F.asc("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = _clean(vectors)
    shape = Shape(rows)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not shape.rows or not shape.dim:
        # Vectors without a component score 0 with everything; such a table has nothing to order.
        shape.dim = max(1, shape.dim)
    blocks = _blocks(rows, shape)
    anchors = _anchors(blocks, shape, every)
    n_anchors = anchors.count()
    if not n_anchors:
        return spark.createDataFrame([], out)
    zones, n_zones = _zones(blocks)
    chunks = _chunks(anchors)

    def needs_positive(a, least, most, number, label_low, label_high):
        fifth = np.array([x["near_scores"][POSITIVES - 1] if len(x["near_scores"]) == POSITIVES else -np.inf for x in a])
        label, home = (np.array([x[c] for x in a], np.int64)[:, None] for c in ("label", "home"))
        return (most >= fifth[:, None]) & (label_low <= label) & (label <= label_high) & (home != number)

    def wants_positive(a, scores, same):
        yield 0, same

    chosen = _chosen(chunks, zones, n_zones, shape, needs_positive)
    found = _scanned(chosen, blocks, chunks, n_anchors, shape, wants_positive, POSITIVES)
    near = anchors.select("place", F.explode(F.arrays_zip("near_scores", "near_ids")).alias("x")).select(
        "place", F.lit(0).cast("long").alias("window"), F.col("x.near_scores").alias("score"), F.col("x.near_ids").alias("id"))
    positives = store(_ranked(near.unionByName(found), POSITIVES).drop("window"), "hard-positives")

    # A window begins at ceil(share * score), for shares of whole per cents without overflow, and ends at the score.
    first = F.col("score") - F.expr(f"cast(floor(cast(score as decimal(38, 0)) * {100 - LEAST_SHARE} / 100) as long)")
    windows = positives.where("score >= 0").select("place", F.struct(F.col("rank").alias("window"), first.alias("first"), F.col("score").alias("last")).alias("w"))
    windows = windows.groupBy("place").agg(F.array_sort(F.collect_list("w")).alias("windows"))
    chunks = _chunks(anchors.drop("near_scores", "near_ids").join(windows, "place"))

    def needs_negative(a, least, most, number, label_low, label_high):
        label = np.array([x["label"] for x in a], np.int64)[:, None]
        need = np.zeros(most.shape, bool)
        for i, x in enumerate(a):
            far = np.array(x["far_scores"], np.int64)
            for w in x["windows"]:
                inside = far[(far >= w["first"]) & (far <= w["last"])]
                begin = inside[NEGATIVES - 1] if len(inside) >= NEGATIVES else w["first"]
                need[i] |= (most[i] >= begin) & (least[i] <= w["last"])
        return need & ~((label_low == label) & (label_high == label))

    def wants_negative(a, scores, same):
        for j in range(POSITIVES):
            window = np.array([(x["windows"][j]["window"], x["windows"][j]["first"], x["windows"][j]["last"]) if j < len(x["windows"]) else (0, 1, 0) for x in a])
            ok = ~same & (scores >= window[:, [1]]) & (scores <= window[:, [2]])
            for number in np.unique(window[:, 0]):
                if number:
                    yield int(number), ok & (window[:, [0]] == number)

    chosen = _chosen(chunks, zones, n_zones, shape, needs_negative)
    found = _ranked(_scanned(chosen, blocks, chunks, n_anchors, shape, wants_negative, NEGATIVES), NEGATIVES)
    by = positives.select("place", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (found.join(by, ["place", "window"]).join(anchors.select("place", "anchor_id"), "place")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
