"""Operator 10: near duplicates among embeddings by E8 lattice hashing.

In each of several tables, a unit vector is projected by random orthonormal
directions to blocks of 8 numbers, scaled, shifted and each decoded to the
nearest point of the E8 lattice; the points of all blocks name the cell, and the
neighbouring cells that are nearly as close are probed too. The more vectors a
label has, the finer the cells (:data:`LADDER`), so that what a vector meets
by chance does not grow with the table. Vectors of one label that meet in a cell
of any table are compared by their cosine in double precision. Equal vectors of
a label enter once, with their number, under a number of their own: several
vectors, in one label or in several, may stand under one id. A pair that meets more than once counts in its first meeting place,
so links are counted without ever being listed; what leaves a block of
comparisons is a count per vector and a spanning set of links.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
numbers, and vectors without a label, link with nothing, as do vectors of
different lengths; rows with a null id are returned by themselves; repeated
rows link with one another; an id on several vectors gives a row for each, with
that vector's own links and component; ids may be of any type that sorts; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, running_totals, ship, spanning, store

COSINE = 0.98
#: (vectors of a label at most, blocks of a key, lattice units per unit length, tables, probes), the last for any more.
#: Measured on random vectors of 32 to 384 dimensions: a pair at cosine 0.98 meets in one table with probability
#: 0.82, 0.80, 0.70, 0.57, 0.43, in any with 0.9998 or more; two random vectors with 2^-14, -18, -21, -28 and under -31.
LADDER = ((1 << 17, 2, 1.5, 6, 3), (1 << 21, 2, 1.9, 7, 4), (1 << 24, 2, 2.2, 9, 4), (1 << 31, 3, 1.8, 12, 4), (None, 4, 1.8, 18, 5))
SEED = 20
BLOCK = 512
NO_KEY = np.iinfo(np.int64).max


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    if len(odd):
        off = x[odd] - r[odd]
        at = np.abs(off).argmax(axis=1)
        r[odd, at] += np.where(off[np.arange(len(odd)), at] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: whole or all-half coordinates of even sum."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    far = ((x - a) ** 2).sum(axis=1) > ((x - b) ** 2).sum(axis=1)
    return np.where(far[:, None], b, a)


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        v = np.where((bits >> np.arange(8)) & 1, 0.5, -0.5)
        if v.sum() % 2 == 0:
            out.append(v)
    return np.array(out)


ROOTS = _roots()


def step(n: int) -> tuple[int, float, int, int]:
    """Blocks, scale, tables and probes for labels of at most n vectors."""
    return next(how for most, *how in LADDER if most is None or n <= most)


def _frames(dim: int, tables: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Per table: 8 orthonormal directions a block and a shift."""
    rng = np.random.default_rng(SEED)
    width, frames = 8 * blocks, []
    for _ in range(tables):
        q, _ = np.linalg.qr(rng.standard_normal((max(dim, width), width)))
        frames.append(q[:dim] * np.sqrt(max(dim, width) / 8))
    return np.array(frames), rng.uniform(0, 1, (tables, width))


def cells(unit: np.ndarray, blocks: int, scale: float, tables: int, probes: int) -> np.ndarray:
    """(rows, tables, probes) 64-bit keys: the own cell first, then the nearest of those with one block's point changed to a neighbour."""
    n = len(unit)
    frames, shift = _frames(unit.shape[1], tables, blocks)
    out = np.zeros((n, tables, probes), np.int64)
    mult = np.random.default_rng(SEED + 1).integers(1, 1 << 62, (tables, 8 * blocks), dtype=np.int64) | 1
    roots = np.rint(ROOTS * 2).astype(np.int64)
    for t in range(tables):
        x = (unit @ frames[t] * scale + shift[t]).reshape(-1, 8)
        home = nearest_e8(x)
        # The neighbour home + r is nearer the larger (x - home).r is; all roots are equally long.
        order = np.argsort(-((x - home) @ ROOTS.T).reshape(n, -1), axis=1, kind="stable")[:, :probes - 1]
        own = (np.rint(home * 2).astype(np.int64).reshape(n, -1) * mult[t]).sum(axis=1)[:, None]
        change = (roots[None] * mult[t].reshape(blocks, 1, 8)).sum(axis=2).ravel()
        key = np.concatenate([own, own + change[order]], axis=1) + t
        out[:, t] = key ^ (key >> 31)
    return out


def _prepare(vectors: DataFrame) -> DataFrame:
    """Usable vectors, equal ones of a label as one: node (place in order of the ids), id (the least), n, label, vec."""
    v = vectors.where("vec_id is not null and label is not null and embedding is not null")
    ok = F.size("embedding") > 0
    ok = ok & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    v = v.where(F.coalesce(ok, F.lit(False)))
    reps = store(v.groupBy("label", F.col("embedding").alias("vec")).agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "vec-equal")
    reps = reps.withColumns({"hash": F.xxhash64("vec"), "node": F.lit(1).cast("long")})
    reps = running_totals(reps, ["id", "label", "hash"], ["node"], "vec-order")
    return reps.select(F.col("node_before").alias("node"), "id", "n", "label", "vec")


def _kind(reps: DataFrame):
    """The vectors travel in the precision in which they are stored."""
    return np.float32 if reps.schema["vec"].dataType.elementType.simpleString() == "float" else np.float64


def _dealt(reps: DataFrame, how: tuple) -> DataFrame:
    """One row per vector: node, n, label, dim, vec, keys (of all tables), cells."""
    kind = _kind(reps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("vec").to_pylist()
            dims = np.array([len(x) for x in lists])
            for d in np.unique(dims):
                some = np.flatnonzero(dims == d)
                raw = np.array([lists[i] for i in some], np.float64)
                key = cells(_unit(raw), *how)
                t = b.take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [t.column("node"), t.column("n"), t.column("label"), pa.array(np.full(len(some), d, np.int32)),
                     pa.array([x.tobytes() for x in raw.astype(kind)], pa.binary()), pa.array([k.tobytes() for k in key], pa.binary()),
                     pa.array([k.ravel() for k in key], pa.list_(pa.int64()))],
                    ["node", "n", "label", "dim", "vec", "keys", "cells"])

    label = reps.schema["label"].dataType.simpleString()
    rows = reps.select("node", "n", "label", "vec").mapInArrow(run, f"node long, n long, label {label}, dim int, vec binary, keys binary, cells array<long>")
    return rows


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest number first, so that squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector."""
    spark = vectors.sparkSession
    ship(spark)
    reps = store(_prepare(vectors), "vec-reps")
    sizes = reps.groupBy("label", F.size("vec")).agg(F.count("*").alias("size"))
    how = step(sizes.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0])
    dealt = store(_dealt(reps, how), "vec-cells")
    # The own rows stay narrow until their cells are known to be shared.
    places = dealt.select("node", "label", "dim", F.explode("cells").alias("cell")).distinct()
    shared = places.groupBy("label", "dim", "cell").agg(F.count("*").alias("size")).where("size > 1")
    places = store(places.join(shared, ["label", "dim", "cell"]).select("node", "label", "dim", "cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("nb")), "vec-places")
    # A cell of many blocks is compared block by block: each block meets itself and every other.
    places = places.withColumn("own", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    places = places.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    places = places.select("node", "label", "dim", "cell", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    rows = places.join(dealt.select("node", "n", "vec", "keys"), "node")
    shape, kind = how[2:], _kind(reps)

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        cell = key[2].as_py()
        lo, hi = key[3].as_py(), key[4].as_py()
        own, ids, n = t.column("own").to_numpy(), t.column("node").to_numpy(), t.column("n").to_numpy()
        unit = _unit(np.frombuffer(b"".join(t.column("vec").to_pylist()), kind).reshape(len(ids), -1))
        keys = np.frombuffer(b"".join(t.column("keys").to_pylist()), np.int64).reshape(len(ids), *shape)
        count = np.zeros(len(ids), np.int64)
        near = unit @ unit.T >= cosine
        near &= ids[:, None] != ids[None, :]
        if lo != hi:
            near &= own[:, None] != own[None, :]
        i, j = np.nonzero(near)
        up = i < j
        i, j = i[up], j[up]
        # A pair counts in one of its meeting places: the least shared key of the first table in which it meets.
        for at in range(0, len(i), 65536):
            left, right = i[at:at + 65536], j[at:at + 65536]
            for k in range(shape[0]):
                x, y = keys[left, k], keys[right, k]
                least = np.full(len(left), NO_KEY)
                for p in range(shape[1]):
                    least = np.minimum(least, np.where((x[:, p, None] == y).any(axis=1), x[:, p], NO_KEY))
                here = least == cell
                np.add.at(count, left[here], n[right[here]])
                np.add.at(count, right[here], n[left[here]])
                on = least == NO_KEY
                left, right = left[on], right[on]
                if not len(left):
                    break
        low = spanning(near)
        own_links = ids[low]
        has = count > 0
        out = np.flatnonzero(has | (low != np.arange(len(ids))))
        return pa.table({"node": ids[out], "links": count[out], "to": own_links[out]})

    found = store(rows.groupBy("label", "dim", "cell", "lo", "hi").applyInArrow(run, "node long, links long, to long"), "vec-found")
    return _result(vectors, reps, found)


def _result(vectors: DataFrame, reps: DataFrame, found: DataFrame) -> DataFrame:
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")), "vec")
    # The least node of a component has its least id.
    first = reps.select(F.col("node").alias("component"), F.col("id").alias("_c"))
    comp = store(comp.join(first, "component").select("node", "_c"), "vec-comp")
    # Equal vectors of a label share their links and component.
    named = (reps.join(counts, "node", "left").join(comp, "node", "left")
             .select(F.col("label").alias("_l"), F.col("vec").alias("_v"), F.coalesce("_c", "id").alias("_c"),
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("_n")))
    v = vectors.select("vec_id", "label", "embedding")
    j = v.join(named, (v["label"] == named["_l"]) & (v["embedding"] == named["_v"]) & v["vec_id"].isNotNull(), "left")
    out = j.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
