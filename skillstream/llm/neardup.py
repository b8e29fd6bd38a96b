"""Operator 2: near duplicates by BagMinHash.

A text is a multiset of shingles of five words (a shorter text is one shingle).
A shingle of weight w (times it occurs) is the interval [0, w) cut at powers of
two into the levels [0, 1), [1, 2), [2, 4), ... Each (shingle, level) is a
Poisson process whose points have a time, a place in the level and a slot; a
level that w covers in part keeps the points below w. The signature is the
earliest point of each slot, so two signatures agree in a slot with a chance
equal to the weighted Jaccard similarity. Points are drawn in order of time
and only until they can no longer be the earliest.

Signatures are cut into bands; texts that share a band are candidates, and
every candidate pair is verified by the exact overlap of the multisets. Equal
texts are one class from the start and enter once. In a band, texts are first
compared with its least id; what that leaves in different components is
compared in blocks, so that no group is expanded into all of its pairs.

Edge cases: null texts are never duplicates; texts without a word are
duplicates only of equal texts; rows with a null id stay by themselves; rows
with the same id and different texts are documents of their own, which meet
only if their texts are near (two classes may then bear the same least id); of
a class the text of its least id is kept, and of several such texts the one
with the least hash; an empty table gives an empty result; other columns are
ignored by :func:`classes` and kept by :func:`one_of_each`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STORE_BYTES, components, enter, running_totals, ship, small, spanning, store

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
#: A pair of candidates is looked at again only if this share of its slots agree: 0.8 less over four deviations.
LEAST_AGREED = 0.66
BLOCK = 512
#: Elements of multisets that are handled at once: in signatures, and on each side of a block of comparisons. A larger
#: multiset goes through signatures in parts, and makes a block by itself.
ELEMENTS = 1 << 17
BLOCK_ELEMENTS = 1 << 20
#: Bytes of a text whose words are listed at once.
PIECE = 1 << 20
WHITE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a kept hash besides the letters of its word.
HASH_BYTES = 170

_HASHES: dict[bytes, int] = {}
_LETTERS = [0]


def _forget() -> None:
    _HASHES.clear()
    _LETTERS[0] = 0


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    get = _HASHES.get
    out = [get(w) for w in words]
    if None in out:
        if HASH_BYTES * len(_HASHES) + _LETTERS[0] > STORE_BYTES:
            _forget()
        for i, v in enumerate(out):
            if v is None:
                w = words[i]
                out[i] = _HASHES[w] = xxhash.xxh3_64_intdigest(w)
                _LETTERS[0] += len(w)
    return np.array(out, np.uint64)


def _all_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text, listed about PIECE bytes at a time."""
    data, at, out = text.encode(), 0, [np.zeros(0, np.uint64)]
    while at < len(data):
        gap = WHITE.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        out.append(word_hashes(data[at:end].split()))
        at = end
    return np.concatenate(out)


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """64-bit hashes of the runs of n words of a text, in order; one of all words if there are fewer."""
    h = _all_hashes(text)
    if not len(h):
        return h
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i])
    return out


def counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(h, return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two counted multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum()) + int(b[1].sum()) - common
    return common / total if total else 0.0


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """One row of 64-bit slot values for each counted multiset: the identity of the earliest point in each slot."""
    n = len(sets)
    best = np.full((n, slots), np.inf)
    name = np.zeros((n, slots), np.uint64)
    if not n:
        return name
    row = np.repeat(np.arange(n), [len(s[0]) for s in sets])
    x = np.concatenate([s[0] for s in sets])
    w = np.concatenate([s[1] for s in sets])
    for k in range(0, len(x), ELEMENTS):
        _draw(best, name, row[k:k + ELEMENTS], x[k:k + ELEMENTS], w[k:k + ELEMENTS].astype(np.int64))
    return name


def _draw(best: np.ndarray, name: np.ndarray, row: np.ndarray, x: np.ndarray, w: np.ndarray) -> None:
    """The points of some elements: time and identity of the earliest in each slot so far, one row for each multiset."""
    slots = best.shape[1]
    parts, level = [], 0
    while len(x):  # levels [0, 1), [1, 2), [2, 4), ...: those that begin below the weight
        low, high = (0, 1) if level == 0 else (1 << (level - 1), 1 << level)
        parts.append((row, _mix(x + np.uint64(level * 0xD1342543DE82EF95 % 2**64)), w, np.full(len(x), low), np.full(len(x), high - low)))
        on = w > high
        row, x, w, level = row[on], x[on], w[on], level + 1
    row, seed, w, low, length = (np.concatenate(p) for p in zip(*parts, strict=True))
    time = np.zeros(len(row))
    step = 0
    while len(row):
        step += 1
        r = _mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
        # Three draws from one hash: the wait (32 bits), the place in the level and the slot (second hash).
        time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (length * slots)
        alive = time < best.max(axis=1)[row]  # later points of a process only come later
        if not alive.all():
            row, seed, w, low, length, time, r = (v[alive] for v in (row, seed, w, low, length, time, r))
            if not len(row):
                break
        q = _mix(r ^ np.uint64(0xA0761D6478BD642F))
        slot = ((q >> np.uint64(40)) % np.uint64(slots)).astype(np.int64)
        place = low + (q & np.uint64((1 << 40) - 1)).astype(np.float64) * 2.0**-40 * length
        use = np.flatnonzero(place < w)
        cell = row[use] * slots + slot[use]
        np.minimum.at(best.ravel(), cell, time[use])
        won = time[use] == best.ravel()[cell]
        name.ravel()[cell[won]] = r[use][won]


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.full((len(sig), bands), np.uint64(1)) * np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + sig[:, i::rows][:, :bands])
    return out.view(np.int64)


def _together(texts: list[str]) -> Iterator[tuple[list[int], list[tuple[np.ndarray, np.ndarray]]]]:
    """(places, counted multisets) of the texts with a word, some at a time: 256, or until they have ELEMENTS elements."""
    some, sets, size = [], [], 0
    for i, t in enumerate(texts):
        s = counted(shingles(t))
        if not len(s[0]):
            continue
        if some and (len(some) == 256 or size + len(s[0]) > ELEMENTS):
            yield some, sets
            some, sets, size = [], [], 0
        some, sets, size = [*some, i], [*sets, s], size + len(s[0])
    if some:
        yield some, sets


def _sign(texts: DataFrame) -> DataFrame:
    """(id, key, text) → id, key, bands array<long>, marks binary (8 bits of each slot); texts without a word are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("near", _forget)
        for b in batches:
            for some, sets in _together(b.column("text").to_pylist()):
                sig = signatures(sets)
                marks = (sig & np.uint64(0xFF)).astype(np.uint8)
                same = b.select(["id", "key"]).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([*same.columns, pa.array(list(band_keys(sig)), pa.list_(pa.int64())),
                                                  pa.array([m.tobytes() for m in marks], pa.binary())], ["id", "key", "bands", "marks"])

    return texts.mapInArrow(run, "id long, key string, bands array<long>, marks binary")


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose multisets overlap enough. Texts travel to the pairs; hot ids are split by Spark's skew join."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("near", _forget)
        last: tuple = (None, None)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ta, tb = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
            keep = []
            for i in range(len(a)):
                if last[0] != a[i]:
                    last = (a[i], counted(shingles(ta[i])))
                keep.append(overlap(last[1], counted(shingles(tb[i]))) >= similarity)
            keep = np.array(keep, bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)[keep]), pa.array(np.array(b, np.int64)[keep])], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _agree(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in enough slots."""
    a = marks.select(F.col("id").alias("a"), F.col("marks").alias("ma"))
    b = marks.select(F.col("id").alias("b"), F.col("marks").alias("mb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ma = np.frombuffer(b"".join(x.column("ma").to_pylist()), np.uint8).reshape(-1, SLOTS)
            mb = np.frombuffer(b"".join(x.column("mb").to_pylist()), np.uint8).reshape(-1, SLOTS)
            keep = pa.array((ma == mb).mean(axis=1) >= LEAST_AGREED)
            yield x.select(["a", "b"]).filter(keep)

    return pairs.join(a, "a").join(b, "b").select("a", "b", "ma", "mb").mapInArrow(run, "a long, b long")


def _open_places(places: DataFrame, comp: DataFrame, columns: list[str]) -> DataFrame:
    """(bucket, id, ...) dealt into blocks, for buckets that span components.

    The largest component of a bucket needs no comparison inside itself: every
    row outside it (side 0) meets all rows of the bucket (side 1), in blocks
    (l, r) of about BLOCK by BLOCK rows, or of fewer with BLOCK_ELEMENTS
    elements a side, where ``units`` gives the elements of a row.
    """
    # Whole numbers, so that both sides count the same however the sums are ordered.
    unit = F.lit(BLOCK_ELEMENTS // BLOCK).cast("long")
    unit = F.greatest(unit, F.col("units").cast("long")) if "units" in places.columns else unit
    m = places.join(comp, places["id"] == comp["node"], "left").withColumn("comp", F.coalesce("component", "id")).drop("node", "component")
    sizes = m.groupBy("bucket", "comp").agg(F.sum(unit).alias("n"))
    per = (sizes.groupBy("bucket").agg(F.count("*").alias("comps"), F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("top"))
           .where("comps > 1").select("bucket", F.col("top.comp").alias("main"), F.ceil(F.col("all") / BLOCK_ELEMENTS).cast("int").alias("rb"),
                                      F.ceil((F.col("all") - F.col("top.n")) / BLOCK_ELEMENTS).cast("int").alias("lb")))
    m = m.join(per, "bucket")
    block = F.xxhash64("id", F.lit(7))
    left = (m.where("comp <> main").withColumn("l", F.pmod(block, F.col("lb")).cast("int"))
            .withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rb") - 1))).withColumn("side", F.lit(0)))
    right = (m.withColumn("r", F.pmod(block, F.col("rb")).cast("int"))
             .withColumn("l", F.explode(F.sequence(F.lit(0), F.col("lb") - 1))).withColumn("side", F.lit(1)))
    columns = ["bucket", "l", "r", "side", "id", "comp", *columns]
    return left.select(columns).unionByName(right.select(columns))


def _promising(places: DataFrame, marks: DataFrame, comp: DataFrame) -> DataFrame:
    """The (bucket, id) whose signature agrees with one of another component in the bucket."""
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        side, ids, comps = (t.column(c).to_numpy() for c in ("side", "id", "comp"))
        sig = np.frombuffer(b"".join(t.column("marks").to_pylist()), np.uint8).reshape(-1, SLOTS)
        i, j = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        good = np.zeros(len(ids), bool)
        for x in i:
            near = j[((sig[j] == sig[x]).mean(axis=1) >= LEAST_AGREED) & (comps[j] != comps[x])]
            good[near] = True
            good[x] |= len(near) > 0
        found = np.unique(ids[good])
        return pa.table({"bucket": np.full(len(found), key[0].as_py()), "id": found})

    dealt = _open_places(places.join(marks, "id"), comp, ["marks"])
    return dealt.groupBy("bucket", "l", "r").applyInArrow(run, "bucket long, id long").distinct()


def _bags(texts: DataFrame) -> DataFrame:
    """(id, text) → id, bag: the sorted elements of its multiset, each occurrence of a shingle an element of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("near", _forget)
        for b in batches:
            bags = []
            for t in b.column("text").to_pylist():
                h, n = counted(shingles(t))
                copy = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                bags.append(_mix(np.repeat(h, n) + copy.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(bags, pa.binary())], ["id", "bag"])

    return texts.mapInArrow(run, "id long, bag binary").withColumn("units", F.expr("cast(octet_length(bag) as long) div 8"))


def block_overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Similarity of every left bag with every right bag: a product of incidence matrices, some columns at a time."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    _, number = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
    cols = [number[:sizes[0].sum()], number[sizes[0].sum():]]
    both = np.intersect1d(*cols)
    common = np.zeros((len(left), len(right)), np.float32)
    for k in range(0, len(both), 4096):
        some = both[k:k + 4096]
        parts = []
        for row, col, side in zip(rows, cols, (left, right), strict=True):
            at = np.searchsorted(some, col)
            hit = (at < len(some)) & (some[np.minimum(at, len(some) - 1)] == col)
            one = np.zeros((len(side), len(some)), np.float32)
            one[row[hit], at[hit]] = 1
            parts.append(one)
        common += parts[0] @ parts[1].T
    common = common.astype(np.float64)  # whole numbers below 2^24, so exact so far
    return common / np.maximum(1, sizes[0][:, None] + sizes[1][None, :] - common)


def _found_in_blocks(places: DataFrame, bags: DataFrame, comp: DataFrame, similarity: float) -> DataFrame:
    """Verified links (a, b) between components inside buckets: exact overlaps, of which a block returns a spanning set."""
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        side, ids, comps = (t.column(c).to_numpy() for c in ("side", "id", "comp"))
        bags = [np.frombuffer(x, np.uint64) for x in t.column("bag").to_pylist()]
        i, j = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        linked = np.zeros((len(ids), len(ids)), bool)
        if len(i) and len(j):
            near = block_overlaps([bags[x] for x in i], [bags[x] for x in j]) >= similarity
            linked[np.ix_(i, j)] = near & (comps[i][:, None] != comps[j][None, :])
        low = spanning(linked | linked.T)
        out = np.flatnonzero(low != np.arange(len(ids)))
        return pa.table({"a": ids[low[out]], "b": ids[out]})

    dealt = _open_places(places.join(bags, "id"), comp, ["bag"])
    return dealt.groupBy("bucket", "l", "r").applyInArrow(run, "a long, b long").where("a <> b").distinct()


def links(docs: DataFrame, exact: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs (id, key, text) and exact (key, least id, node) → (node, component) of the verified links between different texts."""
    ship(docs.sparkSession)
    # Every row is signed where it lies; the copies of a text go before anything else moves.
    signed = store(_sign(docs).join(exact, ["key", "id"]).dropDuplicates(["key", "id"])
                   .select(F.col("node").alias("id"), "bands", "marks"), "near-signed")
    marks = signed.select("id", "marks")
    rows = signed.select(F.explode("bands").alias("bucket"), "id")
    # Buckets of one text go before anything is joined.
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = store(rows.join(shared, "bucket"), "near-buckets")
    # A bucket is led by the text that meets most others: the original of a group is nearer to its copies than they are.
    met = buckets.groupBy("id").agg(F.sum("n").alias("met"))
    leads = (buckets.join(met, "id").groupBy("bucket").agg(F.max(F.struct("met", (-F.col("id")).alias("least"))).alias("top"))
             .select("bucket", (-F.col("top.least")).alias("lead")))
    buckets = store(buckets.join(leads, "bucket").where("id <> lead").select("bucket", "id", "lead", "n"), "near-led")
    pairs = buckets.select(F.least("lead", "id").alias("a"), F.greatest("lead", "id").alias("b")).distinct()
    pairs = store(_agree(pairs, marks), "near-pairs")
    star = store(_verify(pairs, _texts(docs, exact, pairs), similarity), "near-star")
    comp = store(components(star, "near-star"), "near-comp")
    # The lead has met its whole bucket; with three texts or more the others have not met each other.
    more = store(_promising(buckets.where("n > 2").select("bucket", "id"), marks, comp), "near-more")
    if not more.take(1):
        return comp
    bags = store(_bags(_texts(docs, exact, more.select(F.col("id").alias("a"), F.col("id").alias("b")))), "near-bags")
    found = store(_found_in_blocks(more, bags, comp, similarity), "near-found")
    if not found.take(1):
        return comp
    stars = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(found), "near-all")


def _texts(docs: DataFrame, exact: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, text) of the texts in pairs only; their ids are nodes."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    nodes = small(store(nodes.join(exact, "node"), "near-nodes"), 150)
    return store(docs.join(nodes, ["id", "key"]).select(F.col("node").alias("id"), "text").distinct(), "near-texts")


def _classes(docs: DataFrame, similarity: float) -> DataFrame:
    """doc_id, __key (hash of the text), component_id, kept."""
    rows = docs.select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("key"), "text")
    known = rows.where("id is not null and text is not null")
    # Equal texts meet on a hash, combined before the shuffle; their least id stands for them. Several texts may have
    # that id, so each text is a node of its own: its place in the order of (least id, key).
    exact = known.groupBy("key").agg(F.min("id").alias("id")).withColumn("node", F.lit(1).cast("long"))
    exact = running_totals(exact, ["id", "key"], ["node"], "near-order").select("key", "id", F.col("node_before").alias("node"))
    exact = store(exact, "near-exact")
    comp = store(links(known, exact, similarity), "near-classes")
    # The least node of a class is its text of the least id, and of these the one with the least key.
    first = exact.select(F.col("node").alias("component"), F.col("id").alias("_id"), F.col("key").alias("_key"))
    comp = comp.join(first, "component").select("node", "_id", "_key")
    named = exact.join(comp, "node", "left").select("key", F.coalesce("_id", "id").alias("component_id"), F.coalesce("_key", "key").alias("_key"))
    out = rows.join(named, "key", "left")
    alone = F.col("id").isNull() | F.col("component_id").isNull()
    kept = F.when(alone, F.lit(True)).otherwise((F.col("id") == F.col("component_id")) & (F.col("key") == F.col("_key")))
    return out.select(F.col("id").alias("doc_id"), F.col("key").alias("__key"), F.coalesce("component_id", "id").alias("component_id"), kept.alias("kept"))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, component_id (least doc_id of its class), kept (it is that document; all rows of it if it is repeated)."""
    return _classes(docs, similarity).drop("__key")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without the near copies: of each class the document that :func:`classes` keeps; a repeated row stays once.

    Of rows equal in id and text the one whose other columns, as JSON, sort first stays.
    """
    columns = docs.columns
    keep = store(_classes(docs, similarity).where("kept and doc_id is not null")
                 .groupBy(F.col("doc_id").alias("__id"), F.col("__key").alias("__text")).agg(F.count("*").alias("__n")), "near-keep")
    # Rows are told apart by a struct, so that no column of theirs can clash.
    rows = docs.where("doc_id is not null").select(F.struct(*columns).alias("__row"))
    rows = rows.select("__row", F.col("__row.doc_id").alias("__doc"), F.sha2(F.col("__row.text"), 256).alias("__key"))

    def among(some: DataFrame) -> DataFrame:
        return rows.join(small(some, 150), (F.col("__doc") == F.col("__id")) & F.col("__key").eqNullSafe(F.col("__text")))

    single = among(keep.where("__n = 1")).select("__row.*")
    out = single.unionByName(docs.where("doc_id is null"))
    repeated = keep.where("__n > 1")
    if not repeated.take(1):
        return out
    others = [F.col(f"__row.{c}") for c in columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    first = among(repeated).groupBy("__doc", "__key").agg(F.min_by("__row", order).alias("__row"))
    return out.unionByName(first.select("__row.*"))
