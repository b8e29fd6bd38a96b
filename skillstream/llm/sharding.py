"""Operator 3: shards of near equal bytes by histogram sort.

Rows are ordered by (hash of the text, hash of the id), so that equal texts
stand together. Splitters are found by counting exact bytes below candidate
boundaries over all partitions and probing again only inside the cell that
holds each target, until a boundary is within tolerance. Then rows move once,
each to the part of a shard that the splitters name.

Edge cases: a null text has no bytes and checksum 0 and counts as size 1;
repeated rows are rows of their own (:func:`write_shards` keeps them
together); a group of equal texts is split only if no
boundary beside it is within tolerance; an empty table gives an empty result;
other columns are ignored by :func:`assign_shards` and kept by :func:`write_shards`,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

SHARDS = 8
TOLERANCE = 0.005
CELL_BITS = 12
LOWEST = -(1 << 63)
CHUNK_BITS = 16
#: Rows of keys, roughly, that one task of the exchange orders.
PART_ROWS = 4_000_000


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select("doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"),
                       F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                       F.xxhash64(text).alias("k1"), F.xxhash64("doc_id").alias("k2")).withColumn("size", F.col("bytes") + 1).drop("bytes")


def _numbered(docs: DataFrame) -> DataFrame:
    """Keys of all rows; wholly repeated rows are told apart by a running number in their second key, so that a hot one can be split.

    Copies are counted in chunks of at most 2^16 rows of a task, and numbered
    by the counts of the chunks before: no task meets all copies of a row.
    """
    same = ["doc_id", "text_crc32", "k1", "k2", "size"]
    # A written table, so that a row stays in its chunk when a task is run again.
    rows = store(_narrow(docs).withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)), "shard-rows")
    copies = rows.groupBy(*same, "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*same).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    copies = copies.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    copy = copies.withColumn("copy", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("n"))))
    return copy.withColumn("k2", F.when(F.col("copy") > 1, F.xxhash64("k2", "copy")).otherwise(F.col("k2"))).select(*same)


def _probe(rows: DataFrame, key: str, ranges: dict) -> dict:
    """ranges: probe → (condition, low, bits of the range, bits of a cell). Exact bytes of each cell, in one pass for all probes."""
    cell = None
    for i, (where, low, bits, shift) in ranges.items():
        if bits == 64:  # the whole signed range: the top bits, made non-negative
            inside = F.shiftright(F.col(key), bits - CELL_BITS) + (1 << (CELL_BITS - 1))
        else:
            inside = F.shiftright(F.col(key) - F.lit(low), shift)
        value = F.lit(i << CELL_BITS).cast("long") + inside
        cell = F.when(where, value) if cell is None else cell.when(where, value)
    found = rows.select(cell.alias("cell"), "size").where("cell is not null").groupBy("cell").agg(F.sum("size").alias("b")).collect()
    out: dict = {i: {} for i in ranges}
    for r in found:  # at most SHARDS * 4096 sums
        out[r["cell"] >> CELL_BITS][r["cell"] & ((1 << CELL_BITS) - 1)] = r["b"]
    return out


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Lower bounds (k1, k2) of shards 1, 2, ...; every one is within tolerance of equal bytes, or as near as rows allow."""
    total, largest = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    slack = max(tolerance * total / shards, largest / 2)
    goal = {i: i * total / shards for i in range(1, shards)}
    # Per splitter: the fixed k1 (None while k1 is being searched), the low end of the cell in hand, its bits, and bytes below it.
    state = {i: (None, LOWEST, 64, 0) for i in goal}
    done: dict[int, tuple[int, int]] = {}
    while state:
        for key in ("k1", "k2"):
            at = {i: s for i, s in state.items() if (s[0] is None) == (key == "k1")}
            groups: dict = {}
            for i, (k1, low, bits, below) in at.items():  # splitters in the same cell share one probe
                groups.setdefault((k1, low, bits), []).append(i)
            ranges, shift = {}, {}
            for n, (k1, low, bits) in enumerate(groups):
                shift[n] = bits - CELL_BITS if bits > CELL_BITS else 0
                where = F.lit(True) if bits == 64 else (F.col(key) >= low) & (F.col(key) <= low + (1 << bits) - 1)
                if k1 is not None:
                    where = where & (F.col("k1") == k1)
                ranges[n] = (where, low, bits, shift[n])
            if not ranges:
                continue
            cells = _probe(rows, key, ranges)
            for n, ((k1, low, bits), members) in enumerate(groups.items()):
                width, sums = 1 << shift[n], cells[n]
                for i in members:
                    below = at[i][3]
                    for c in sorted(sums):
                        if below + sums[c] >= goal[i]:
                            break
                        below += sums[c]
                    start, end = low + c * width, low + (c + 1) * width
                    left, right = goal[i] - below, below + sums[c] - goal[i]
                    if min(left, right) <= slack or (width == 1 and key == "k2"):
                        bound = start if left <= right else end
                        done[i] = (bound, LOWEST) if k1 is None else (k1, bound) if bound < 1 << 63 else (k1 + 1, LOWEST)
                        del state[i]
                    else:  # probe inside the cell; a cell of one k1 is a group of equal texts
                        state[i] = (start, LOWEST, 64, below) if width == 1 else (k1, start, shift[n], below)
    return [done[i] for i in sorted(done)]


def _part(bounds: list[tuple[int, int]], low: int = 0) -> Column:
    """The number of splitters at or below a row's keys, found by bisection."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    k1, k2 = bounds[middle]
    if k1 >= 1 << 63:  # beyond every key
        return _part(bounds[:middle], low)
    here = F.col("k1") >= F.lit(k1)
    if k2 != LOWEST:
        here = (F.col("k1") > F.lit(k1)) | ((F.col("k1") == F.lit(k1)) & (F.col("k2") >= F.lit(k2)))
    return F.when(here, _part(bounds[middle + 1:], low + middle + 1)).otherwise(_part(bounds[:middle], low))


def _exchange(keys: DataFrame, shards: int, tolerance: float) -> tuple[int, int, list[tuple[int, int]]]:
    """(parts of a shard, all parts, their splitters): every shard is cut further, until a part suits one task."""
    n = keys.count()
    parts = max(1, -(-n // (PART_ROWS * shards)))
    return parts, parts * shards, splitters(keys, shards * parts, tolerance * parts) if n else []


def assign_shards(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place in the shard, from 0 without gaps)."""
    rows = store(_numbered(docs), "shard-keys")
    parts, count, bounds = _exchange(rows, shards, tolerance)
    rows = rows.withColumn("part", _part(bounds).cast("int"))
    shard = F.expr(f"cast(part div {parts} as int)")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n")).withColumn("shard", shard)
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("part", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    # The exchange: a row goes to the part that the splitters name, is ordered there, and its place is counted.
    place = F.row_number().over(Window.partitionBy("part").orderBy("k1", "k2", "doc_id", "size")) - 1
    placed = rows.repartitionById(count, F.col("part")).withColumn("place", place)
    return (placed.join(F.broadcast(first), "part")  # one row per part
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).cast("long").alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, tolerance: float = TOLERANCE) -> None:
    """Write all documents under ``path/shard=<i>``: one exchange on the splitters found, one sorted file a part.

    If the documents have a column ``shard`` of their own, the folders are
    named by the first free of ``shard_1``, ``shard_2``, ...
    """
    keys = store(_narrow(docs), "shard-keys")
    parts, count, bounds = _exchange(keys, shards, tolerance)
    taken = {c.lower() for c in docs.columns}
    name = next(c for c in ["shard", *[f"shard_{i}" for i in range(1, len(taken) + 2)]] if c not in taken)
    # The rows travel in one struct, so that no name of theirs can meet a key's.
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("k1"), F.xxhash64("doc_id").alias("k2"))
    out = out.withColumn("part", _part(bounds).cast("int")).repartitionById(count, F.col("part")).sortWithinPartitions("part", "k1", "k2")
    out.select("row.*", F.expr(f"cast(part div {parts} as int)").alias(name)).write.partitionBy(name).parquet(path)
