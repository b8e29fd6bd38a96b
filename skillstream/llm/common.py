"""Helpers shared by the operators: shipping, shared scratch tables, running totals, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word of the contracts: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()

#: Bytes, roughly, of what an operator may keep in a Python worker from batch to batch (words it has met, and the like).
STORE_BYTES = 32 << 20
#: A table of at most so many bytes is sent to every task; a larger one is joined by a shuffle.
BROADCAST_BYTES = 32 << 20
_KEPT: dict[str, Callable[[], None]] = {}


def enter(operator: str, forget: Callable[[], None]) -> None:
    """To be called in a Python worker when an operator begins there: what the others have kept is given back.

    Workers serve many stages; each operator that keeps something names
    itself and how to empty its stores.
    """
    others = [o for o in _KEPT if o != operator]
    for o in others:
        _KEPT.pop(o)()
    _KEPT[operator] = forget
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # another C library keeps freed memory as it likes
            ctypes.CDLL(None).malloc_trim(0)


def by_size(texts: list[str | None], most: int) -> Iterator[slice]:
    """Runs of texts of together at most ``most`` characters; a longer text is a run by itself."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > most:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, marked for broadcast if its rows fit into BROADCAST_BYTES."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def ship(spark: SparkSession) -> None:
    """Give every Python worker this package, once per application, and small Arrow batches.

    Batches are kept small because one row may hold a very long text.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, package)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_totals(df: DataFrame, order: list[str], values: list[str], name: str) -> DataFrame:
    """Adds ``<v>_before`` for each value: its sum over all rows that sort earlier (nulls first).

    Distributed prefix sum: range-partition by the order columns, add up each
    partition, and offset a per-partition running sum. The offsets table has
    one row per partition, whatever the data size. Rows equal in all order
    columns are taken in any order.
    """
    # A written table, so that partition numbers and rows stay the same when a task is run again.
    parts = store(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    sums = parts.groupBy("_part").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *[
        F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).cast("long").alias(f"_o_{v}") for v in values])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = parts.select("*", *[(F.sum(v).over(inside) - F.col(v)).alias(f"_r_{v}") for v in values])
    out = run.join(F.broadcast(offsets), "_part")  # one row per partition
    return out.select(*df.columns, *[(F.col(f"_o_{v}") + F.col(f"_r_{v}")).alias(f"{v}_before") for v in values])


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, component = smallest node).

    Alternating large-star and small-star steps: each node tells its
    neighbours their smallest known node, until nothing changes. Every round
    is two aggregations with map-side combine and joins on the node; rounds
    grow with the logarithm of the nodes, and no table reaches the driver.
    """
    spark = edges.sparkSession
    cur = store(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(),
                f"{name}-edges")
    stamp = None
    if not cur.take(1):
        return cur.select(F.col("v").alias("node"), F.col("u").alias("component"))
    while True:
        # Large star: every neighbour above a node is linked to the smallest node of that neighbourhood.
        both = cur.select("v", "u").unionByName(cur.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = store(large, f"{name}-large")
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        cur = store(small.unionByName(low.select("v", F.col("m").alias("u"))).distinct(), f"{name}-small")
        now = cur.agg(F.count("*"), F.sum(F.hash("v", "u").cast("long")),
                      F.coalesce(F.bit_xor(F.xxhash64("v", "u")), F.lit(0))).first()
        if stamp == tuple(now):
            break
        stamp = tuple(now)
    pairs = cur.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return pairs.unionByName(pairs.select(F.col("component").alias("node"), "component").distinct())


def spanning(adj: np.ndarray) -> np.ndarray:
    """The least row reachable from each row of a symmetric 0/1 matrix."""
    low = np.arange(len(adj))
    while True:
        new = np.minimum(low, np.where(adj, low[None, :], len(adj)).min(axis=1, initial=len(adj)))
        new = new[new]
        if (new == low).all():
            return low
        low = new
