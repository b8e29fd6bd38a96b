"""The labelled rows that the classifiers learn from: all of them, or a bounded sample."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, store

#: Training rows are whole texts of at most so many characters, and windows of longer ones: this bounds what the driver holds.
MOST_CHARS, WINDOWS = 20_000, 4


def held_out(doc_id: Column) -> Column:
    """Rows that no classifier learns from: crc32 of the id as text leaves 0 when divided by 5. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def windows(text: Column) -> Column:
    """A text of at most MOST_CHARS characters as it is; of a longer one, windows from its start to its end."""
    width = MOST_CHARS // WINDOWS - 1
    at = [F.floor((F.length(text) - width) * i / (WINDOWS - 1)).cast("int") + 1 for i in range(WINDOWS)]
    return F.when(F.length(text) <= MOST_CHARS, text).otherwise(F.concat_ws(" ", *[F.substring(text, a, F.lit(width)) for a in at]))


def given_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, label of the ids that may be learnt from; not those with several labels."""
    return (labels.select("doc_id", F.col(label).alias("label")).where("doc_id is not null and label is not null")
            .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
            .where("label = other").select("doc_id", "label"))


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text, label (0 or 1) of every document with a text and a label that may be learnt from; whole texts."""
    rows = given_labels(labels, label).where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    rows = small(store(rows, f"labelled-{label}"), 16)
    return docs.select("doc_id", "text").where(F.length("text") > 0).where(~held_out(F.col("doc_id"))).join(rows, "doc_id")


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]) -> list[tuple[str, int]]:
    """At most ``per_class[v]`` rows (text, v) of each label value v that have a text, taken by the hash of the id: reruns agree."""
    rows = given_labels(labels, label)
    texts = docs.select("doc_id", "text").where(F.length("text") > 0)
    # Labels without a text go before the limit, so that others take their places.
    rows = store(rows.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), f"labelled-{label}")
    keys = [F.xxhash64(F.col("doc_id"), F.lit(label)), F.col("doc_id")]
    picked = None
    for value, most in per_class.items():
        some = rows.where(F.col("label") == value).orderBy(*keys).limit(most)
        picked = some if picked is None else picked.unionByName(some)
    ids = F.broadcast(picked.select(F.col("doc_id").alias("_id"), "label"))  # at most the sum of per_class rows
    found = texts.join(ids, texts["doc_id"] == ids["_id"]).select("_id", "label", windows(F.col("text")).alias("text"))
    found = found.groupBy("_id").agg(F.min(F.struct("text", "label")).alias("row")).select("_id", "row.text", "row.label")
    out = [(r["text"], int(r["label"])) for r in sorted(found.collect(), key=lambda r: r["_id"])]
    if none := sorted(set(per_class) - {v for _, v in out}):
        warnings.warn(f"no labelled text with {label} = {none}: nothing to learn from, every row gets the same score", stacklevel=2)
    return out
