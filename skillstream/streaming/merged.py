"""Running counts that write only what changed (R4), for keys without a bound (companies).

An update-mode aggregation hands over, per epoch, the keys whose count
changed, with their new count. Epoch ``e`` is written to
``<out>/changed/epoch=<e>`` in overwrite mode, so an epoch that is run again
replaces itself. Every ``merge_every`` epochs the changes since the last
merge are merged into ``<out>/merged/epoch=<e>``, one row per key, and what
the merge before the last one made superfluous is removed. A reader takes
the newest complete merge and the newer changes; of a key the newest row
counts. A merge that was cut off has no success marker and is neither read
nor merged further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import COUNT_COL

MERGE_EVERY = 20


class _Folder:
    """Epoch folders below a path, in the path's own file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.path = path
        root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.root = root

    def epochs(self, complete: bool = True) -> list[int]:
        if not self.fs.exists(self.root):
            return []
        found = [s.getPath().getName() for s in self.fs.listStatus(self.root)]
        found = [int(n.partition("=")[2]) for n in found if n.startswith("epoch=")]
        return sorted(e for e in found if not complete or self.fs.exists(self._at(f"{self.of(e)}/_SUCCESS")))

    def of(self, epoch: int) -> str:
        return f"{self.path}/epoch={epoch}"

    def drop(self, epochs: list[int]) -> None:
        for e in epochs:
            self.fs.delete(self._at(self.of(e)), True)

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)


def _newest(spark: SparkSession, out_path: str, before: int | None = None) -> DataFrame | None:
    """key columns, count: the newest row of every key, of epochs up to ``before``; None if there are none yet."""
    changed, merged = _Folder(spark, f"{out_path}/changed"), _Folder(spark, f"{out_path}/merged")
    # A merge of the epoch itself is left out, so that an epoch run again merges from what was there before it.
    base = [e for e in merged.epochs() if before is None or e < before][-1:]
    later = [e for e in changed.epochs() if (not base or e > base[0]) and (before is None or e <= before)]
    parts = [spark.read.parquet(merged.of(e)).withColumn("epoch", F.lit(e)) for e in base]
    if later:
        parts.append(spark.read.option("basePath", changed.path).parquet(*[changed.of(e) for e in later]))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    key = [c for c in rows.columns if c not in (COUNT_COL, "epoch")]
    return rows.groupBy(*key).agg(F.max_by(COUNT_COL, "epoch").alias(COUNT_COL))


def merged_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The current count of every key."""
    rows = _newest(spark, out_path)
    if rows is None:
        raise FileNotFoundError(f"no counts at {out_path} yet")
    return rows


def start_merged_counts(postings: DataFrame, key: Column, key_name: str, out_path: str, checkpoint: str,
                        available_now: bool = True, processing_time: str = "1 minute",
                        merge_every: int = MERGE_EVERY) -> StreamingQuery:
    """Count postings per ``key`` (an exploded array or a plain column), writing changed keys only."""
    counts = (postings.select(key.alias(key_name)).where(F.col(key_name).isNotNull())
              .groupBy(key_name).agg(F.count(F.lit(1)).alias(COUNT_COL)))

    def publish(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        changed, merged = _Folder(spark, f"{out_path}/changed"), _Folder(spark, f"{out_path}/merged")
        batch.write.mode("overwrite").parquet(changed.of(epoch))
        if (epoch + 1) % merge_every:
            return
        _newest(spark, out_path, epoch).write.mode("overwrite").parquet(merged.of(epoch))
        # Readers that began with the merge before still find it and the changes after it.
        older = [e for e in merged.epochs() if e < epoch]
        if older:
            merged.drop([e for e in merged.epochs(complete=False) if e < older[-1]])
            changed.drop([e for e in changed.epochs(complete=False) if e <= older[-1]])

    w = (counts.writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
