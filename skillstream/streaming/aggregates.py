"""Running dashboard counts maintained by a stream.

The batch metric functions are the contract; this keeps the same counts
up to date as postings arrive, as a complete-mode streaming aggregation.
Its state is one row per key (skills are bounded by the dictionary;
locations, companies and seniority classes are small), and each
micro-batch writes the full current table to ``<out>/epoch=<id>`` so a
replayed epoch replaces itself and readers take the newest epoch. Only the
last ``KEPT_EPOCHS`` tables are kept: the newest, and the one before it for
readers that have already listed it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import COUNT_COL

KEPT_EPOCHS = 2


def start_running_counts(postings: DataFrame, key: Column, key_name: str, out_path: str,
                         checkpoint: str, available_now: bool = True,
                         processing_time: str = "1 minute") -> StreamingQuery:
    """Count postings per ``key`` (an exploded array or a plain column) in a stream."""
    counts = (postings.select(key.alias(key_name)).where(F.col(key_name).isNotNull())
                      .groupBy(key_name).agg(F.count(F.lit(1)).alias(COUNT_COL)))

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")
        _drop_epochs(batch.sparkSession, out_path, epoch - KEPT_EPOCHS)

    w = (counts.writeStream.outputMode("complete").foreachBatch(publish)
               .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def _drop_epochs(spark: SparkSession, out_path: str, last: int) -> None:
    """Remove the count tables of epochs up to ``last``, through the folder's own file system."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("epoch=") and int(name.partition("=")[2]) <= last:
            fs.delete(status.getPath(), True)


def running_skill_counts(postings: DataFrame, out_path: str, checkpoint: str,
                         **kw) -> StreamingQuery:
    return start_running_counts(postings, F.explode("skills_extracted"), "skill", out_path,
                                checkpoint, **kw)


def running_counts(postings: DataFrame, column: str, out_path: str, checkpoint: str,
                   **kw) -> StreamingQuery:
    """Postings per value of a plain column (``location``, ``company``, ``seniority``, ``posted_date``)."""
    return start_running_counts(postings, F.col(column), column, out_path, checkpoint, **kw)


def latest_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest published count table (the max epoch is a scalar subquery)."""
    all_epochs = spark.read.parquet(out_path)
    newest = all_epochs.agg(F.max("epoch")).scalar()
    return all_epochs.where(F.col("epoch") == newest).drop("epoch")
