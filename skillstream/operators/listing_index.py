"""The listing with a rank on every row: any page without reading the pages before it.

Ranks are a distributed prefix sum: rows are range-partitioned by the
listing's order and written, partitions are counted, and a row's rank is the
number of rows in the partitions before its own plus its place there. The
stored index is ordered by rank, so a page is a range of ranks that Parquet's
statistics cut out, and a page's first row is its cursor for keyset paging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import LISTING_COLS
from ..session import scratch_path
from .metrics import _listing_tie

RANK = "listing_rank"
INDEX_COLS = [*LISTING_COLS, "posted_date"]
# Rows of one Parquet file of the index; a page reads the files whose ranks it needs.
ROWS_PER_FILE = 1_000_000


def write_listing_index(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Rank the listing (``listing_order``) from 0 and store it, ordered by rank."""
    spark = df.sparkSession
    order = [F.desc_nulls_last("posted_date"), F.asc_nulls_last("job_id"), F.asc("tie"), F.asc("__row")]
    rows = df.select(*INDEX_COLS).withColumn("tie", _listing_tie())
    # Identical rows are interchangeable; a row number parts them, so that many of them do not meet in one task.
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    ordered = scratch_path(spark, "listing-ordered")
    # Written, so that partition numbers and rows stay the same when a task is run again.
    rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).write.mode("overwrite").parquet(ordered)
    rows = spark.read.parquet(ordered)
    # One row per partition.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("__part").agg(F.count("*").alias("n")).select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    ranked = rows.withColumn("__place", place).join(F.broadcast(parts), "__part")
    ranked = ranked.withColumn(RANK, (F.col("__before") + F.col("__place") - 1).cast("bigint")).drop("__part", "__row", "__place", "__before")
    ranked = ranked.repartitionByRange(RANK).sortWithinPartitions(RANK)
    ranked.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_listing_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def indexed_page(index: DataFrame, page: int, size: int = 10) -> DataFrame:
    """One page in order: a range of ranks, pushed down to the scan."""
    first = page * size
    return (index.where((F.col(RANK) >= first) & (F.col(RANK) < first + size)).orderBy(RANK).select(*LISTING_COLS))


def paged(index: DataFrame, size: int = 10) -> DataFrame:
    """The whole listing with the page of each row and its place there, both from 0."""
    page = F.floor(F.col(RANK) / size).cast("bigint")
    return index.select(page.alias("page"), (F.col(RANK) % size).cast("int").alias("place"), *INDEX_COLS, "tie")


def page_cursors(index: DataFrame, size: int = 10) -> DataFrame:
    """page and the cursor (``listing_after``) after which it begins: the last row of the page before.

    ``shown`` counts the rows of the last row's kind up to it.
    """
    last = index.where((F.col(RANK) + 1) % size == 0).select(((F.col(RANK) + 1) / size).cast("bigint").alias("page"), RANK, "posted_date", "job_id", "tie")
    # Rows of a kind stand together, so their number up to a rank follows from where the kind begins.
    kinds = index.groupBy("posted_date", "job_id", "tie").agg(F.min(RANK).alias("begins"))
    same = [last[c].eqNullSafe(kinds[c]) for c in ("posted_date", "job_id", "tie")]
    return last.join(kinds, same[0] & same[1] & same[2]).select(
        "page", last["posted_date"], last["job_id"], last["tie"], (F.col(RANK) - F.col("begins") + 1).alias("shown"))
