"""Table scans and writes (Parquet by default; the format is a parameter)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ENRICHED_COLS


def ensure_parallelism(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A Parquet file is split at row-group boundaries, so a big file written
    as one row group is read by a single task, and CPU-heavy per-row work
    (text tagging) would then run on one core. At scale (many files and row
    groups) the scan already has far more partitions than cores and this is
    a no-op; otherwise the rows are hash-partitioned on ``key`` (a
    deterministic shuffle, safe to recompute after an executor loss).
    """
    spark = df.sparkSession
    want = spark.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    if have >= want:
        return df
    return df.repartition(want, F.col(key))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               columns: list[str] | None = None) -> DataFrame:
    """Newest committed snapshot of a posting table, columns in table order.

    A partition column (e.g. ``posted_date``) moves to the end when read
    back; re-selecting ``ENRICHED_COLS`` restores the stored order.
    """
    df = spark.read.format(fmt).load(path)
    cols = columns or [c for c in ENRICHED_COLS if c in df.columns]
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                partition_by: list[str] | None = None) -> None:
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Stored size of a table folder, from file-system metadata (no data read)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(jpath).getLength())


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def compact_table(spark: SparkSession, src: str, dst: str, fmt: str = "parquet",
                  target_file_bytes: int = 256 << 20, partition_col: str | None = None,
                  partition_value=None, partition_by: list[str] | None = None) -> str:
    """Rewrite a table (or one partition of it) into files of about
    ``target_file_bytes`` in a new folder ``dst`` and return ``dst``.

    A stream that appends every few seconds leaves many small files; this
    job merges them. ``partition_by``: the table's partition columns, kept as
    its layout. ``partition_col`` with ``partition_value`` (None: the NULL
    partition) merges that partition only, into the same partition of
    ``dst``, so the column is there when ``dst`` is read. The file count
    comes from the stored size (metadata only). Readers switch to ``dst``
    once the write has committed; the source is left untouched.
    """
    df = spark.read.format(fmt).load(src)
    if partition_col is not None:
        name = f"{partition_col}={NULL_PARTITION if partition_value is None else partition_value}"
        n_files = max(1, -(-table_bytes(spark, f"{src.rstrip('/')}/{name}") // target_file_bytes))
        value = F.lit(partition_value).cast(df.schema[partition_col].dataType)
        part = df.where(F.col(partition_col).eqNullSafe(value)).drop(partition_col)
        part.repartition(n_files).write.format(fmt).mode("overwrite").save(f"{dst.rstrip('/')}/{name}")
        return dst
    n_files = max(1, -(-table_bytes(spark, src) // target_file_bytes))
    if partition_by:
        # rows of a partition meet in few tasks; AQE splits large ones and merges small ones
        spread = df.hint("rebalance", *[F.col(c) for c in partition_by])
        spread.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(dst)
    else:
        df.repartition(n_files).write.format(fmt).mode("overwrite").save(dst)
    return dst
