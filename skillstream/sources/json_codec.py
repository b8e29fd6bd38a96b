"""JSON message codec for postings (decode S2, batch file load S3, encode/publish S4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import POSTING_COLS, POSTING_SCHEMA


def decode_postings(envelopes: DataFrame, value_col: str = "value",
                    ts_col: str | None = "timestamp", carry: list[str] | None = None) -> DataFrame:
    """Envelopes (``value`` binary/string, ``timestamp``) -> raw postings.

    PERMISSIVE decode with the fixed posting schema: unknown fields are
    dropped, a number in a text field becomes text, a field of the wrong
    shape becomes NULL, and malformed JSON (or a JSON array, NULL or empty
    value) becomes an all-NULL row that is kept (see ``split_quarantine``).
    The envelope time is carried as ``kafka_timestamp``, ``carry`` columns unchanged.
    """
    # the envelope time keeps its type (Kafka/file sources give TIMESTAMP)
    ts = (F.col(ts_col) if ts_col else F.lit(None).cast("timestamp")).alias("kafka_timestamp")
    return (envelopes.select(F.from_json(F.col(value_col).cast("string"), POSTING_SCHEMA).alias("data"),
                             ts, *(carry or []))
                     .select("data.*", "kafka_timestamp", *(carry or [])))


def is_malformed(job_id: Column | None = None) -> Column:
    """Rows a decode could not attribute to a posting (no ``job_id``)."""
    return (F.col("job_id") if job_id is None else job_id).isNull()


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Optional split of decoded rows into (postings, malformed); off by default
    in the ingest job, which keeps malformed rows like the source system."""
    return decoded.where(~is_malformed()), decoded.where(is_malformed())


def encode_postings(df: DataFrame, key_col: str | None = "job_id",
                    carry: list[str] | None = None) -> DataFrame:
    """Raw postings -> envelopes ``key, value`` (one JSON object per row; NULL
    fields are written as ``null``), plus any ``carry`` columns unchanged."""
    value = F.to_json(F.struct(*[F.col(c) for c in POSTING_COLS]),
                      {"ignoreNullFields": "false"}).alias("value")
    key = (F.col(key_col) if key_col else F.lit(None)).cast("string").alias("key")
    return df.select(key, value, *(carry or []))


def read_postings_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Load a JSON file of postings (S3): an array of objects per file
    (``multi_line``; one task per file) or JSON lines (splittable, the
    format to prefer at scale). A missing path gives no rows."""
    reader = spark.read.schema(POSTING_SCHEMA).option("multiLine", str(multi_line).lower())
    try:
        df = reader.json(path)
        df.schema
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        df = spark.createDataFrame([], POSTING_SCHEMA)
    return df.select(*POSTING_COLS)


def publish(df: DataFrame, target: str, fmt: str = "text", options: dict | None = None,
            max_message_bytes: int | None = None) -> dict:
    """Publish postings as JSON messages (S4); returns this run's counts.

    ``fmt``: ``text`` (JSON lines, one file per partition), ``json``,
    ``parquet`` (envelope columns), or ``kafka`` (``target`` = topic; needs
    the connector and ``kafka.bootstrap.servers`` in ``options``). Each
    partition is one unit of sending; no global numbering of rows. A message
    above ``max_message_bytes`` (brokers refuse large ones) counts as failed
    and is not sent. The counts (total, sent) are observed while writing, so
    they cover this run only, whatever the target already holds.
    """
    env = encode_postings(df)
    fits = (F.lit(True) if max_message_bytes is None
            else F.octet_length("value") <= F.lit(max_message_bytes))
    counts = Observation()
    env = env.observe(counts, F.count(F.lit(1)).alias("total"),
                      F.coalesce(F.sum(fits.cast("long")), F.lit(0)).alias("sent")).where(fits)
    opts = dict(options or {})
    if fmt == "text":
        env.select("value").write.mode("append").options(**opts).text(target)
    elif fmt == "kafka":
        env.write.format("kafka").options(**opts).option("topic", target).save()
    else:
        env.write.mode("append").format(fmt).options(**opts).save(target)
    return dict(counts.get)


def publish_stats(spark: SparkSession, counts: dict) -> DataFrame:
    """Sent / failed / success rate (1 decimal) of one publish run."""
    t = spark.range(1).select(F.lit(int(counts["total"])).cast("long").alias("total"),
                              F.lit(int(counts["sent"])).cast("long").alias("sent"))
    return t.select("total", "sent", (F.col("total") - F.col("sent")).alias("failed"),
                    F.when(F.col("total") > 0, F.round(F.col("sent") * 100.0 / F.col("total"), 1))
                     .otherwise(F.lit(0.0)).alias("success_pct"))
