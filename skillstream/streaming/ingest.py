"""Continuous ingest (R1): envelopes -> decode -> enrich -> append-only table.

Stateless, so exactly-once comes from the file sink's commit log plus the
checkpoint: a restarted query with no new input appends nothing, and a
replayed micro-batch is not committed twice. Keep the checkpoint outside
the table folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.enrich import enrich
from ..sources.json_codec import decode_postings, is_malformed
from .progress import append_progress

ENVELOPE_SCHEMA = T.StructType([T.StructField("value", T.StringType()),
                                T.StructField("timestamp", T.TimestampType())])


def read_envelopes(spark: SparkSession, fmt: str, path: str | None = None,
                   options: dict | None = None, max_files_per_trigger: int | None = None,
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Streaming envelopes ``value, timestamp``.

    ``kafka``: subscribe (``options`` carries ``kafka.bootstrap.servers`` and
    ``subscribe``), from the earliest offset, tolerating lost offsets.
    ``text``: JSON lines files; the envelope time is the file's modification
    time. ``json`` / ``parquet``: files holding the envelope columns.
    """
    opts = dict(options or {})
    r = spark.readStream
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        opts.setdefault("failOnDataLoss", "false")
        if max_offsets_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
        return r.format("kafka").options(**opts).load().select(
            F.col("value").cast("string").alias("value"), "timestamp")
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if fmt == "text":
        return r.format("text").options(**opts).load(path).select(
            "value", F.col("_metadata.file_modification_time").alias("timestamp"))
    return r.format(fmt).schema(ENVELOPE_SCHEMA).options(**opts).load(path).select(
        "value", "timestamp")


def enriched_stream(envelopes: DataFrame, dictionary=None,
                    dedupe_within: str | None = None) -> DataFrame:
    """Decode + enrich a stream; the same functions as in batch.

    ``dedupe_within`` (opt-in, e.g. ``"1 hour"``): drop a message that
    repeats one seen within that delay of envelope time (producer retries).
    A repeat has the same message text (by a 256-bit hash); ids may collide,
    so two different messages that share an id are both kept. Messages
    without a ``job_id`` (malformed ones among them) are never dropped and
    keep no state. A message that arrives later than the watermark is
    dropped with its state. Off by default: postings are never
    de-duplicated, as in the source system.
    """
    return enrich(decode_postings(_once(envelopes, dedupe_within)), dictionary)


def _once(envelopes: DataFrame, within: str | None) -> DataFrame:
    """Messages without the repeats seen within that delay (see ``enriched_stream``)."""
    if not within:
        return envelopes
    text = F.col("value").cast("string")
    has_id = F.get_json_object(text, "$.job_id").isNotNull()
    known = (envelopes.where(has_id).withColumn("__message", F.sha2(text, 256))
             .withWatermark("timestamp", within)
             .dropDuplicatesWithinWatermark(["__message"]).drop("__message"))
    return known.unionByName(envelopes.where(~has_id))


def start_ingest(enriched: DataFrame, table_path: str, checkpoint: str, fmt: str = "parquet",
                 processing_time: str | None = "10 seconds", available_now: bool = False,
                 partition_by: list[str] | None = None, name: str | None = None) -> StreamingQuery:
    """Append the enriched stream to a table."""
    w = (enriched.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", table_path))
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_ingest(spark: SparkSession, source_fmt: str, source: str | None, table_path: str,
               checkpoint: str, dictionary=None, options: dict | None = None,
               max_files_per_trigger: int | None = None, available_now: bool = True,
               partition_by: list[str] | None = None,
               dedupe_within: str | None = None, fmt: str = "parquet",
               processing_time: str | None = "10 seconds",
               max_offsets_per_trigger: int | None = None,
               progress_path: str | None = None) -> StreamingQuery:
    """R1 end to end; with ``available_now`` it processes what is there and stops.

    ``progress_path``: append a row per micro-batch to this table (S8).
    """
    env = read_envelopes(spark, source_fmt, source, options, max_files_per_trigger,
                         max_offsets_per_trigger)
    name = None
    if progress_path:
        name = f"ingest-{uuid.uuid4().hex[:12]}"
        append_progress(spark, name, progress_path)
    q = start_ingest(enriched_stream(env, dictionary, dedupe_within), table_path, checkpoint,
                     fmt=fmt, processing_time=processing_time,
                     available_now=available_now, partition_by=partition_by, name=name)
    if available_now:
        q.awaitTermination()
    return q


def start_batch_ingest(envelopes: DataFrame, table_path: str, checkpoint: str,
                       load_dictionary: Callable[[SparkSession], DataFrame | list | None] | None = None,
                       quarantine_path: str | None = None, dedupe_within: str | None = None, fmt: str = "parquet",
                       partition_by: list[str] | None = None, available_now: bool = True,
                       processing_time: str = "10 seconds") -> StreamingQuery:
    """Ingest whose micro-batches are enriched as batch DataFrames.

    ``load_dictionary`` is called for every micro-batch, so an edited
    dictionary (a list or a table of any size, read by the join tagger)
    applies from the next batch on without a restart. ``quarantine_path``:
    messages that decode to no posting (bad JSON, no ``job_id``) are set
    aside there with their text (``value``, ``kafka_timestamp``) instead of
    becoming all-NULL postings.

    Both tables are exactly-once: batch ``b`` goes to ``batch_id=<b>`` of
    each in overwrite mode, and the checkpoint remembers ``b`` only after
    both are written, so a batch that is run again, with the same messages,
    replaces what it left behind.
    """
    def deliver(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dictionary = load_dictionary(spark) if load_dictionary else None
        rows = decode_postings(batch, carry=["value"])
        postings = rows
        if quarantine_path:
            set_aside = rows.where(is_malformed()).select("value", "kafka_timestamp")
            set_aside.write.mode("overwrite").format(fmt).save(f"{quarantine_path}/batch_id={batch_id}")
            postings = rows.where(~is_malformed())
        w = enrich(postings.drop("value"), dictionary, row_key="job_id").write.mode("overwrite").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(f"{table_path}/batch_id={batch_id}")

    w = _once(envelopes, dedupe_within).writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
