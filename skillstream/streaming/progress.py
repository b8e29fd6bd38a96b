"""Ingest progress as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("numInputRows", T.LongType()),
    T.StructField("inputRowsPerSecond", T.DoubleType()),
])


def _row(timestamp, batch_id, rows, rate) -> tuple:
    rate = float(rate) if rate is not None else 0.0
    return timestamp, int(batch_id or 0), int(rows or 0), rate if rate == rate else 0.0  # NaN (no elapsed time) -> 0


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent micro-batch progress (bounded by the session's retained
    progress count) as rows: timestamp, batchId, numInputRows,
    inputRowsPerSecond (0 when absent). ``append_progress`` keeps all of it."""
    rows = [_row(p.get("timestamp"), p.get("batchId"), p.get("numInputRows"), p.get("inputRowsPerSecond"))
            for p in query.recentProgress]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


class _Appender(StreamingQueryListener):
    """Appends a row per micro-batch of the queries of one name."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self._spark, self._name, self._path = spark, name, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self._name:
            return
        row = _row(p.timestamp, p.batchId, p.numInputRows, p.inputRowsPerSecond)
        self._spark.createDataFrame([row], PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def append_progress(spark: SparkSession, name: str, path: str) -> StreamingQueryListener:
    """Append the progress of every micro-batch of the query ``name`` to a table.

    Register it before the query starts; the table outlives the session, so
    a restarted job goes on in it. Micro-batches reported while no listener
    is registered are not in the table. Returns the listener, for
    ``spark.streams.removeListener``.
    """
    listener = _Appender(spark, name, path)
    spark.streams.addListener(listener)
    return listener
