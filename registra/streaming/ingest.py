"""Incremental ingest of files that arrive, as a stream into the documents table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from registra.operators import store


def ingest_stream(spark: SparkSession, source: DataFrame, store_path: str, checkpoint: str, key: str, digest: str, order: list[Column] | None = None) -> StreamingQuery:
    """Upsert each micro-batch of ``source``; processes what is there and stops.

    A batch that is run again finds its rows unchanged, so the table stays as it is.
    """

    def apply(batch: DataFrame, _: int) -> None:
        store.ingest(batch, store_path, key, digest, order=order)

    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def request_counts(events: DataFrame, ts: str, kind: str, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Requests of each kind in tumbling windows, with a watermark."""
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def latest_once(events: DataFrame, ts: str, key: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark."""
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
