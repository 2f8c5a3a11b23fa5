"""Skipping unchanged work, expiring cached answers, and streaming upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def changed(current: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose (id, parser, content hash, ...) was not processed before."""
    return current.join(done.select(*keys).distinct(), keys, "left_anti")


def reuse(answers: DataFrame, status: Column, answered: Column, now: Column, negative_days: int = 7) -> DataFrame:
    """permanent (positive), fresh or expired (negative, by age), or retry (pending), for each answer."""
    age = F.unix_timestamp(now) - F.unix_timestamp(answered)
    state = F.when(status == "positive", "permanent").when(status == "pending", "retry").when(age <= negative_days * 86_400, "fresh").otherwise("expired")
    return answers.withColumn("reuse", state)


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last state of each key; partial sums combine, so a busy key is no hot task."""
    fields = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("__s"))
    return best.select(key, "__s.*")


def resumable_load(spark: SparkSession, source: str, schema, sink: str, checkpoint: str) -> StreamingQuery:
    """Append new Parquet files of a folder to a sink, once each, then stop."""
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, kind: str, width: str, late: str) -> DataFrame:
    """Counts in tumbling windows with a watermark; the same plan for tables and streams."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
