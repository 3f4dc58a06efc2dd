"""Incremental runs: what was done before isn't done again.

The checkpoint remembers files; keys that come again in another file are
dropped by state or, without state, by an anti-join with the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.resume import pending
from tessera.sources import manifests


def ingest(spark: SparkSession, source: str, schema: T.StructType, key: str, out: str, checkpoint: str, transform=lambda df: df) -> StreamingQuery:
    """Take in all new JSON lines, each key once ever, and stop."""
    rows = spark.readStream.schema(schema).json(source).dropDuplicates([key])
    return transform(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)


def rejection_counts(spark: SparkSession, source: str, schema: T.StructType, name: str, checkpoint: str) -> StreamingQuery:
    """Running counts by reason over all that has come in, in a table in memory."""
    counts = spark.readStream.schema(schema).json(source).filter(F.col("reason").isNotNull()).groupBy("reason").count()
    return counts.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events in tumbling windows; works on a stream and on a table. ts must be a timestamp."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    return timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def resume_batch(spark: SparkSession, rows: DataFrame, key: str, path: str, schema: T.StructType, work) -> int:
    """Do what a manifest at path doesn't show yet and append it; the number of rows done."""
    done = manifests.read(spark, path, schema, tolerant=True).select(key).distinct()
    fresh = work(pending(rows, done, key)).persist()
    n = fresh.count()
    if n:
        manifests.append(fresh, path)
    fresh.unpersist()
    return n
