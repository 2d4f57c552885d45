"""Debounced event sessions: batch forms, and the same as Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def debounce(events: DataFrame, keys: list[str], at: str, gap: str) -> DataFrame:
    """Sessions (keys, first, last, n): a change at least ``gap`` after the previous one starts a new session."""
    stamp = F.col(at).cast("timestamp")
    out = events.groupBy(*keys, F.session_window(stamp, gap).alias("w")).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n"))
    return out.drop("w")


def debounce_with_flush(events: DataFrame, keys: list[str], at: str, gap_seconds: int, flush: Column) -> DataFrame:
    """Sessions that also end right after a row for which ``flush`` holds (an end-of-pass mark)."""
    order = Window.partitionBy(*keys).orderBy(at)
    age = F.unix_micros(F.col(at).cast("timestamp"))
    marked = events.withColumn("__t", age).withColumn("__flush", F.coalesce(flush, F.lit(False)))
    late = F.col("__t") - F.lag("__t").over(order) >= gap_seconds * 1_000_000
    fresh = F.coalesce(late, F.lit(True)) | F.coalesce(F.lag("__flush").over(order), F.lit(False))
    numbered = marked.withColumn("__fresh", fresh.cast("int")).withColumn("__s", F.sum("__fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__s").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n"), F.bool_or("__flush").alias("flushed")).drop("__s")


def triage(messages: DataFrame, age_seconds: Column, receives: Column, max_age: int, max_receives: int) -> DataFrame:
    """``messages`` with a verdict: expired (too old), dead (received too often) or live."""
    return messages.withColumn("verdict", F.when(age_seconds > max_age, "expired").when(receives > max_receives, "dead").otherwise("live"))


def event_stream(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 1) -> DataFrame:
    """A file stream of Parquet events."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def debounce_stream(events: DataFrame, keys: list[str], at: str, gap: str, lateness: str) -> DataFrame:
    """``debounce`` over a stream: a session is emitted when the watermark passes its end; later rows are dropped."""
    timed = events.withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", lateness)
    return timed.groupBy(*keys, F.session_window("__at", gap).alias("w")).agg(F.min("__at").alias("first"), F.max("__at").alias("last"), F.count(F.lit(1)).alias("n")).drop("w")


def dedupe_stream(events: DataFrame, ident: str, at: str, lateness: str) -> DataFrame:
    """The first row of each id; ids are forgotten behind the watermark."""
    return events.withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", lateness).dropDuplicatesWithinWatermark([ident]).drop("__at")


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available and write it as Parquet, exactly once under the checkpoint."""
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()
