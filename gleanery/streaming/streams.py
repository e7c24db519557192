"""Structured Streaming: resuming, upserts, first-seen rows, event-time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.state import latest_by


def read_stream(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(kind)
    return (r.option("maxFilesPerTrigger", per_trigger) if per_trigger else r).load(path)


def drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Processes what is there, batch by batch, and ends; run again it takes up where it ended."""
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def upsert_latest(stream: DataFrame, key: str, seq: str, table: str, checkpoint: str) -> None:
    """Keeps the last row per key under ``table``, a folder per batch; a batch that runs twice writes the same folder again."""

    def each(batch: DataFrame, number: int) -> None:
        latest_by(batch, key, seq).drop("first_seq").write.mode("overwrite").parquet(f"{table}/batch={number}")

    drain(stream, each, checkpoint)


def latest_view(spark: SparkSession, table: str, key: str, seq: str) -> DataFrame:
    """The last row per key over all batches."""
    return latest_by(spark.read.parquet(table).drop("batch"), key, seq).drop("first_seq")


def compact(spark: SparkSession, table: str, key: str, seq: str) -> None:
    """Writes the last row per key as the only batch of a table that no stream is writing to; its readers see the old or the new files, never a mix.

    The new batch has the number of the last one, so a stream that goes on writes after it.
    """
    batches = [int(r[0]) for r in spark.read.parquet(table).select("batch").distinct().collect()]
    last = max(batches)
    path = lambda n: spark._jvm.org.apache.hadoop.fs.Path(n)
    system = path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    new, old = path(f"{table}.compacted/batch={last}"), path(f"{table}.old")
    latest_view(spark, table, key, seq).write.mode("overwrite").parquet(new.toString())
    system.rename(path(table), old)
    system.rename(path(f"{table}.compacted"), path(table))
    system.delete(old, True)


def first_seen(stream: DataFrame, keys: list[str], ts: str | None = None, late: str = "1 hour") -> DataFrame:
    """Rows whose key has not come before; with an event time the state is bounded by the watermark."""
    if ts is None:
        return stream.dropDuplicates(keys)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, ts: str, by: list[str], size: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts per tumbling or sliding window, of a stream or a table; a stream drops what is later than the watermark."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark(ts, late)
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return e.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")


def sessions(events: DataFrame, ts: str, by: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Counts per session: events of a key that follow each other within the gap."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark(ts, late)
    return e.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def drain_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Writes a stream's rows to Parquet under ``path`` and ends when all there was is written."""
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
