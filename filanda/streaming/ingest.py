"""Structured Streaming twins: files ingested once by content, and events counted in windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_windows(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """``hour, event_type, events, value``: tumbling windows; with a watermark where ``events`` is a stream. ``ts`` without zone is read as UTC."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark("ts", late)
    g = e.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("value"))
    return g.select(F.col("w.start").alias("hour"), "event_type", "events", "value")


def batches_below(spark: SparkSession, target: str) -> list[str]:
    """The batch folders of a target on any Hadoop file system; none where the target does not exist yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith("batch="))


def ingest_new_files(spark: SparkSession, incoming: str, target: str, checkpoint: str, schema: str) -> StreamingQuery:
    """Reads the Parquet files that arrived in ``incoming`` since the last run, and appends the rows whose ``(doc_id, file_hash)``
    the target does not hold.

    A batch is written below ``batch=<number>`` in overwrite mode: one that is tried again replaces itself, so no row comes twice after a failure.
    """
    stream = spark.readStream.schema(schema).parquet(incoming)

    def write(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        new = batch.dropDuplicates(["doc_id", "file_hash"])
        done = [d for d in batches_below(s, target) if not d.endswith(f"/batch={number}")]
        if done:
            new = new.join(s.read.schema(schema).parquet(*done).select("doc_id", "file_hash").distinct(), ["doc_id", "file_hash"], "left_anti")
        new.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
