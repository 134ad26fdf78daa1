"""E-03 claims monitor on a stream.

``readStream`` over a folder of event files -> event-time watermark ->
de-duplication of redelivered events within the watermark -> hourly
tumbling-window counts per event type -> append to a sink.  State is kept
in the checkpoint folder, so a restarted job (or a lost executor) resumes
from the last committed batch; late events older than the watermark are
dropped by design.

``windowed_counts`` is the same aggregation over a static DataFrame; it is
what the registered query runs on the supplied ``events`` table, and the
streaming test checks that both give the same windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Fixed values of the monitor: window length and allowed lateness.
WINDOW = "1 hour"
WATERMARK = "10 minutes"


def event_time(df: DataFrame) -> DataFrame:
    """Watermarks need a TIMESTAMP event time; a wall-clock TIMESTAMP_NTZ is
    read in the session time zone (UTC in our sessions), so windows keep
    their wall-clock boundaries."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def _aggregate(df: DataFrame) -> DataFrame:
    return (event_time(df).groupBy(F.window("ts", WINDOW).alias("w"), "event_type")
              .agg(F.count(F.lit(1)).alias("events"),
                   F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"))
              .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "event_type", "events", "total_value"))


def windowed_counts(events: DataFrame) -> DataFrame:
    """Batch form: hourly tumbling windows over the whole table."""
    return _aggregate(events)


def start_monitor(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                  schema, trigger_once: bool = False) -> StreamingQuery:
    """Start the streaming monitor.  ``checkpoint_dir`` must be on shared,
    reliable storage on a cluster (it holds offsets and window state)."""
    stream = (event_time(spark.readStream.schema(schema).parquet(source_dir))
              .withWatermark("ts", WATERMARK)
              .dropDuplicatesWithinWatermark(["event_id"]))
    out = (stream.groupBy(F.window("ts", WINDOW).alias("w"), "event_type")
                 .agg(F.count(F.lit(1)).alias("events"),
                      F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"))
                 .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                         "event_type", "events", "total_value"))
    w = (out.writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", checkpoint_dir).option("path", sink_dir))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()
