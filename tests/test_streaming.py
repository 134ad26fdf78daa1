"""E-03: the streaming monitor gives the same windows as the batch form."""

import os
import shutil

from pyspark.sql import functions as F

from hearth.streaming.monitor import start_monitor, windowed_counts

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    events = spark.read.parquet(EVENTS)
    # two files, the second re-delivers a slice of the first (de-duplicated in the stream)
    events.write.parquet(os.path.join(src, "part1"))
    shutil.copytree(os.path.join(src, "part1"), os.path.join(src, "part2"))
    q = start_monitor(spark, os.path.join(src, "*"), os.path.join(tmpdir_path, "out"),
                      os.path.join(tmpdir_path, "ckpt"), events.schema, trigger_once=True)
    q.awaitTermination(300)
    got = {tuple(r) for r in spark.read.parquet(os.path.join(tmpdir_path, "out")).collect()}
    # append mode emits a window once the watermark (max event time - 10 min) has passed its end;
    # the re-delivered copy must not change any count
    max_ts = events.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    closed = F.to_timestamp("window_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES")
    expected = {tuple(r) for r in windowed_counts(events).filter(closed).collect()}
    assert expected and got == expected
