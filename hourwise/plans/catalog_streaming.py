"""Registered streaming queries (X5, X6): run with an availableNow trigger over
the events file source, then read the sink back.  Sinks and checkpoints live
below the shared checkpoint folder."""

from __future__ import annotations

import posixpath

from hourwise.plans import oracle as O
from hourwise.plans.catalog import CAND_DOUBLES, HOURLY_DOUBLES, SPEC, _sql, query
from hourwise.plans.catalog_sources import scratch
from hourwise.streaming.hourly import stream_hourly_mart, stream_scored_hours

_FINAL = "hour_ts + INTERVAL 1 HOUR <= (SELECT MAX(observed_at) FROM readings) - INTERVAL 10 MINUTE"


def events_source(spark, d):
    """(folder to watch, glob) of the events, be they one file or a folder of files."""
    jvm = spark.sparkContext._jvm
    table = jvm.org.apache.hadoop.fs.Path(posixpath.join(d, "events.parquet"))
    folder = table.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(table).isDirectory()
    return (table.toString(), "*.parquet") if folder else (d, "events.parquet")


@query("stream_hourly_mart", _sql(O.chain(upto="hourly"), f"SELECT * FROM hourly WHERE {_FINAL}", HOURLY_DOUBLES))
def q_stream_hourly_mart(spark, d):
    """Streaming hourly mart (watermark 10 min, append): every hour whose end the watermark passed."""
    root, (source, glob) = scratch(spark, "stream"), events_source(spark, d)
    sink = posixpath.join(root, "hourly")
    q = stream_hourly_mart(spark, source, sink, posixpath.join(root, "_checkpoint"), SPEC, glob=glob)
    q.awaitTermination()
    return spark.read.parquet(sink)


@query("stream_hourly_mart_by_asset", _sql(O.chain(["asset_id"], upto="hourly"), f"SELECT * FROM hourly WHERE {_FINAL}",
                                           HOURLY_DOUBLES))
def q_stream_hourly_mart_by_asset(spark, d):
    """X5 per asset: tumbling hourly windows grouped by asset, one global event-time watermark."""
    root, (source, glob) = scratch(spark, "stream-asset"), events_source(spark, d)
    sink = posixpath.join(root, "hourly")
    q = stream_hourly_mart(spark, source, sink, posixpath.join(root, "_checkpoint"), SPEC, keys=["asset_id"],
                           glob=glob)
    q.awaitTermination()
    return spark.read.parquet(sink)


@query("stream_scored_hours", _sql(O.chain(upto="candidates"), f"SELECT * FROM candidates WHERE {_FINAL}",
                                   CAND_DOUBLES))
def q_stream_scored_hours(spark, d):
    """foreachBatch scoring of finalised hours against the stored 7-day history."""
    root, (source, glob) = scratch(spark, "stream-scored"), events_source(spark, d)
    q = stream_scored_hours(spark, source, root, posixpath.join(root, "_checkpoint"), SPEC, glob=glob)
    q.awaitTermination()
    return spark.read.parquet(posixpath.join(root, "scored")).drop("batch_id")

