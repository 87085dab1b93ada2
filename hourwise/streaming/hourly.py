"""Structured Streaming re-aims of the periodic mart rebuild.

X5 ``stream_hourly_mart``: file source -> readings adapter -> event-time
watermark -> tumbling 1-hour windows with the hourly-mart aggregates, append
mode.  Watermarks need TIMESTAMP (LTZ): the naive time is cast under the UTC
session and cast back to TIMESTAMP_NTZ on output.  An hour is emitted once the
watermark passes its end, so the newest open hour is withheld; rows later than
the watermark are dropped by Spark and counted in the query progress
(``numRowsDroppedByWatermark``), which is why the batch rebuild stays the
source of truth.

X6 ``stream_scored_hours``: ``foreachBatch`` appends each batch of finalised
hours to an hourly table (folders by day and batch id, overwritten on retry, so a
replayed batch is idempotent) and scores the new hours with the trailing
baseline over the stored hours of the look-back window, whose day folders are all it lists.
"""

from __future__ import annotations

import datetime as dt
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from hourwise.functions.columns import join_keys
from hourwise.operators.marts import HOURLY_COLUMNS, state_predicates
from hourwise.operators.rule import candidate_hours
from hourwise.session import ensure_utc
from hourwise.sources.readings import readings_from_events
from hourwise.sources.snapshot import exists
from hourwise.spec import RuleSpec


def _hourly_stream(spark: SparkSession, source: str, spec: RuleSpec, watermark: str,
                   keys: list[str] | None = None, glob: str | None = None) -> DataFrame:
    """``source`` is the watched directory; ``glob`` narrows it to the event files."""
    ensure_utc(spark)
    keys = list(keys or [])
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    schema = reader.parquet(source).schema
    sr = spark.readStream.schema(schema)
    if glob:
        sr = sr.option("pathGlobFilter", glob)
    ev = sr.parquet(source)
    rd = readings_from_events(ev).withColumn("_et", F.col("observed_at").cast("timestamp"))
    p = state_predicates(spec)
    gap = F.abs(F.col("tp3") - F.col("reservoirs"))
    agg = (rd.withWatermark("_et", watermark)
           .groupBy(*keys, F.window("_et", "1 hour").alias("_w"))
           .agg(F.count(F.lit(1)).alias("readings"), F.sum("tp3").alias("panel_pressure_sum"),
                F.sum("oil_temperature").alias("oil_temperature_sum"), F.sum(gap).alias("pressure_gap_sum"),
                F.avg("tp3").alias("avg_panel_pressure_bar"), F.avg("reservoirs").alias("avg_reservoir_pressure_bar"),
                F.avg("motor_current").alias("avg_motor_current_a"),
                F.avg("oil_temperature").alias("avg_oil_temperature_c"), F.avg(gap).alias("avg_pressure_gap_bar"),
                F.count_if(p["loaded"]).alias("loaded_readings"), F.count_if(p["unloaded"]).alias("unloaded_readings"),
                F.count_if(p["idle"]).alias("idle_readings"),
                F.count_if(p["low"]).alias("low_pressure_loaded_readings"),
                F.count_if(F.col("lps") == 1).alias("lps_active_readings")))
    return agg.withColumn("hour_ts", F.col("_w.start").cast("timestamp_ntz")).select(*keys, *HOURLY_COLUMNS)


def stream_hourly_mart(spark: SparkSession, source: str, sink: str, checkpoint: str, spec: RuleSpec,
                       watermark: str = "10 minutes", keys: list[str] | None = None, available_now: bool = True,
                       glob: str | None = None):
    """Start the streaming hourly mart into a parquet sink; returns the StreamingQuery."""
    q = (_hourly_stream(spark, source, spec, watermark, keys, glob).writeStream
         .outputMode("append").format("parquet").option("path", sink).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def stream_scored_hours(spark: SparkSession, source: str, out_root: str, checkpoint: str, spec: RuleSpec,
                        watermark: str = "10 minutes", available_now: bool = True, glob: str | None = None,
                        keys: list[str] | None = None):
    """foreachBatch scoring of finalised hours; returns the StreamingQuery."""
    hourly_dir, scored_dir = posixpath.join(out_root, "hourly"), posixpath.join(out_root, "scored")
    incoming, keys = posixpath.join(out_root, "_incoming"), list(keys or [])
    reach = -(-spec.lookback_seconds // 86400)

    def score(batch: DataFrame, batch_id: int) -> None:
        mine, kind = posixpath.join(incoming, f"batch_id={batch_id}"), batch.schema
        batch.write.mode("overwrite").parquet(mine)  # the only run of the batch's plan
        new = spark.read.schema(kind).parquet(mine)
        days = sorted(r.day for r in new.select(F.to_date("hour_ts").alias("day")).distinct().collect())
        if not days:
            return
        # a replayed batch replaces its own part of each day
        (new.withColumns({"day": F.to_date("hour_ts"), "batch_id": F.lit(batch_id)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(hourly_dir))
        # only the folders of these days and of their look-back are listed
        needed = sorted({d - dt.timedelta(days=i) for d in days for i in range(reach + 1)})
        there = [p for d in needed if exists(spark, p := posixpath.join(hourly_dir, f"day={d}"))]
        hist = spark.read.schema(kind).option("basePath", hourly_dir).parquet(*there)
        scored = join_keys(candidate_hours(hist, spec, keys), new.select(*keys, "hour_ts"), [*keys, "hour_ts"], "left_semi")
        scored.write.mode("overwrite").parquet(posixpath.join(scored_dir, f"batch_id={batch_id}"))

    q = (_hourly_stream(spark, source, spec, watermark, keys, glob).writeStream.outputMode("append")
         .foreachBatch(score).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def _late(progress) -> int:
    ops = progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators
    return sum(int(op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark) for op in ops)


def dropped_late_rows(query) -> int:
    """Rows the watermark dropped as too late in the newest progress reports that the query keeps
    (``spark.sql.streaming.numRecentProgressUpdates``, 100 by default). ``LateRows`` counts all of them."""
    return sum(map(_late, query.recentProgress))


class LateRows(StreamingQueryListener):
    """Rows dropped as too late by each query over its whole life. Add it with ``spark.streams.addListener`` before the
    query starts."""

    def __init__(self):
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.by_query.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        key = str(event.progress.id)
        self.by_query[key] = self.by_query.get(key, 0) + _late(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
