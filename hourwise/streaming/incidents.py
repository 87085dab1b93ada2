"""Incidents on a stream of scored hours, by session windows.

Candidate hours of one asset that follow each other without a gap are one session: an hour opens a window as long as
the grain, and windows that meet are merged by the state store. A session is emitted (append mode) once the event-time
watermark has passed its end, so an incident that may still grow is withheld. The watermark follows all scored hours, not only
candidates: hours that are no candidates reach the aggregation too, as sessions of their own that are left out afterwards.
Late candidate hours that the watermark has passed are dropped and counted by Spark (``LateRows``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.functions.columns import ratio, stable_id
from hourwise.operators.incidents import INCIDENT_COLUMNS
from hourwise.operators.rule import mark_report_overlap
from hourwise.session import ensure_utc
from hourwise import spec as S
from hourwise.spec import RuleSpec


def session_incidents(scored: DataFrame, spec: RuleSpec, watermark: str = "1 hour", keys: list[str] | None = None) -> DataFrame:
    """Incidents of a stream (or a table) of scored hours with the investigation columns."""
    keys = list(keys or [])
    hit = F.col("candidate_status") == S.REVIEW_PRESSURE
    agg = (scored.withColumn("_et", F.col("hour_ts").cast("timestamp")).withColumn("_hit", hit).withWatermark("_et", watermark)
           .groupBy(*keys, "_hit", F.session_window("_et", f"{spec.grain_seconds} seconds").alias("_s"))
           .agg(F.min("hour_ts").alias("starts_at"), F.max("hour_ts").alias("_last"), F.count(F.lit(1)).cast("int").alias("candidate_hours"),
                *[F.sum(c).cast("bigint").alias(c) for c in ("readings", "loaded_readings", "low_pressure_loaded_readings")],
                F.max("current_low_fraction").alias("peak_hour_share"),
                F.bool_or("overlaps_reported_failure").alias("overlaps_reported_failure"),
                # a filter on the grouping column itself would be pushed below the watermark
                F.bool_or("_hit").alias("_any_hit")))
    return (agg.filter("_any_hit").withColumn("ends_at", F.col("_last") + F.expr(f"INTERVAL {spec.grain_seconds} SECONDS"))
            .withColumn("incident_id", stable_id(spec.incident_prefix, spec.version, F.col("starts_at"), keys))
            .withColumn("low_pressure_share", ratio("low_pressure_loaded_readings", "loaded_readings"))
            .withColumn("rule_version", F.lit(spec.version)).select(*keys, *INCIDENT_COLUMNS))


def stream_incidents(spark: SparkSession, scored: str, schema: T.StructType, sink: str, checkpoint: str, spec: RuleSpec,
                     watermark: str = "1 hour", keys: list[str] | None = None, files_per_batch: int | None = None,
                     reports: DataFrame | None = None):
    """Start the stream from a folder of scored hours (as ``stream_scored_hours`` writes it) into a parquet sink; with
    ``reports`` the hours are marked with their overlap first."""
    ensure_utc(spark)
    source = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    hours = source.parquet(scored)
    hours = mark_report_overlap(hours, reports, spec.grain_seconds) if reports is not None else hours
    q = session_incidents(hours, spec, watermark, keys).writeStream.outputMode("append")
    return q.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
