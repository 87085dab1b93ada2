"""Gaps and islands over candidate hours (W2/W3) -> stable incidents.

The textbook form (LAG + running SUM ordered by time) needs one global order.
Here the order is only needed inside calendar chunks:

1. rows are partitioned by ``(keys, chunk)``; the last step of the previous
   chunk is copied in as a halo so ``lag`` sees across the boundary;
2. an island starts where the previous candidate is not exactly one step back;
3. each row's island start is the running max of starts inside its chunk, or,
   when its chunk has no earlier start, the last start of an earlier chunk
   (a prefix max over a per-chunk table with one row per chunk and key).

Every step is partitioned by ``(keys, chunk)`` or by ``(keys, island)``; the
only key-wide window runs over the tiny per-chunk table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwise.functions.columns import join_keys, ratio, stable_id
from hourwise.operators.baseline import CHUNK_DAYS, chunk_with_halo
from hourwise.session import materialize
from hourwise import spec as S
from hourwise.spec import RuleSpec

INCIDENT_COLUMNS = ["incident_id", "starts_at", "ends_at", "candidate_hours", "readings", "loaded_readings",
                    "low_pressure_loaded_readings", "low_pressure_share", "peak_hour_share",
                    "overlaps_reported_failure", "rule_version"]


def assign_islands(flagged: DataFrame, keys: list[str] | None = None, ts: str = "hour_ts",
                   step_seconds: int = 3600, chunk_days: int = CHUNK_DAYS,
                   out: str = "island_start", max_gap_micros: int | None = None,
                   materialize_input: bool = True) -> DataFrame:
    """Add ``out`` = first timestamp of the run each row belongs to.

    Default: a run is a sequence of rows exactly ``step_seconds`` apart.  With
    ``max_gap_micros``: consecutive rows closer than that many microseconds
    continue a run (session-style segmentation, any timestamp precision).
    ``materialize_input=False`` skips writing the input when it is already a cheap
    read of written tables.
    """
    keys = list(keys or [])
    micros = max_gap_micros is not None
    halo = -(-max_gap_micros // 1_000_000) if micros else step_seconds
    # the rows feed two branches (in-chunk scan and per-chunk carry): written once, so the
    # upstream lineage (the raw aggregation) is not recomputed per branch
    if materialize_input:
        flagged = materialize(flagged, "islands_input")
    chunked = chunk_with_halo(flagged, ts, halo, chunk_days * 86400, micros=micros)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_ep")
    prev = F.lag("_ep").over(w)
    breaks = (F.col("_ep") - prev >= F.lit(max_gap_micros)) if micros else (prev != F.col("_ep") - F.lit(step_seconds))
    marked = chunked.withColumn("_start", F.col("_home") & (prev.isNull() | breaks))
    running = F.max(F.when(F.col("_start"), F.col("_ep"))).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = marked.withColumn("_local", running).filter("_home")

    per_chunk = (local.groupBy(*keys, "_chunk")
                 .agg(F.max(F.when(F.col("_start"), F.col("_ep"))).alias("_chunk_last")))
    carry = per_chunk.select(*keys, "_chunk", F.max("_chunk_last").over(
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    joined = join_keys(local, carry, [*keys, "_chunk"], "left")
    start_ep = F.coalesce(F.col("_local"), F.col("_carry"))
    as_ts = F.timestamp_micros(start_ep) if micros else F.timestamp_seconds(start_ep)
    return (joined.withColumn(out, as_ts.cast("timestamp_ntz"))
            .drop("_ep", "_chunk", "_home", "_start", "_local", "_carry"))


def incidents(investigation: DataFrame, spec: RuleSpec, keys: list[str] | None = None,
              chunk_days: int = CHUNK_DAYS, materialize_input: bool = True) -> DataFrame:
    keys = list(keys or [])
    flagged = investigation.filter(F.col("candidate_status") == S.REVIEW_PRESSURE)
    isl = assign_islands(flagged, keys, "hour_ts", spec.grain_seconds, chunk_days,
                         materialize_input=materialize_input)
    agg = (isl.groupBy(*keys, "island_start")
           .agg(F.min("hour_ts").alias("starts_at"),
                (F.max("hour_ts") + F.expr(f"INTERVAL {spec.grain_seconds} SECONDS")).alias("ends_at"),
                F.count(F.lit(1)).cast("int").alias("candidate_hours"),
                F.sum("readings").cast("bigint").alias("readings"),
                F.sum("loaded_readings").cast("bigint").alias("loaded_readings"),
                F.sum("low_pressure_loaded_readings").cast("bigint").alias("low_pressure_loaded_readings"),
                F.max("current_low_fraction").alias("peak_hour_share"),
                F.bool_or("overlaps_reported_failure").alias("overlaps_reported_failure")))
    return (agg.withColumn("incident_id", stable_id(spec.incident_prefix, spec.version, F.col("starts_at"), keys))
            .withColumn("low_pressure_share", ratio("low_pressure_loaded_readings", "loaded_readings"))
            .withColumn("rule_version", F.lit(spec.version))
            .select(*keys, *INCIDENT_COLUMNS))
