"""Stream deduplication and a table of late rows (A5, X5): nothing is dropped without a trace.

``split_late`` runs first: each micro-batch is split, by ``foreachBatch``, into rows on time and rows that the watermark
has passed, with Spark's own rule (the greatest event time of earlier batches less the delay, which is kept beside the
tables). Folders carry the batch id and are overwritten on retry, so a replayed batch changes nothing. ``deduplicated``
then reads the rows on time and keeps the first of each id with ``dropDuplicatesWithinWatermark``; since its triggers see
batches in the same order, its watermark never passes a row that was on time. So kept + duplicate + late = input.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwise.functions.columns import ntz_lit
from hourwise.session import ensure_utc
from hourwise.sources.snapshot import exists

ON_TIME, LATE, MARKS = "on_time", "late", "_watermarks"


def split_late(stream: DataFrame, ts: str, root: str, checkpoint: str, delay_seconds: int):
    """Start the split of a stream with event time ``ts`` into the tables ``on_time`` and ``late`` below ``root``; rows without a
    time count as late."""
    spark = ensure_utc(stream.sparkSession)
    marks = posixpath.join(root, MARKS)

    def split(batch: DataFrame, batch_id: int) -> None:
        earlier = None
        if exists(spark, marks):
            earlier = (spark.read.schema("at timestamp_ntz, batch_id long").parquet(marks).filter(F.col("batch_id") < batch_id)
                       .agg(F.max("at").alias("at")).first().at)
        passed = F.lit(False) if earlier is None else F.col(ts) < ntz_lit(earlier) - F.expr(f"INTERVAL {delay_seconds} SECONDS")
        marked = batch.withColumn("_late", F.col(ts).isNull() | passed)
        own = lambda name: posixpath.join(root, name, f"batch_id={batch_id}")
        whole = own("_batch")
        marked.write.mode("overwrite").parquet(whole)  # the only run of the batch's plan
        marked = spark.read.schema(marked.schema).parquet(whole)
        marked.filter("_late").drop("_late").write.mode("overwrite").parquet(own(LATE))
        marked.filter("NOT _late").drop("_late").write.mode("overwrite").parquet(own(ON_TIME))
        marked.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("at")).write.mode("overwrite").parquet(own(MARKS))

    return stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(spark: SparkSession, root: str, schema, ids: list[str], ts: str, sink: str, checkpoint: str, delay_seconds: int):
    """Start the stream of the first row of each id among the rows on time below ``root``."""
    ensure_utc(spark)
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(posixpath.join(root, ON_TIME))
    kept = (rows.withColumn("_et", F.col(ts).cast("timestamp")).withWatermark("_et", f"{delay_seconds} seconds")
            .dropDuplicatesWithinWatermark(ids).drop("_et"))
    return (kept.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())


def balance(spark: SparkSession, root: str, kept: str, schema) -> DataFrame:
    """One row (kept, duplicate, late) of row counts."""
    n = lambda path: (spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
                      .agg(F.count(F.lit(1)).alias("n")))
    parts = (n(kept).withColumn("what", F.lit("kept")).unionByName(n(posixpath.join(root, ON_TIME)).withColumn("what", F.lit("on_time")))
             .unionByName(n(posixpath.join(root, LATE)).withColumn("what", F.lit("late"))))
    total = lambda w: F.coalesce(F.sum(F.when(F.col("what") == w, F.col("n"))), F.lit(0))
    return parts.agg(total("kept").alias("kept"), (total("on_time") - total("kept")).alias("duplicate"), total("late").alias("late"))
