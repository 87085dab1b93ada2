"""Keyed upsert that rewrites only touched buckets.

A table is stored by key bucket (a hash of the key, a partition column). An upsert reads the buckets that its
updates fall into, replaces or inserts rows there, stages the new buckets and puts them in place by dynamic
partition overwrite. All other files stay as they are. A redo file makes the replacement repeatable: an upsert that finds one
finishes it first. One writer at a time.
"""

from __future__ import annotations

import json
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.sources.snapshot import SnapshotError, _fs, exists, read_text, rename, upsert, write_text

META, REDO = "_table.json", "_redo.json"


class BucketTable:
    """Rows with a unique key, in ``buckets`` partitions below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def _meta(self) -> dict:
        return json.loads(read_text(self.spark, self.path(META)))

    def _bucketed(self, df: DataFrame, key: list[str], buckets: int) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))

    def create(self, rows: DataFrame, key: list[str], buckets: int) -> None:
        kept = self._bucketed(rows, key, buckets)
        kept.repartition("bucket").write.mode("errorifexists").partitionBy("bucket").parquet(self.path("rows"))
        write_text(self.spark, self.path(META), json.dumps({"key": key, "buckets": buckets, "schema": json.loads(kept.schema.json())}))

    def _read(self, path: str, meta: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(meta["schema"])).parquet(path)

    def read(self) -> DataFrame:
        return self._read(self.path("rows"), self._meta()).drop("bucket")

    def files(self) -> DataFrame:
        """(bucket, file) of the stored rows."""
        return self._read(self.path("rows"), self._meta()).select("bucket", F.col("_metadata.file_path").alias("file")).distinct()

    def upsert(self, updates: DataFrame) -> list[int]:
        """Insert or replace by key; returns the buckets rewritten. A key that comes twice is an error, before anything is written."""
        self.replay()
        meta = self._meta()
        key, names = meta["key"], [f["name"] for f in meta["schema"]["fields"]]
        new = self._bucketed(updates, key, meta["buckets"]).select(*names)
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # as many as there are buckets at most
        if not touched:
            return []
        old = self._read(self.path("rows"), meta).filter(F.col("bucket").isin(touched))
        stage = self.path("_stage-" + uuid.uuid4().hex)
        upsert(old, new, key).select(*names).repartition("bucket").write.partitionBy("bucket").parquet(stage)
        fresh = self.path("." + uuid.uuid4().hex)
        write_text(self.spark, fresh, json.dumps({"stage": stage}))
        rename(self.spark, fresh, self.path(REDO), replace=True)
        self.replay()
        return touched

    def replay(self) -> bool:
        """Finish an upsert whose redo file is there."""
        if not exists(self.spark, self.path(REDO)):
            return False
        stage, meta = json.loads(read_text(self.spark, self.path(REDO)))["stage"], self._meta()
        fs, _ = _fs(self.spark, self.root)
        (self._read(stage, meta).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(self.path("rows")))
        for p in (self.path(REDO), stage):
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(p), True)
        return True


__all__ = ["BucketTable", "SnapshotError"]
