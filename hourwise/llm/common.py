"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwise.session import materialize

#: Name of the row id that operators add to a table; no input column may carry it.
ROW = "__hw_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once with a unique row id, so that the id is the same in every later scan (also
    after a lost executor or a change in the number of cores)."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), name)


def travels(module: str) -> None:
    """Executor-side functions of ``module`` go with the task, so workers need not have the package."""
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[module])


def ascii_lower(c):
    """Lower-cases A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join for which both sides are dealt out anew, so that the adaptive skew join can split a key
    that many rows share even if one side comes straight from an aggregation on the same key."""
    k = "__hw_join_key"
    add = lambda df: df.withColumn(k, F.xxhash64(*keys))
    return add(left).join(add(right), [k, *keys], how).drop(k)


def running_offsets(sums: DataFrame, key: str, bucket: str, value: str, width: int = 512) -> DataFrame:
    """(key, bucket, before): the sum of ``value`` over all lower buckets of the key. ``sums`` has a row
    for each key and bucket. Buckets are added up in groups of ``width`` first, so no task gets all
    buckets of a key."""
    from pyspark.sql import Window as W
    s = sums.withColumn("__hw_super", F.floor(F.col(bucket) / width))
    below = lambda w: F.coalesce(F.sum(value).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inner = s.withColumn("__hw_in", below(W.partitionBy(key, "__hw_super").orderBy(bucket)))
    outer = (s.groupBy(key, "__hw_super").agg(F.sum(value).alias(value))
             .withColumn("__hw_out", below(W.partitionBy(key).orderBy("__hw_super"))).drop(value))
    return (inner.join(outer, [key, "__hw_super"])
            .select(key, bucket, (F.col("__hw_in") + F.col("__hw_out")).alias("before")))
