"""Session helpers.

Naive timestamps (TIMESTAMP_NTZ) are truncated via ``date_trunc`` which works in
the session time zone; the engine pins the session to UTC so no daylight-saving
shift can move an hour.  Checkpoints and written intermediate tables go to the
cluster's ``spark.checkpoint.dir``; only a local-mode session gets a scratch
default when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

UTC_CONF = "spark.sql.session.timeZone"


def ensure_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get(UTC_CONF, None) != "UTC":
        spark.conf.set(UTC_CONF, "UTC")
    return spark


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "hourwise",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config(UTC_CONF, "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         # coalesce shuffle partitions to the advisory size, not to the default parallelism
         .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false")
         # local-mode heap; override with HOURWISE_DRIVER_MEMORY (the bench container has 7 GB in total)
         .config("spark.driver.memory", os.environ.get("HOURWISE_DRIVER_MEMORY", "4g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_utc(spark)
    checkpoint_dir(spark)
    return spark


def recommended_conf(largest_shuffle_bytes: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Cluster settings sized to the largest shuffle, for a ``SparkSession.builder.config`` loop.

    On the main path the only shuffle that is not map-side combined is the exact
    duplicate-timestamp count: one 8-byte column plus a count, about 16 bytes per
    reading, so roughly 11 TB for 100 TB of raw readings at ~150 bytes/row.  The
    initial partition count keeps ~128 MiB per partition for it (≈ 85k); AQE then
    coalesces the small stages (the marts are orders of magnitude smaller) and
    splits skewed join partitions.  Scan splits are capped at 256 MiB.
    """
    initial = max(200, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        UTC_CONF: "UTC",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session (tests, this container) gets a scratch default when
    none is configured; on a cluster an unset folder is an error, because a
    driver-local path is not visible to the executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="hourwise-ckpt-", dir=os.environ.get("HOURWISE_SCRATCH", None))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def materialize(df, name: str):
    """Write ``df`` once as a parquet table under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but computes the plan a single time (a
    reliable checkpoint of an unpersisted plan computes it twice), survives
    executor loss, and the result keeps parquet column pruning and pushdown.
    """
    import posixpath
    import uuid
    spark = df.sparkSession
    path = posixpath.join(checkpoint_dir(spark), "hourwise", "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*dfs) -> None:
    """Delete the written tables behind ``materialize`` results that no later plan reads."""
    for df in dfs:
        spark, folder = df.sparkSession, None
        for file in df.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder is not None and folder.getParent().getName() == "tables":
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
