"""Digests of files of any size by byte ranges (S14, S18): one rule, and no row or task that holds a file.

Spark lists the files (paths and lengths, no content); each is cut into ranges of ``range_bytes``, which are dealt over the
cluster. A task reads its ranges from the shared store in pieces and gives SHA-256 digests; a file's digest is ``tree-`` and the
SHA-256 of its ranges' hexadecimal digests in order. It depends on ``range_bytes`` only, not on splits, blocks or cores.

Tasks open files themselves, through Arrow's file systems (local and mounted paths, s3, gs, hdfs); stores that only
Hadoop's readers know are left to ``snapshot.file_digests``.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES, PIECE = 64 << 20, 1 << 20


def _ship_by_value() -> None:
    """Tasks need no installed copy of the package."""
    import sys
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()


def range_sha256(uri: str, start: int, size: int) -> str:
    """SHA-256 of a range of a file, read piece by piece."""
    from pyarrow import fs
    local = re.sub(r"^file:/+", "/", uri)  # listed paths are not escaped
    store, path = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(uri)
    h = hashlib.sha256()
    with store.open_input_file(path) as f:
        f.seek(start)
        while size > 0 and (piece := f.read(min(PIECE, size))):
            h.update(piece)
            size -= len(piece)
    if size:
        raise OSError(f"{uri} is shorter than it was when it was listed")
    return h.hexdigest()


def _hashed(batches):
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size")))
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("start"), pa.array([range_sha256(*r) for r in rows], pa.string())],
                                         names=["path", "start", "h"])


def file_ranges(spark: SparkSession, path: str | list[str], glob: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, bytes, start, size) of all ranges. Spark's file readers leave empty files out, and so does this."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (r.option("pathGlobFilter", glob) if glob else r).load(path).filter("length > 0").select("path", F.col("length").alias("bytes"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))
    return (files.select("path", "bytes", F.explode(starts).alias("start"))
            .withColumn("size", F.least(F.lit(range_bytes).cast("long"), F.col("bytes") - F.col("start"))))


def range_digests(spark: SparkSession, path: str | list[str], glob: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, bytes, sha256)`` of every file, the digest over its byte ranges."""
    ranges = file_ranges(spark, path, glob, range_bytes)
    hashed = ranges.select("path", "start", "size").repartition("path", "start").mapInArrow(_hashed, "path string, start long, h string")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("start", "h"))), lambda x: x["h"])
    tree = hashed.groupBy("path").agg(F.concat(F.lit("tree-"), F.sha2(F.array_join(listed, "").cast("binary"), 256)).alias("sha256"))
    return ranges.filter("start = 0").select("path", "bytes").join(tree, "path")
