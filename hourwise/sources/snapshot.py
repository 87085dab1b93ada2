"""Snapshots: ordered export (S13), file digests (S14), publish with gate and
manifest (S7, S9, S15, S16, S17, Q17), verified read (S18), JSON rows (S21).

Tables are written by Spark (distributed, range-partitioned when ordered) into
a staging folder under the snapshot root, digested on the executors into a
table of files, described by a small manifest, moved into place with one
rename, and published by replacing the ``CURRENT`` pointer by a rename last.
File-system calls go through the Hadoop FileSystem API so the same code works
on HDFS / object stores; only the manifest and pointer (a few hundred bytes)
are written from the driver.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.functions.columns import ntz_lit, truthy
from hourwise.session import materialize
from hourwise.sources.csv_ingest import fixed_splits, numbered_lines, split_table

MANIFEST = "provenance.json"
POINTER = "CURRENT"
#: The table of part files and digests beside a manifest (hidden from readers of the folder).
FILES = "_files"
#: Files up to this size are digested in one row; lines of a chunk of larger ones.
WHOLE_BYTES, CHUNK_LINES = 1 << 30, 1 << 16


class SnapshotError(ValueError):
    pass


# ---------------------------------------------------------------- Hadoop FS helpers

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Small control files (pointer, manifest) read on the driver through the FileSystem API."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        lines = []
        while True:
            line = reader.readLine()
            if line is None:
                return "\n".join(lines)
            lines.append(line)
    finally:
        reader.close()


def rename(spark: SparkSession, src: str, dst: str, replace: bool = False) -> None:
    """Atomic rename. Without ``replace`` an existing target is an error, never a folder to move into."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    _, s = _fs(spark, src)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = sc._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if replace else kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(s.toUri(), sc._jsc.hadoopConfiguration()).rename(
            s, jvm.org.apache.hadoop.fs.Path(dst), how)
    except Exception as e:
        raise SnapshotError(f"cannot move {src} to {dst}: {str(e)[:200]}") from e


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


# ---------------------------------------------------------------- S13 / S14 / S21

def export_ordered(df: DataFrame, order: list[str], path: str, fmt: str = "csv", observed: tuple | None = None) -> None:
    """Key-ordered export (range-partitioned sort; part files in key order).

    ``observed`` is (Observation, aggregates): they are taken from the rows as they are written, above the sort, whose
    sampling would run what is below it once more.
    """
    rows = df.orderBy(*order)
    w = (rows.observe(observed[0], *observed[1]) if observed else rows).write.mode("errorifexists")
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    else:
        w.parquet(path)


def file_digests(spark: SparkSession, path: str, glob: str | None = None, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``(path, name, bytes, sha256)`` per file; digests computed on the executors.

    A file of up to ``whole_bytes`` gets its SHA-256. A larger one, which no single row can hold, gets
    ``tree-`` and the SHA-256 of the digests of its chunks of ``CHUNK_LINES`` lines (see ``tree_digests``).
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    out = df.filter(F.col("length") <= whole_bytes).select(
        "path", name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = [x.path for x in df.filter(F.col("length") > whole_bytes).select("path").collect()]  # one short row per large file
    if not large:
        return out
    sizes = df.filter(F.col("length") > whole_bytes).select("path", name, F.col("length").alias("bytes"))
    trees = tree_digests(spark, large).withColumnRenamed("path", "key")
    return out.unionByName(sizes.withColumn("key", _plain(F.col("path"))).join(trees, "key").drop("key"))


def _plain(path):
    """A file's path in one spelling: one slash after the scheme."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def tree_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sha256), the path as ``_plain`` has it, of files of any size: lines (bytes between line feeds) are hashed, then chunks of line hashes,
    then the chunks' hashes. The result does not depend on splits."""
    with fixed_splits(spark):
        lines = numbered_lines(spark, paths, split_table(spark, paths))
        file = _plain(F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B"))))
        x = lines.select(file.alias("path"), F.floor(F.col("line_no") / CHUNK_LINES).alias("chunk"),
                         F.struct("line_no", F.sha2(F.col("value").cast("binary"), 256).alias("h")).alias("line"))
        joined = lambda rows: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda r: r["h"]), "")
                                     .cast("binary"), 256)
        chunks = x.groupBy("path", "chunk").agg(joined("line").alias("h"))
        files = chunks.select("path", F.struct("chunk", "h").alias("c")).groupBy("path").agg(joined("c").alias("h"))
        return materialize(files.select("path", F.concat(F.lit("tree-"), "h").alias("sha256")), "tree_digests")


def source_digest(spark: SparkSession, path: str, glob: str | None = None) -> str:
    """Digest of a source that is one file or a folder of files: the file's own, or that of its sorted list."""
    files = file_digests(spark, path, glob).select(F.regexp_replace("path", r"^[a-z]+:/+", "/").alias("path"), "sha256")
    listed = F.array_sort(F.collect_list(F.struct("path", "sha256")))
    x = files.agg(F.count(F.lit(1)).alias("n"), F.first("sha256").alias("one"), F.sha2(F.array_join(
        F.transform(listed, lambda f: F.concat_ws(" ", F.element_at(F.split(f["path"], "/"), -1), f["sha256"])), "\n").cast("binary"), 256)
        .alias("all")).first()
    if not x.n:
        raise SnapshotError(f"no file at {path}")
    return x.one if x.n == 1 else x["all"]


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON document per row, NULL fields kept (``ignoreNullFields=false``)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))


# ---------------------------------------------------------------- S9 / S17

def provenance_row(readings: DataFrame, run_id: str, source_name: str, source_sha256: str | None,
                   complete: bool, loaded_at=None) -> DataFrame:
    """The singleton load-state row (counts/bounds computed, identity passed in)."""
    per_ts = readings.groupBy("observed_at").agg(F.count(F.lit(1)).alias("_n"))
    return per_ts.agg(
        F.lit(run_id).alias("run_id"), F.lit(source_sha256).cast("string").alias("source_sha256"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("original_rows"),
        ntz_lit(loaded_at).alias("loaded_at"), F.lit(source_name).alias("source_name"),
        F.lit(complete).alias("is_complete_source"),
        F.min("observed_at").alias("first_reading"), F.max("observed_at").alias("last_reading"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count("observed_at")).cast("bigint").alias("duplicate_timestamps"))


# ---------------------------------------------------------------- S7 / S15 / Q17

def reconcile_counts(readings: DataFrame, hourly: DataFrame, daily: DataFrame) -> DataFrame:
    from hourwise.operators.period import combine_rows
    return combine_rows(readings.agg(F.count(F.lit(1)).alias("raw_rows")),
                        hourly.agg(F.coalesce(F.sum("readings"), F.lit(0)).cast("bigint").alias("hourly_rows")),
                        daily.agg(F.coalesce(F.sum("readings"), F.lit(0)).cast("bigint").alias("daily_rows")))


def publish_snapshot(spark: SparkSession, root: str, snapshot_id: str, tables: dict[str, tuple[DataFrame, list[str]]],
                     state: dict, counts, rule: dict, exported_at: str | None = None, observed: dict | None = None) -> str:
    """Gate, then everything into a staging folder of its own, then one rename, then the pointer.

    ``counts`` may be a function: then the gate asks it once the tables are staged, so that counts can be observed in the
    writing jobs themselves (``observed``: (Observation, aggregates) by table). A refused staging folder is deleted.
    """
    folder = posixpath.join(root, "snapshots", snapshot_id)
    _gate(state, {} if callable(counts) else counts)
    if not snapshot_id or snapshot_id[0] in "._" or "/" in snapshot_id:
        raise SnapshotError(f"invalid snapshot id {snapshot_id!r}")
    if exists(spark, folder):
        raise SnapshotError(f"snapshot {snapshot_id} exists already; ids are never reused")
    staging = posixpath.join(root, "snapshots", f".{snapshot_id}-{uuid.uuid4().hex}")
    for name, (df, order) in tables.items():
        export_ordered(df, order, posixpath.join(staging, name), observed=(observed or {}).get(name))
    if callable(counts):
        try:
            _gate(state, counts())
        except SnapshotError:
            fs, p = _fs(spark, staging)
            fs.delete(p, True)
            raise
    _relative(file_digests(spark, staging, "part-*")).write.parquet(posixpath.join(staging, FILES))
    described = {name: {"order_by": order, "schema": df.schema.simpleString()[7:-1]} for name, (df, order) in tables.items()}
    manifest = {
        "schema_version": 3, "snapshot_id": snapshot_id, "rule": rule, "tables": described, "file_table": FILES,
        "source": state.get("source_name"), "original_reading_count": state["original_rows"],
        "exported_at": exported_at or now().isoformat(), "engine_version": f"Apache Spark {spark.version}",
        "timestamp_policy": "Original naive timestamps; source timezone unspecified.",
        **{k: state.get(k) for k in ("run_id", "source_sha256", "duplicate_timestamps")},
        **{k: _iso(state.get(k)) for k in ("loaded_at", "first_reading", "last_reading")},
    }
    write_text(spark, posixpath.join(staging, MANIFEST), json.dumps(manifest, indent=2, sort_keys=True))
    rename(spark, staging, folder)
    # a reader of the pointer sees the old id or the new one, never a part of it
    fresh = posixpath.join(root, f".{POINTER}-{uuid.uuid4().hex}")
    write_text(spark, fresh, snapshot_id)
    rename(spark, fresh, posixpath.join(root, POINTER), replace=True)
    return folder


def _gate(state: dict, counts: dict) -> None:
    if not (state or {}).get("is_complete_source"):
        raise SnapshotError("not a complete-source load: only whole sources are published")
    odd = {k: counts[k] for k in ("raw_rows", "hourly_rows", "daily_rows") if k in counts and int(counts[k] or 0) != state["original_rows"]}
    if odd:
        raise SnapshotError(f"row totals do not reconcile with the {state['original_rows']} rows loaded: {odd}")


def _relative(digests: DataFrame) -> DataFrame:
    return digests.select(F.regexp_extract("path", r"/([^/]+/[^/]+)$", 1).alias("file"), "bytes", "sha256")


def now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None, microsecond=0)


def _iso(x):
    return None if x is None else (x.isoformat() if hasattr(x, "isoformat") else str(x))


# ---------------------------------------------------------------- S18

def current_snapshot(spark: SparkSession, root: str) -> tuple[str, dict]:
    name = read_text(spark, posixpath.join(root, POINTER)).strip()
    if not re.fullmatch(r"[^./\\_][^/\\]*", name):
        raise SnapshotError(f"the pointer holds no snapshot id: {name!r}")
    folder = posixpath.join(root, "snapshots", name)
    return folder, json.loads(read_text(spark, posixpath.join(folder, MANIFEST)))


def verify_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Digest check of every part file against the snapshot's file table ``(file, expected_sha256,
    actual_sha256, ok)``; missing and additional files are not ok."""
    folder, meta = current_snapshot(spark, root)
    listed = spark.read.schema("file string, bytes bigint, sha256 string").parquet(posixpath.join(folder, meta["file_table"]))
    there = _relative(file_digests(spark, folder, "part-*"))
    both = listed.select("file", F.col("sha256").alias("expected_sha256")).join(
        there.select("file", F.col("sha256").alias("actual_sha256")), "file", "full")
    return both.withColumn("ok", F.col("expected_sha256").eqNullSafe(F.col("actual_sha256")))


def read_table(spark: SparkSession, folder: str, name: str, ddl: str) -> DataFrame:
    """A snapshot table with the types it was written with: naive times stay naive, truth values in any usual
    spelling become booleans."""
    schema = T.StructType.fromDDL(ddl.replace(":", " "))
    raw = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType)
                        for f in schema])
    df = (spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").schema(raw)
          .csv(posixpath.join(folder, name)))
    return df.select(*[F.when(F.col(f.name).isNotNull(), truthy(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.BooleanType) else F.col(f.name) for f in schema])


def read_snapshot(spark: SparkSession, root: str) -> tuple[dict, dict]:
    """``{table: DataFrame}`` and the manifest, after digests and row totals have been checked."""
    folder, meta = current_snapshot(spark, root)
    try:
        wrong = verify_snapshot(spark, root).filter("not ok").select("file").first()
    except Exception as e:
        if not re.search("FAILED_READ_FILE|ChecksumException", str(e)):
            raise
        raise SnapshotError(f"checksum: the file system refuses a part file ({str(e)[:200]})") from e
    if wrong:
        raise SnapshotError(f"checksum of {wrong.file} is not the recorded one")
    frames = {name: read_table(spark, folder, name, t["schema"]) for name, t in meta["tables"].items()}
    for name in {"daily_metrics", "hourly_investigation"} & set(frames):
        total = frames[name].agg(F.coalesce(F.sum("readings"), F.lit(0)).alias("n")).first().n
        if total != meta["original_reading_count"]:
            raise SnapshotError(f"{name} sums up to {total} readings, the source has {meta['original_reading_count']}")
    return frames, meta


# ---------------------------------------------------------------- S8 upsert

def upsert(base: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """Insert-or-replace by key: ``base ▷ updates ∪ updates``; duplicate update keys are fatal."""
    dup = updates.groupBy(*key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise SnapshotError(f"ambiguous upsert: duplicate key {dup[0].asDict()}")
    return base.join(updates.select(*key), on=key, how="left_anti").unionByName(updates)
