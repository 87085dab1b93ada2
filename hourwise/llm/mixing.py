"""Mixing sources to target weights: van der Corput schedule of equal-token blocks.

Sizes count runs of non-white-space. Sources in code point order (null last) weigh 5, 2, 1, repeating, and
share all sizes; a target stops at ``max_repeats`` times its source's size and the excess goes to the
others by weight. The documents of a source stand in a shuffled order (MD5 of seed and doc_id) and are cut
into blocks of ``block_tokens``; a source needs a whole number of slots for its target. Slot n of the
schedule is the van der Corput point whose bits are those of n reversed; it falls into the source whose
interval of cumulative slots holds it, so every prefix of the schedule is close to the weights and every
source gets exactly its slots. The r-th slot of a source takes its r-th block, beginning again after the
last one; the last slot is cut at the target.

Hot sources and ids: running sums are taken in range partitions of the shuffled order first and then over their sums, slots are
ranked within chunks of the schedule, and blocks join slots on (source, block).

Defined cases: null or empty text has size 0 and takes nothing; null source is a source of its own; rows
that repeat are separate documents, and so are those of one doc_id or none, however many; very long texts are counted whole; an empty
table gives an empty table; of other columns only source and doc_id are read by ``mix``, and ``mixed`` replaces columns named like its
own. One row for each source is
ranked in one task; documents, blocks and slots never are. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from hourwise.llm.common import ROW, numbered, running_offsets
from hourwise.session import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_TOKENS = 128
SEED = "mix-1"
#: Slots of a chunk of the schedule (a power of two).
CHUNK_BITS = 12


def sized(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, size, order) of numbered documents, written once."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    order = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return materialize(docs.select(ROW, "doc_id", "source", size.alias("size"), order.alias("order")), "mix_sizes")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
            block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each source: sid, source, source_size, target, planned, blocks, rest, slots, first."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1))
    s = s.withColumn("most", F.col("source_size") * max_repeats)
    # the capped sources are those with the lowest most/weight: level if the first i of them are capped
    by = W.orderBy(F.col("most") / F.col("weight"), "sid")
    s = (s.withColumn("capped", F.coalesce(F.sum("most").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("open", F.sum("weight").over(by.rowsBetween(0, W.unboundedFollowing)))
         .withColumn("total", F.sum("source_size").over(W.partitionBy())))
    s = s.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    s = s.withColumn("fits", F.col("level") * F.col("weight") <= F.col("most"))
    s = s.withColumn("level", F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(
        by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    s = s.withColumn("target", F.least(F.col("level") * F.col("weight"), F.col("most").cast("double")))
    s = s.withColumn("planned", F.least(F.round("target").cast("long"), F.col("most")))
    up = lambda x: F.ceil(x / block_tokens)
    s = (s.withColumn("blocks", up(F.col("source_size")))
         .withColumn("passes", F.when(F.col("source_size") > 0, F.expr("planned div source_size")).otherwise(0))
         .withColumn("rest", F.col("planned") - F.col("passes") * F.col("source_size"))
         .withColumn("slots", F.col("passes") * F.col("blocks") + up(F.col("rest"))))
    s = s.withColumn("first", F.coalesce(F.sum("slots").over(
        W.orderBy("sid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return materialize(s.select("sid", "source", "source_size", "target", "planned", "blocks", "passes", "rest",
                                "slots", "first"), "mix_targets")


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, sid, rank): van der Corput slots with their source and the rank among its slots, from 0."""
    spark = sources.sparkSession
    n = sources.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, (n - 1).bit_length())
    # point j of the grid 0..2^bits - 1 is visited at slot reverse(j); points past the last source are left out
    reverse = F.conv(F.reverse(F.lpad(F.bin("point"), bits, F.lit("0"))), 2, 10).cast("long")
    cell = 1 << CHUNK_BITS
    slots = spark.range(n).select(F.col("id").alias("point")).select(
        reverse.alias("slot"), "point", F.floor(F.col("point") / cell).alias("cell"))
    last = F.col("first") + F.col("slots")
    spans = sources.filter("slots > 0").select("sid", "first", last.alias("last"), F.explode(F.sequence(
        F.floor(F.col("first") / cell), F.floor((last - 1) / cell))).alias("cell"))
    x = slots.join(spans, "cell").filter("point >= first and point < last").select("slot", "sid")
    x = x.withColumn("chunk", F.shiftright("slot", CHUNK_BITS))
    counts = x.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = running_offsets(counts, "sid", "chunk", "n")
    within = F.row_number().over(W.partitionBy("sid", "chunk").orderBy("slot")) - 1
    return (x.withColumn("within", within).join(before, ["sid", "chunk"])
            .select("slot", "sid", (F.col("before") + F.col("within")).alias("rank")))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """(row, sid, size, start): where each document starts in the shuffled order of its source.

    The documents are dealt into range partitions of that order, so that a source, and one doc_id, that holds a third of all
    rows is split like any other; a partition starts where the lower ones end.
    """
    ids = sources.select("sid", F.col("source").alias("__s"))
    x = sizes.join(ids, F.col("source").eqNullSafe(F.col("__s"))).select(ROW, "sid", "size", "order")
    keys = ["sid", "order", "size", ROW]
    x = materialize(x.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()).drop("order"),
                    "mix_order").withColumn("bucket", F.shiftright("at", 33))
    before = running_offsets(x.groupBy("sid", "bucket").agg(F.sum("size").alias("n")), "sid", "bucket", "n")
    w = W.partitionBy("sid", "bucket").orderBy("at")
    x = x.withColumn("within", F.sum("size").over(w.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    return x.join(before, ["sid", "bucket"]).select(
        ROW, "sid", "size", (F.col("before") + F.col("within")).alias("start"))


def pieces(starts: DataFrame, block_tokens: int) -> DataFrame:
    """(row, sid, block, start, n): the part of each document in each block."""
    end = F.col("start") + F.col("size")
    x = starts.filter("size > 0").select(ROW, "sid", "start", end.alias("end"), F.explode(F.sequence(
        F.floor(F.col("start") / block_tokens), F.floor((end - 1) / block_tokens))).alias("block"))
    low = F.greatest("start", F.col("block") * block_tokens)
    high = F.least("end", (F.col("block") + 1) * block_tokens)
    return x.select(ROW, "sid", "block", low.alias("start"), (high - low).alias("n"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
        block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(row, doc_id, size, source_size, target, taken) of numbered documents."""
    sizes = sized(docs)
    sources = targets(sizes, weights, max_repeats, block_tokens)
    plan = sources.select("sid", "blocks", "passes", "rest")
    slots = schedule(sources).join(F.broadcast(plan) if _few(sources) else plan, "sid").select(
        "sid", F.expr("rank div blocks").alias("pass"), F.expr("rank % blocks").alias("block"), "passes", "rest")
    parts = pieces(placed(sizes, sources), block_tokens)
    got = F.when(F.col("pass") < F.col("passes"), F.col("n")).otherwise(
        F.greatest(F.lit(0), F.least("n", F.col("rest") - F.col("start"))))
    taken = parts.join(slots, ["sid", "block"]).groupBy(ROW).agg(F.sum(got).alias("taken"))
    named = sources.select(F.col("source").alias("__s"), "source_size", "target")
    x = sizes.join(taken, ROW, "left")
    x = x.join(F.broadcast(named) if _few(sources) else named, F.col("source").eqNullSafe(F.col("__s")))
    return x.select(ROW, "doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _few(sources: DataFrame, most: int = 100_000) -> bool:
    """True if the table of sources is small enough to be broadcast."""
    return sources.count() <= most


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: columns of ``docs`` and size, source_size, target, taken; taken > 0."""
    kept = numbered(docs, "mix_docs")
    x = mix(kept, **options).filter("taken > 0").drop("doc_id")
    names = ["size", "source_size", "target", "taken"]
    x = x.select(ROW, *names)
    return kept.drop(*names).join(x, ROW).drop(ROW)
