"""Line dedup: prefix doubling over line-ID sequences; repeated runs of lines keep their first copy only.

Non-blank lines get a 128-bit ID. Level 0 names a line by the smallest line row of its class (lines of
equal ID); level k+1 names 2^(k+1) lines from the two level-k names at i and i + 2^k. A class of one
member is unique and leaves the array for good (prefix doubling with discarding), so after the first
count only repeated lines are carried. Equal names are the intervals of the suffix array whose longest
common prefix is at least 2^k lines.

Deletion needs the intervals at one depth only: the prefix at which a suffix reaches ``min_words`` words.
The run of m lines starting at i is named by (m, name at i, name at i + m - 2^k) with 2^k <= m < 2^(k+1).
Every run of ``min_words`` words or more is covered by the shortest sufficient runs from each start and
to each end, so the union of those that have an earlier occurrence is exactly the maximal repeated runs.
Names stand for equality, not for rank: the order between intervals decides nothing here, and ranks would
cost a global sort at each level.

The earlier copy is the one in the smaller document (doc_id, nulls last, then scan order), then the smaller
line. Each deleted line still stands in an earlier place, so no line is lost from the corpus.

Defined cases: null, empty and blank texts stay as they are; blank lines count for nothing and go only
between two deleted lines; repeated rows count as later copies; an empty table gives an empty table.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from hourwise.llm.common import ROW, fresh_join, numbered
from hourwise.session import discard, materialize

#: Words of the shortest run that counts as repeated.
MIN_WORDS = 50
_WORD = r"\S+"


def line_table(docs: DataFrame) -> DataFrame:
    """(line, row, doc_id, seq, words, h1, h2): the non-blank lines of numbered documents."""
    seen = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S"))
    x = docs.select(ROW, "doc_id", F.posexplode(seen).alias("seq", "text"))
    return x.select(F.monotonically_increasing_id().alias("line"), ROW, "doc_id", "seq",
                    F.regexp_count("text", F.lit(_WORD)).alias("words"),
                    F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), F.col("text")).alias("h2"))


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose key occurs more than once, with ``name``: the smallest line of the class."""
    classes = (rows.groupBy(*keys).agg(F.min("line").alias("name"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1").drop("n"))
    return fresh_join(rows, classes, keys)


def repeated_lines(lines: DataFrame) -> DataFrame:
    """Level 0: lines that occur more than once."""
    return materialize(_named(lines, ["h1", "h2"]).drop("h1", "h2"), "line_level0")


def doubled(level: DataFrame, k: int) -> DataFrame:
    """Level k+1 of a level k (line, row, seq, name)."""
    a = level.select("line", ROW, "seq", F.col("name").alias("left"), (F.col("seq") + F.lit(1 << k)).alias("at"))
    b = level.select(ROW, F.col("seq").alias("at"), F.col("name").alias("right"))
    pairs = a.join(b, [ROW, "at"]).drop("at")
    return materialize(_named(pairs, ["left", "right"]).select("line", ROW, "seq", "name"), f"line_level{k + 1}")


def shortest_runs(level0: DataFrame, min_words: int) -> DataFrame:
    """(row, doc_id, seq, m): the shortest runs of repeated lines with ``min_words`` words, one from each
    start and one to each end."""
    by_row = W.partitionBy(ROW).orderBy("seq")
    x = level0.withColumn("island", F.col("seq") - F.row_number().over(by_row))
    island = W.partitionBy(ROW, "island")
    x = (x.withColumn("upto", F.sum("words").over(island.orderBy("seq").rowsBetween(W.unboundedPreceding, 0)))
         .withColumn("before", F.col("upto") - F.col("words"))
         .withColumn("total", F.sum("words").over(island)))
    x = (x.withColumn("m_start", F.count(F.lit(1)).over(island.orderBy("before").rangeBetween(0, min_words - 1)))
         .withColumn("m_end", F.count(F.lit(1)).over(island.orderBy("upto").rangeBetween(1 - min_words, 0))))
    run = lambda ok, seq, m: F.when(ok, F.struct(seq.cast("int").alias("seq"), m.cast("int").alias("m")))
    runs = F.array(run(F.col("total") - F.col("before") >= min_words, F.col("seq"), F.col("m_start")),
                   run(F.col("upto") >= min_words, F.col("seq") - F.col("m_end") + 1, F.col("m_end")))
    return (x.select(ROW, "doc_id", F.explode(F.array_distinct(F.array_compact(runs))).alias("run"))
            .select(ROW, "doc_id", "run.seq", "run.m"))


def later_copies(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, start, end, first_doc): maximal runs [start, end) of non-blank lines to delete, from a written
    line table."""
    level = repeated_lines(lines)
    runs = materialize(shortest_runs(level, min_words), "line_runs")
    longest = runs.agg(F.max("m")).first()[0] or 1
    names, levels = level.select(ROW, "seq", "name", F.lit(0).alias("k")), [level]
    for k in range(longest.bit_length() - 1):
        level = doubled(level, k)
        levels.append(level)
        names = names.unionByName(level.select(ROW, "seq", "name", F.lit(k + 1).alias("k")))
    at = lambda alias, pos: names.select(ROW, "k", F.col("seq").alias(pos), F.col("name").alias(alias))
    x = runs.withColumn("k", F.length(F.bin("m")) - 1)
    x = x.withColumn("last", F.col("seq") + F.col("m") - F.expr("shiftleft(1, k)"))
    x = x.join(at("head", "seq"), [ROW, "k", "seq"]).join(at("tail", "last"), [ROW, "k", "last"])
    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW, "seq")
    x = x.select(ROW, "seq", "m", "head", "tail", here.alias("here"))
    first = (x.groupBy("m", "head", "tail").agg(F.min("here").alias("first"), F.max("here").alias("last"))
             .filter("first < last").drop("last"))
    late = fresh_join(x, first, ["m", "head", "tail"]).filter("first < here")
    late = late.select(ROW, "seq", (F.col("seq") + F.col("m")).alias("stop"), F.col("first.doc_id").alias("first_doc"))
    # overlapping and adjacent runs of a document join up
    before = F.max("stop").over(W.partitionBy(ROW).orderBy("seq", "stop").rowsBetween(W.unboundedPreceding, -1))
    late = late.withColumn("new", F.coalesce((F.col("seq") > before).cast("int"), F.lit(1)))
    late = late.withColumn("run", F.sum("new").over(
        W.partitionBy(ROW).orderBy("seq", "stop").rowsBetween(W.unboundedPreceding, 0)))
    late = materialize(late.groupBy(ROW, "run").agg(F.min("seq").alias("start"), F.max("stop").alias("end"),
                                                    F.min("first_doc").alias("first_doc")).drop("run"), "line_late")
    discard(runs, *levels)
    return late


def without_later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with later copies deleted from ``text``, and ``__hw_lines`` and
    ``__hw_removed``: its non-blank lines and how many of them went."""
    kept = numbered(docs, "line_docs")
    lines = materialize(line_table(kept), "lines")
    cuts = later_copies(lines, min_words).groupBy(ROW).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__hw_cuts"))
    found = lines.groupBy(ROW).agg(F.count(F.lit(1)).alias("__hw_lines")).join(cuts, ROW, "left")
    cut = F.col("__hw_cuts")
    gone = F.aggregate(cut, F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    found = materialize(found.withColumn("__hw_removed", F.coalesce(gone, F.lit(0).cast("long"))), "line_cuts")
    discard(lines)
    x = kept.join(found, ROW, "left")
    # only texts with cuts are taken apart
    x = x.withColumn("text", F.when(cut.isNull(), F.col("text")).otherwise(_without("text", cut)))
    zero = F.lit(0).cast("long")
    return x.withColumns({c: F.coalesce(c, zero) for c in ("__hw_lines", "__hw_removed")}).drop(ROW, "__hw_cuts")


def _without(text: str, cuts):
    """The text without the runs [start, end) of its non-blank lines, and the blank lines inside them."""
    let = lambda value, body: F.transform(F.array(value), body)[0]  # noqa: E731  a value that is computed once

    def pieces(every, at):
        froms = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda r: F.get(at, r["end"] - 1) + 1))
        upto = F.concat(F.transform(cuts, lambda r: F.get(at, r["start"])), F.array(F.size(every)))
        return F.array_join(F.flatten(F.zip_with(froms, upto, lambda a, b: F.slice(every, a + 1, b - a))), "\n")
    solid = lambda every: F.filter(F.transform(every, lambda v, i: F.when(v.rlike(r"\S"), i)), lambda i: i.isNotNull())
    return let(F.split(text, "\n"), lambda every: let(solid(every), lambda at: pieces(every, at)))
