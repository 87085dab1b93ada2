"""Training-data pipeline: language ID, line dedup, near-duplicate removal, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's rows as
Parquet below ``spark.checkpoint.dir``, reads them again as the next stage's documents and deletes them once that stage is written.
"""

from __future__ import annotations

from hourwise.llm import decontaminate, language_id, line_dedup, mixing, near_dedup
from hourwise.llm.common import table
from hourwise.session import discard, materialize


def language(spark, docs, sf_dir):
    """Documents with an identified language."""
    return language_id.kept(docs)


def lines(spark, docs, sf_dir):
    """Documents without later copies of repeated line runs; one of which no line is left goes."""
    x = line_dedup.without_later_copies(docs)
    return x.filter("__hw_removed = 0 or __hw_removed < __hw_lines").drop("__hw_lines", "__hw_removed")


def near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate class."""
    return near_dedup.one_of_each(docs)


def clean(spark, docs, sf_dir):
    """Documents that are not contaminated with benchmark items."""
    return decontaminate.kept(docs, table(spark, sf_dir, "benchmark"))


def mix(spark, docs, sf_dir):
    """The mix: every document that it takes, with its size, its source's size and target, and the words taken."""
    return mixing.mixed(docs)


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near_duplicates), ("decontaminate", clean),
          ("mixing", mix)]

#: Near-duplicate classes and language models have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
        discard(*before)  # the rows that this stage has read
        before = [docs]
    return docs
