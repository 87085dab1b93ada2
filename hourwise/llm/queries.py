"""Registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourwise.llm import (decontaminate, html_extract, language_id, line_dedup, mixing, near_dedup, periodic, quality,
                          secret_scan, topk, trie, url_filter, warc)
from hourwise.llm.common import ROW, numbered, table
from hourwise.llm.oracle import SQL

#: Rules of op1: (host, path, action).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op1_url_filter(spark, sf_dir):
    """Verdict of every page url by host-suffix and path-prefix rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op2_line_dedup(spark, sf_dir):
    """Every document without the later copies of repeated line runs."""
    x = line_dedup.without_later_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return x.select("doc_id", "text", F.col("__hw_lines").alias("n_lines"), F.col("__hw_removed").alias("n_removed"))


def op3_decontaminate(spark, sf_dir):
    """Benchmark hits of every document."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language_id(spark, sf_dir):
    """Predicted language of every document, and the languages of its mixture with their shares."""
    x = language_id.languages(table(spark, sf_dir, "documents"))
    return x.select("doc_id", "held_out", *language_id.main_language(), "langs", "shares")


def op5_warc(spark, sf_dir):
    """Metadata and conversion records of every page."""
    return warc.derived_from_pages(table(spark, sf_dir, "pages"))


def op6_near_dedup(spark, sf_dir):
    """Near-duplicate class of every document."""
    return near_dedup.labelled(table(spark, sf_dir, "documents"))


def op7_html_extract(spark, sf_dir):
    """Main text of every page."""
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op8_secret_scan(spark, sf_dir):
    """Secrets in every document; the source is the owner, the document the repository."""
    return secret_scan.scanned(table(spark, sf_dir, "documents"))


def op9_topk(spark, sf_dir):
    """The 5 nearest vectors of every 50th one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "mix_docs")
    return mixing.mix(docs).drop(ROW)


def op11_quality(spark, sf_dir):
    """Quality score of every document."""
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of every document."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark, sf_dir):
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_line_dedup, op3_decontaminate, op4_language_id, op5_warc, op6_near_dedup, op7_html_extract,
    op8_secret_scan, op9_topk, op10_mixing, op11_quality, op12_periodic_runs, op13_conversation_trie)}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in SQL.items() if k in QUERIES}
