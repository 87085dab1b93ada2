"""URL filters: host-suffix x path-prefix expressions, hash-prefix equi-join, digest check, precedence.

Every distinct (host, path) is expanded once into the expressions that a rule could have; expressions
meet the rules by an equi-join on the first 32 bits of their SHA-256, full digests confirm, and the
longest rule wins.  Only host and path lengths that some rule has are expanded, so a url makes at most
(rule host lengths x rule path lengths) expressions however long it is.

Defined cases: a null url, or one without ``://``, has an empty host and path; it fits no rule.  Rules
without a host are ignored, a null rule path is empty (fits any path).  Of two fitting rules of the same
length the one with the longer host wins; of two equal rules, block.  Repeated rows stay repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.llm.common import ascii_lower

#: Hex digits of the digest that the join is on.
PREFIX_HEX = 8
BLOCK, ALLOW = "block", "allow"


def host_and_path(url):
    """(host, path) columns of a url column."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, parts, 1), F.lit(""))
    return ascii_lower(host), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def prepared(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with their digest; one row for each host and path."""
    r = (rules.select(ascii_lower(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"),
                      F.col("action").alias("r_action"))
         .filter(F.col("r_host") != "").groupBy("r_host", "r_path").agg(F.max("r_action").alias("r_action")))
    return (r.withColumn("digest", _digest(F.col("r_host"), F.col("r_path")))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))


def expressions(urls: DataFrame, host_lengths: list[int], path_lengths: list[int]) -> DataFrame:
    """Rows (host, path, prefix, digest): one for each expression of each url."""
    n = F.length("host")
    suffixes = F.filter(F.array(*map(F.lit, host_lengths)), lambda k: (n == k) | (
        (n > k) & (F.substring(F.col("host"), n - k, F.lit(1)) == ".")))
    prefixes = F.filter(F.array(*map(F.lit, path_lengths)), lambda k: k <= F.length("path"))
    e = (urls.select("host", "path", F.explode(suffixes).alias("hk"))
         .select("host", "path", "hk", F.explode(prefixes).alias("pk")))
    digest = _digest(F.right("host", F.col("hk")), F.left("path", F.col("pk")))
    return e.select("host", "path", digest.alias("digest")).withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))


def winners(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of every distinct (host, path) that a rule fits."""
    ready = prepared(rules)
    # two arrays of distinct lengths: bounded by the longest rule, whatever the number of rules
    lengths = ready.agg(F.collect_set(F.length("r_host")).alias("h"), F.collect_set(F.length("r_path")).alias("p")).first()
    if not lengths.h:
        return urls.limit(0).select("host", "path", F.lit("").alias("rule"), F.lit("").alias("action"))
    candidates = expressions(urls, sorted(lengths.h), sorted(lengths.p))
    # the rules are broadcast only if their size is under Spark's threshold; else both sides are dealt
    # out by hash prefix, and a prefix that many urls share is split by the adaptive skew join
    hits = (candidates.withColumnRenamed("digest", "u_digest").join(ready, "prefix")
            .filter(F.col("u_digest") == F.col("digest")))
    name = F.concat("r_host", "r_path")
    best = F.max(F.struct(F.length(name).alias("n"), F.length("r_host").alias("hn"), name.alias("rule"),
                          F.col("r_action").alias("action"))).alias("best")
    return hits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.action")


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url)."""
    host, path = host_and_path(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    key = F.xxhash64("host", "path").alias("key")
    best = winners(p.select("host", "path").filter(F.col("host") != "").distinct(), rules)
    # with the extra key both sides are dealt out anew, so that a url which many rows share can be split
    joined = p.select("*", key).join(best.select("*", key), ["key", "host", "path"], "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
