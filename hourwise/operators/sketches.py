"""Mergeable sketches beside the marts (A5, A12): distinct times and quantiles of any period without a raw scan.

The hourly table keeps a HyperLogLog sketch of the observation times and KLL sketches of pressure and current. Sketches
of hours merge to days and to any period. ``LG_K`` and ``K`` set size and error: a HyperLogLog sketch of 2^LG_K
registers has a relative standard error of 1.04 / sqrt(2^LG_K), and a KLL sketch of K = 200 gives ranks within
1.65 % of the rows with 99 % confidence. An hour's sketches take a few kilobytes at most, however many readings it has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import trunc_hour

LG_K, K = 12, 200
#: Three standard errors for counts, and the rank error of a KLL sketch.
COUNT_ERROR, RANK_ERROR = 3 * 1.04 / math.sqrt(1 << LG_K), 0.0165
MEASURES = {"pressure": "tp3", "current": "motor_current"}


def hourly_sketches(readings: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = list(keys or [])
    return (readings.groupBy(*keys, trunc_hour("observed_at").alias("hour_ts"))
            .agg(F.count(F.lit(1)).alias("readings"),
                 F.hll_sketch_agg(F.unix_micros(F.col("observed_at").cast("timestamp")), LG_K).alias("times_hll"),
                 *[F.kll_sketch_agg_double(F.col(c).cast("double"), K).alias(f"{m}_kll") for m, c in MEASURES.items()]))


def merged(sketches: DataFrame, *by) -> DataFrame:
    """Sketches of coarser groups (days, periods, assets together) from those of finer ones."""
    return sketches.groupBy(*by).agg(F.sum("readings").alias("readings"), F.hll_union_agg("times_hll").alias("times_hll"),
                                     *[F.kll_merge_agg_double(f"{m}_kll").alias(f"{m}_kll") for m in MEASURES])


def estimates(sketches: DataFrame, by: list[str], probabilities=(0.5, 0.95)) -> DataFrame:
    """Distinct times with their bounds, and each quantile with the ranks it may have."""
    n = F.hll_sketch_estimate("times_hll")
    cols: list[Column] = [n.alias("distinct_times_estimate"), (n * (1 - COUNT_ERROR)).alias("distinct_times_low"),
                          (n * (1 + COUNT_ERROR)).alias("distinct_times_high")]
    for m in MEASURES:
        cols += [F.kll_sketch_get_quantile_double(f"{m}_kll", F.lit(float(p))).alias(f"{m}_p{int(p * 100):02d}") for p in probabilities]
    return sketches.select(*by, "readings", *cols)


def against_exact(readings: DataFrame, by: Column, name: str, estimated: DataFrame, probabilities=(0.5, 0.95)) -> DataFrame:
    """Exact counts of each group beside the estimates, and whether each estimate is within its bound. A quantile
    is right if the share of rows below it and the share up to it enclose its probability, give or take the error."""
    r = readings.select(by.alias(name), "observed_at", *MEASURES.values())
    exact = r.groupBy(name).agg(F.count_distinct("observed_at").alias("distinct_times"))
    j = r.join(F.broadcast(estimated) if estimated.count() <= 100_000 else estimated, name)  # a row for each group
    shares = []
    for m, c in MEASURES.items():
        for p in probabilities:
            q = f"{m}_p{int(p * 100):02d}"
            low, high = F.count_if(F.col(c) < F.col(q)) / F.count(c), F.count_if(F.col(c) <= F.col(q)) / F.count(c)
            shares.append(((low <= p + RANK_ERROR) & (high >= p - RANK_ERROR)).alias(f"{q}_ok"))
    checked = j.groupBy(name).agg(*shares)
    return (estimated.join(exact, name).join(checked, name)
            .withColumn("distinct_ok", F.col("distinct_times").between(F.floor("distinct_times_low"), F.ceil("distinct_times_high"))))
