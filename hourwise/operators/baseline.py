"""Trailing calendar baseline (W1) and its independent self-join form.

A RANGE window ordered by time with no partition key runs in one task.  Here
the series is cut into fixed calendar chunks (default 28 days) and every row is
also copied into the following chunk(s) whose look-back reaches it (a halo of
``lookback`` seconds), so the window is partitioned by ``(keys, chunk)`` and
each task sees exactly the rows its frame needs.  Only rows whose home chunk is
the partition's chunk are kept, so the result equals the single-partition
window; the copy overhead is ``lookback / chunk`` (25 % at 7/28 days).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwise.functions.columns import epoch_seconds
from hourwise.session import materialize

CHUNK_DAYS = 28


def chunk_with_halo(df: DataFrame, ts: str, halo_seconds: int, chunk_seconds: int,
                    chunk_col: str = "_chunk", home_col: str = "_home", micros: bool = False) -> DataFrame:
    """Assign each row to its home chunk and to every later chunk within ``halo_seconds``.

    ``_ep`` is the epoch in seconds (or microseconds with ``micros``).
    """
    unit = 1_000_000 if micros else 1
    ep = F.unix_micros(F.col(ts).cast("timestamp")) if micros else epoch_seconds(ts)
    home = F.floor(ep / F.lit(chunk_seconds * unit))
    last = F.floor((ep + F.lit(halo_seconds * unit)) / F.lit(chunk_seconds * unit))
    return (df.withColumn("_ep", ep)
            .withColumn(chunk_col, F.explode(F.sequence(home, last)))
            .withColumn(home_col, F.col(chunk_col) == home))


def trailing_baseline(hourly: DataFrame, lookback_seconds: int, grain_seconds: int = 3600,
                      keys: list[str] | None = None, ts: str = "hour_ts",
                      sums: dict[str, str] | None = None, count_name: str = "prior_observed_hours",
                      chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Add Σ of each column in ``sums`` and a row count over ``[ts - lookback, ts - grain]``.

    Empty frame -> sums NULL, count 0 (SQL window semantics).
    """
    keys = list(keys or [])
    sums = sums or {"low_pressure_loaded_readings": "prior_low_readings",
                    "loaded_readings": "prior_loaded_readings"}
    chunked = chunk_with_halo(hourly, ts, lookback_seconds, chunk_days * 86400)
    w = (Window.partitionBy(*keys, "_chunk").orderBy("_ep")
         .rangeBetween(-lookback_seconds, -grain_seconds))
    out = chunked.select("*", *[F.sum(src).over(w).alias(dst) for src, dst in sums.items()],
                         F.count(F.lit(1)).over(w).alias(count_name))
    return out.filter("_home").drop("_ep", "_chunk", "_home")


def trailing_baseline_join(hourly: DataFrame, lookback_seconds: int, keys: list[str] | None = None,
                           ts: str = "hour_ts", sums: dict[str, str] | None = None,
                           count_name: str = "prior_hours") -> DataFrame:
    """Independent derivation by self-join: each row with all rows in ``[ts - lookback, ts)``.

    The range predicate is turned into an equi-join on day buckets: the prior
    side is exploded into the ``lookback_days + 1`` day buckets whose rows may
    look back at it, then the exact residual range predicate filters.  This is a
    shuffle hash / sort-merge join on ``(keys, bucket)`` instead of a
    broadcast nested-loop join.
    """
    keys = list(keys or [])
    sums = sums or {"loaded": "prior_loaded", "low": "prior_low"}
    days = -(-lookback_seconds // 86400)
    hourly = materialize(hourly, "self_join_input")  # both join sides read the same written rows
    cur = hourly.withColumn("_bucket", F.to_date(ts))
    prior = (hourly.select(*keys, F.col(ts).alias("_p_ts"), *[F.col(c).alias(f"_p_{c}") for c in sums])
             .withColumn("_bucket", F.explode(F.sequence(F.to_date("_p_ts"),
                                                         F.date_add(F.to_date("_p_ts"), days)))))
    cond = [cur[k].eqNullSafe(prior[k]) for k in keys] + [
        cur["_bucket"] == prior["_bucket"],
        prior["_p_ts"] >= cur[ts] - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(lookback_seconds)),
        prior["_p_ts"] < cur[ts]]
    joined = cur.join(prior, on=cond, how="left")
    group_cols = [cur[c] for c in hourly.columns]
    return (joined.groupBy(*group_cols)
            .agg(*[F.sum(f"_p_{c}").alias(dst) for c, dst in sums.items()],
                 F.count("_p_ts").alias(count_name)))
