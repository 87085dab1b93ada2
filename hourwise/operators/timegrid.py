"""Time-grid and gap operators (T1-T4) and the stitched LAG.

Grids are generated per key with ``explode(sequence(...))`` (a Generate, not a
join) and left-joined to the data on ``(keys, ts)``; missing points stay NULL,
never zero-filled.

``stitched_lag``: LAG over all raw rows ordered by time has no partition key,
i.e. one task.  Rows are bucketed (by range partitioning on the order column,
or by a range of a unique row id); LAG runs inside ``(keys, bucket)``, and the
first row of each bucket takes the last value of the previous non-empty bucket,
found by a LAG over the per-bucket table (one row per bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourwise.functions.columns import join_keys, ntz_lit, seconds_between
from hourwise.session import materialize


def _step(step_seconds: int) -> Column:
    return F.expr(f"INTERVAL {step_seconds} SECONDS")


def densify(df: DataFrame, ts: str, step_seconds: int, lo, hi, keys: list[str] | None = None,
            key_rows: DataFrame | None = None) -> DataFrame:
    """Reindex to every step in ``[lo, hi)`` (per key); absent points are NULL rows."""
    keys = list(keys or [])
    lo_c, hi_c = ntz_lit(lo), ntz_lit(hi)
    gen = F.explode(F.sequence(lo_c, hi_c - _step(step_seconds), _step(step_seconds))).alias(ts)
    if keys:
        base = key_rows if key_rows is not None else df.select(*keys).distinct()
        grid = base.select(*keys, gen)
    else:
        grid = df.sparkSession.range(1).select(gen)
    data = df.withColumn(ts, F.col(ts).cast("timestamp_ntz"))
    return join_keys(grid, data, [*keys, ts], "left")


def asfreq(df: DataFrame, ts: str, step_seconds: int, keys: list[str] | None = None) -> DataFrame:
    """Reindex between the first and last present point of each key (pandas ``asfreq``)."""
    keys = list(keys or [])
    df = materialize(df, "asfreq_input")  # read twice: bounds and the join
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    grid = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi", _step(step_seconds))).alias(ts))
    return join_keys(grid, df, [*keys, ts], "left")


def resample_null_check(original: DataFrame, resampled: DataFrame, ts: str, value_cols: list[str],
                        keys: list[str] | None = None) -> DataFrame:
    """Rows added by resampling must carry only NULL values."""
    keys = list(keys or [])
    resampled = materialize(resampled, "resampled")
    marked = join_keys(resampled, original.select(*keys, ts).withColumn("_present", F.lit(True)), [*keys, ts], "left")
    added = F.col("_present").isNull()
    any_value = F.lit(False)
    for c in value_cols:
        any_value = any_value | F.col(c).isNotNull()
    return marked.agg(F.count(F.lit(1)).alias("grid_points"),
                      F.count_if(~added).alias("present_points"),
                      F.count_if(added).alias("inserted_points"),
                      F.count_if(added & any_value).alias("inserted_non_null_points"))


def unobserved_windows(hourly: DataFrame, keys: list[str] | None = None, ts: str = "hour_ts") -> DataFrame:
    """T4: expected hour windows between first and last observed hour, minus observed."""
    keys = list(keys or [])
    agg = hourly.groupBy(*keys).agg(F.min(ts).alias("first_hour"), F.max(ts).alias("last_hour"),
                                    F.count(F.lit(1)).alias("observed_hours"))
    expected = (F.round(seconds_between("last_hour", "first_hour") / 3600) + 1).cast("bigint")
    return agg.select(*keys, "first_hour", "last_hour", expected.alias("expected_hours"), "observed_hours",
                      (expected - F.col("observed_hours")).alias("unobserved_hour_windows"))


def stitched_lag(df: DataFrame, order_col: str, value_col: str, out: str, bucket: Column | None = None,
                 keys: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """LAG(value) OVER (PARTITION BY keys ORDER BY order_col), computed bucket-locally.

    ``bucket`` must be monotone in ``order_col`` (e.g. ``row_id div N``).  When it
    is omitted the rows are range-partitioned by ``order_col`` into ``buckets`` parts
    (default: shuffle partitions), so a burst of rows in one hour is split across tasks
    and the number of buckets grows with the setting.  Ties in ``order_col`` must not matter
    for the value (true when ``value_col`` is the order column itself, or
    ``order_col`` is unique).
    """
    keys = list(keys or [])
    if bucket is None:
        n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df, bucket = df.repartitionByRange(n, order_col), F.spark_partition_id()
    # rows feed two branches (in-bucket LAG and per-bucket last value): written once, which also fixes the buckets
    b = materialize(df.withColumn("_bucket", bucket), "lag_input")
    w = Window.partitionBy(*keys, "_bucket").orderBy(order_col)
    local = b.withColumn("_lag", F.lag(value_col).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = b.groupBy(*keys, "_bucket").agg(F.max_by(value_col, order_col).alias("_last"))
    carry = last.select(*keys, "_bucket", F.lag("_last").over(
        Window.partitionBy(*keys).orderBy("_bucket")).alias("_carry"))
    return (join_keys(local, carry, [*keys, "_bucket"], "left")
            .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")))
            .drop("_bucket", "_lag", "_first", "_carry"))


def _numeric(df: DataFrame, col: str) -> Column:
    t = dict(df.dtypes)[col]
    return F.unix_micros(F.col(col).cast("timestamp")) if t.startswith("timestamp") else F.col(col)


def _bucketize(x: Column, bounds: list, lo: int, hi: int) -> Column:
    """Index i with bounds[i-1] <= x < bounds[i] as a balanced CASE tree (log2 n comparisons per row)."""
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x < F.lit(bounds[mid]), _bucketize(x, bounds, lo, mid)).otherwise(_bucketize(x, bounds, mid + 1, hi))


def quantile_buckets(df: DataFrame, order_col: str, n: int) -> Column:
    """Monotone bucket id with about equal rows per bucket, for moderate ``n`` (the cut points are literals).

    ``approxQuantile`` returns ``n - 1`` cut points to the driver (bounded by n),
    which are embedded as literals, so every branch of a plan and every
    recomputation after an executor loss assigns the same buckets.
    """
    x = _numeric(df, order_col)
    rel_error = 1 / (8 * n)
    probs = [i / n for i in range(1, n)]
    cuts = sorted(set(v for v in df.select(x.alias("_x")).approxQuantile("_x", probs, rel_error) if v is not None))
    return _bucketize(x, cuts, 0, len(cuts)) if cuts else F.lit(0)


def distinct_time_deltas(readings: DataFrame, ts: str = "observed_at",
                         keys: list[str] | None = None) -> DataFrame:
    """Per distinct timestamp: duplicate count and the delta to the previous distinct timestamp.

    Duplicates are collapsed map-side first, so a hot timestamp costs one row.
    The delta multiset of the raw LAG equals {0 x (n-1) per timestamp} plus one
    delta per distinct timestamp (NULL for the first).
    """
    keys = list(keys or [])
    per_ts = readings.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n"))
    lagged = stitched_lag(per_ts, ts, ts, "previous_at", keys=keys)
    return lagged.withColumn("delta_seconds", seconds_between(ts, "previous_at"))


def weighted_percentile_disc(values: DataFrame, value: str, weight: str, p: float,
                             bucket_width: float = 1.0) -> DataFrame:
    """Exact discrete percentile (PostgreSQL ``percentile_disc``) of a weighted value multiset.

    Two levels keep every step bounded: a histogram per value (distributed
    ``groupBy``), bucket totals over fixed-width value ranges (one row per
    bucket), the bucket holding the target rank, and a running sum inside that
    one bucket only.  Returns one row ``(value)``; NULL on empty input.
    """
    hist = values.filter(F.col(value).isNotNull()).groupBy(value).agg(F.sum(weight).alias("_w"))
    hist = hist.withColumn("_b", F.floor(F.col(value) / F.lit(bucket_width)))
    buckets = hist.groupBy("_b").agg(F.sum("_w").alias("_bw"))
    wb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    buckets = (buckets.withColumn("_cum", F.sum("_bw").over(wb))
               .withColumn("_rank", F.greatest(F.ceil(F.lit(p) * F.sum("_bw").over(tot)), F.lit(1)))
               .filter((F.col("_cum") >= F.col("_rank")) & (F.col("_cum") - F.col("_bw") < F.col("_rank")))
               .select("_b", (F.col("_rank") - (F.col("_cum") - F.col("_bw"))).alias("_need")))
    inside = hist.join(buckets, on="_b", how="inner")
    wi = Window.partitionBy("_b").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_c", F.sum("_w").over(wi)).filter(F.col("_c") >= F.col("_need"))
    picked = inside.agg(F.min(value).alias(value))
    return picked
