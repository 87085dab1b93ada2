"""As-of join (J13): every left row with the newest right row at or before its time.

Both sides are put together and dealt into range partitions by (keys, time), right rows before left rows of
the same time, and written once. Inside a partition the last right row runs down the order; a partition whose first
key began in an earlier one takes over the last right row of that key from there (a table of one row for each
partition and key at its edges). No window ever spans a key's whole history, and a key or a moment that holds a third of all
rows is split over partitions like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwise.functions.columns import join_keys, seconds_between
from hourwise.session import materialize


def asof_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, keys: list[str] | None = None,
              values: dict[str, str] | None = None, tolerance_seconds: float | None = None,
              age: str | None = None) -> DataFrame:
    """``left`` with the columns ``values`` (right column -> name in the result) of the matched right row.

    Right rows of one key and time rank by their values in the order given; the greatest is taken. Rows without a time
    match nothing (a right row) or get no match (a left row). NULL keys match each other. A match older than
    ``tolerance_seconds`` counts as none; ``age`` names a column for the seconds since the match.
    """
    keys, values = list(keys or []), dict(values or {right_ts: right_ts})
    taken = F.struct(F.col(right_ts).alias("_at"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(values)])
    r = right.filter(F.col(right_ts).isNotNull()).select(*keys, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), taken.alias("_right"))
    own = F.struct(*[F.col(c) for c in left.columns])
    lft = left.select(*keys, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), own.alias("_left"))
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.col("_ts").asc_nulls_first(), F.col("_side"), F.col("_right")]
    at = F.monotonically_increasing_id()
    # equal rows may go to several partitions: their order does not matter
    dealt = (lft.unionByName(r, allowMissingColumns=True).repartitionByRange(*order, F.xxhash64(at))
             .sortWithinPartitions(*order).withColumn("_row", at))
    dealt = materialize(dealt, "asof").withColumn("_part", F.shiftright("_row", 33))
    down = Window.partitionBy("_part", *keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.withColumn("_near", F.last("_right", ignorenulls=True).over(down)).filter("_side = 1")
    edges = dealt.groupBy("_part", *keys).agg(F.max_by("_right", F.when(F.col("_side") == 0, F.col("_row"))).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (edges.withColumn("_far", F.last("_last", ignorenulls=True).over(before)).filter(F.col("_far").isNotNull())
             .select("_part", *keys, "_far"))
    m = F.when(F.col("_ts").isNotNull(), F.coalesce("_near", "_far"))
    if tolerance_seconds is not None:
        m = F.when(seconds_between("_ts", m["_at"]) <= tolerance_seconds, m)
    out = join_keys(inside, carry, ["_part", *keys], "left").withColumn("_match", m)
    more = [seconds_between("_ts", F.col("_match._at")).alias(age)] if age else []
    return out.select("_left.*", *[F.col(f"_match._v{i}").alias(name) for i, name in enumerate(values.values())], *more)
