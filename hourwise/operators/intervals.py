"""Dyadic interval index (J1-J3, T6): intervals of hours against hours, without a row for every hour of an interval.

An interval [a, b) of hour numbers is the disjoint union of at most two power-of-two spans on each level, so of
O(log(b - a)) spans in all. A span is (level, number): level j, number i stands for the hours i * 2^j up to (i + 1) * 2^j. An hour
lies in exactly one span of each level. Intervals and hours so meet in an equi-join on (level, number):

* ``covered`` marks the hours that lie in any interval: the distinct spans of all intervals are looked up;
* ``sum_covered`` adds up measures of the hours in each interval: the measures are summed for each span first,
  and an interval adds up its O(log n) spans. Long intervals that share hours never form pairs with them.

Only the levels that occur among the intervals are used on the side of the hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spans of up to 2^LEVELS hours (over 200 million years).
LEVELS = 41


def hour_number(ts, up: bool = False) -> Column:
    """Hours since the epoch of a naive time, rounded down (or up)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    us, hour = F.unix_micros(c.cast("timestamp")), F.lit(3_600_000_000)
    down = (us - F.pmod(us, hour)) / hour
    return (F.when(F.pmod(us, hour) > 0, down + 1).otherwise(down) if up else down).cast("long")


def spans(a: Column, b: Column) -> Column:
    """Array of (level, number) spans whose union is [a, b); empty if b <= a."""
    def at(j):
        size = F.pow(F.lit(2.0), j).cast("long")
        low = -F.floor(-a / size)   # first span that begins at a or later
        high = F.floor(b / size)    # the one after the last that ends at b or earlier
        open_ = low < high
        node = lambda i: F.struct(j.cast("int").alias("level"), i.cast("long").alias("number"))
        return F.array(F.when(open_ & (F.pmod(low, F.lit(2)) == 1), node(low)), F.when(open_ & (F.pmod(high, F.lit(2)) == 1), node(high - 1)))
    top = F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.ceil(F.log2(F.greatest(b - a, F.lit(1)).cast("double"))).cast("int")))
    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), top), at)), lambda s: s.isNotNull())


def indexed(intervals: DataFrame, first: Column, after: Column) -> DataFrame:
    """``intervals`` with a row for each span of [first, after)."""
    return intervals.select("*", F.inline(spans(first, after)))


def _levels(index: DataFrame) -> list[int]:
    return sorted(r.level for r in index.select("level").distinct().collect())  # LEVELS + 1 rows at most


def on_levels(hours: DataFrame, number: Column, levels: list[int]) -> DataFrame:
    """``hours`` with the span of each level that they lie in."""
    if not levels:
        return hours.select("*", F.lit(0).alias("level"), F.lit(0).cast("long").alias("number")).limit(0)
    nodes = F.array(*[F.struct(F.lit(j).alias("level"), F.floor(number / F.lit(1 << j)).cast("long").alias("number")) for j in levels])
    return hours.select("*", F.inline(nodes))


def covered(hours: DataFrame, ts: str, index: DataFrame, name: str) -> DataFrame:
    """``hours`` (distinct in ``ts``, or any rows) with a flag: whether the hour lies in any interval of the index."""
    nodes = index.select("level", "number").distinct()
    hit = (on_levels(hours.select(ts).distinct(), hour_number(ts), _levels(nodes)).join(nodes, ["level", "number"], "left_semi")
           .select(ts).distinct().withColumn(name, F.lit(True)))
    return hours.join(hit, ts, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def sum_covered(index: DataFrame, ids: list[str], hours: DataFrame, ts: str, measures: dict[str, Column]) -> DataFrame:
    """(ids, measures): sums over the hours of each interval; intervals without any hour are not there."""
    m = hours.select(hour_number(ts).alias("_hour"), *[c.cast("long").alias(n) for n, c in measures.items()])
    m = m.groupBy("_hour").agg(*[F.sum(n).alias(n) for n in measures])
    nodes = (on_levels(m, F.col("_hour"), _levels(index)).groupBy("level", "number").agg(*[F.sum(n).alias(n) for n in measures]))
    return index.join(nodes, ["level", "number"]).groupBy(*ids).agg(*[F.sum(n).alias(n) for n in measures])


# ---------------------------------------------------------------- J1, J2, J3, T6 over the index

def mark_overlap(hours: DataFrame, reports: DataFrame, name: str = "overlaps_reported_failure") -> DataFrame:
    """Hours [h, h + 1h) that overlap any report."""
    return covered(hours, "hour_ts", indexed(reports, hour_number("starts_at"), hour_number("ends_at", up=True)), name)


def _counted(reports: DataFrame, hours: DataFrame, ids: list[str], parts: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    out = reports
    for name, (first, after, measure) in parts.items():
        sums = sum_covered(indexed(reports.select(*ids, "starts_at", "ends_at"), first, after).select(*ids, "level", "number"),
                           ids, hours, "hour_ts", {name: measure})
        out = out.join(sums, ids, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
    return out


def review_counts(reports: DataFrame, candidates: DataFrame, ids: list[str], status: str) -> DataFrame:
    """Candidate hours that end in the 24 hours before a report, and that overlap it."""
    one = F.when(F.col("candidate_status") == status, 1).otherwise(0)
    s, e = hour_number("starts_at"), hour_number("ends_at", up=True)
    return _counted(reports, candidates, ids, {"candidate_hours_ending_in_prior_24h": (s - 24, s, one),
                                               "candidate_hours_overlapping_report": (s, e, one)})


def retrospective_counts(reports: DataFrame, candidates: DataFrame, ids: list[str], status: str) -> DataFrame:
    """Candidate hours that start in the 24 hours before a report, and during it."""
    one = F.when(F.col("candidate_status") == status, 1).otherwise(0)
    s, e = hour_number("starts_at", up=True), hour_number("ends_at", up=True)
    return _counted(reports, candidates, ids, {"candidate_hours_in_prior_24h": (s - 24, s, one),
                                               "candidate_hours_during_report": (s, e, one)})


def context_counts(reports: DataFrame, hours: DataFrame, ids: list[str], days: int, status: str) -> DataFrame:
    """Observed and candidate hours in a window of whole hours from ``days`` before a report to ``days`` after it."""
    s, e = hour_number("starts_at") - 24 * days, hour_number("ends_at", up=True) + 24 * days
    found = sum_covered(indexed(reports.select(*ids, "starts_at", "ends_at"), s, e).select(*ids, "level", "number"), ids, hours, "hour_ts",
                        {"observed_hours": F.lit(1), "candidate_hours": F.when(F.col("candidate_status") == status, 1).otherwise(0)})
    zero = {n: F.coalesce(n, F.lit(0)).cast("long") for n in ("observed_hours", "candidate_hours")}
    return reports.withColumn("expected_hours", e - s).join(found, ids, "left").withColumns(zero)
