"""Incremental refresh: marts stored by day, of which only the touched days are rewritten.

A mart folder holds four tables, each partitioned by ``day``: ``hourly`` and ``daily``, ``scored`` (the
investigation columns) and ``incidents`` (by the day they start). When readings of some days change:

* ``hourly`` and ``daily`` are rebuilt for these days only, from the readings of these days (a range filter on
  ``observed_at`` and the days themselves reach the scan);
* ``scored`` is rebuilt for the closure: a changed day and every later day whose look-back reaches it. The window reads the
  stored hours of the closure and of the look-back before it, by partition;
* an incident is rebuilt if it touches the closure: its hours outside are read again from ``scored``, so runs that
  now join, part, grow or vanish come out as in a full build.

The new partitions are written to a staging folder first. Then a redo file names them, they replace the stored
ones by dynamic partition overwrite, days that have become empty are deleted, and the redo file goes. A refresh that
finds a redo file replays it, so a lost driver leaves no mixture behind. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.functions.columns import date_lit, join_keys, ntz_lit
from hourwise.operators import incidents as inc, marts, rule
from hourwise.session import checkpoint_dir
from hourwise.sources.snapshot import _fs, exists, read_text, rename, write_text
from hourwise import spec as S
from hourwise.spec import RuleSpec

TABLES = ("hourly", "daily", "scored", "incidents")
REDO, SCHEMAS = "_redo.json", "_schemas.json"
DAY = dt.timedelta(days=1)


def by_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("day", F.to_date(ts))


def changed_days(rows: DataFrame, ts: str = "observed_at") -> list[dt.date]:
    """Days of some readings; the list has as many entries as there are different days."""
    return sorted(r.day for r in rows.select(F.to_date(ts).alias("day")).distinct().collect() if r.day is not None)


def closure(days, lookback_seconds: int) -> list[dt.date]:
    """The days and all later ones whose look-back window reaches one of them."""
    reach = -(-lookback_seconds // 86400)
    return sorted({d + i * DAY for d in days for i in range(reach + 1)})


def spans(days) -> list[tuple[dt.date, dt.date]]:
    """Days as [first, after) spans without gaps."""
    out: list[list[dt.date]] = []
    for d in sorted(set(days)):
        if out and out[-1][1] == d:
            out[-1][1] = d + DAY
        else:
            out.append([d, d + DAY])
    return [tuple(x) for x in out]


def on_days(days, ts: str):
    """Condition for a time inside one of the days, as ranges that a scan can skip row groups by."""
    cond = F.lit(False)
    for lo, hi in spans(days):
        cond = cond | ((F.col(ts) >= ntz_lit(lo)) & (F.col(ts) < ntz_lit(hi)))
    return cond


def day_in(days):
    return F.col("day").isin([date_lit(d) for d in sorted(set(days))]) if days else F.lit(False)


class Marts:
    """The mart folder below ``root``."""

    def __init__(self, spark: SparkSession, root: str, spec: RuleSpec, keys: list[str] | None = None):
        self.spark, self.root, self.spec, self.keys = spark, root.rstrip("/"), spec, list(keys or [])
        checkpoint_dir(spark)

    def path(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def schemas(self) -> dict[str, T.StructType]:
        return {k: T.StructType.fromJson(v) for k, v in json.loads(read_text(self.spark, self.path(SCHEMAS))).items()}

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """A stored table, with its ``day``."""
        return self.spark.read.schema(schema or self.schemas()[name]).parquet(self.path(name))

    # ------------------------------------------------------------ full build

    def build(self, readings: DataFrame, reports: DataFrame) -> None:
        """All days, into a new folder."""
        hourly = by_day(marts.hourly_mart(readings, self.spec, self.keys), "hour_ts")
        self._write(hourly, self.path("hourly"))
        hourly = self.read("hourly", hourly.schema)
        daily = marts.daily_mart(hourly, self.keys).withColumn("day", F.col("reading_date"))
        self._write(daily, self.path("daily"))
        scored = by_day(rule.investigation(hourly.drop("day"), reports, self.spec, self.keys), "hour_ts")
        self._write(scored, self.path("scored"))
        scored = self.read("scored", scored.schema)
        found = by_day(inc.incidents(scored.drop("day"), self.spec, self.keys, materialize_input=False), "starts_at")
        self._write(found, self.path("incidents"))
        kinds = {"hourly": hourly, "daily": daily, "scored": scored, "incidents": found}
        write_text(self.spark, self.path(SCHEMAS), json.dumps({k: json.loads(v.schema.json()) for k, v in kinds.items()}))

    def _write(self, df: DataFrame, path: str) -> None:
        # one shuffle by day, so that a day is a few files and not one from every task
        df.repartition("day").write.mode("errorifexists").partitionBy("day").parquet(path)

    # ------------------------------------------------------------ part of the days

    def refresh(self, readings: DataFrame, reports: DataFrame, days, report_days=()) -> dict[str, list[dt.date]]:
        """Rebuild what readings of ``days`` (and reports that cover ``report_days``) reach; returns the days replaced by table."""
        self.replay()
        days, kinds = sorted(set(days)), self.schemas()
        scored_days = sorted(set(closure(days, self.spec.lookback_seconds)) | set(report_days))
        if not scored_days:
            return {name: [] for name in TABLES}
        stage = self.path("_stage-" + uuid.uuid4().hex)
        put = lambda name, df: (self._write(df.select(*kinds[name].names), posixpath.join(stage, name)),
                                self.spark.read.schema(kinds[name]).parquet(posixpath.join(stage, name)))[1]
        new = readings.filter(on_days(days, "observed_at"))
        hourly = put("hourly", by_day(marts.hourly_mart(new, self.spec, self.keys), "hour_ts"))
        daily = put("daily", marts.daily_mart(hourly, self.keys).withColumn("day", F.col("reading_date")))
        # the window needs the look-back before each day of the closure
        reach = -(-self.spec.lookback_seconds // 86400)
        needed = {d - i * DAY for d in scored_days for i in range(reach + 1)}
        hours = self.read("hourly").filter(day_in(needed - set(days))).unionByName(hourly.filter(day_in(days)))
        cand = rule.candidate_hours(hours.drop("day"), self.spec, self.keys).filter(on_days(scored_days, "hour_ts"))
        scored = put("scored", by_day(rule.investigation(None, reports, self.spec, self.keys, candidates=cand), "hour_ts"))
        incidents, start_days = self._incidents(scored, scored_days)
        fresh = put("incidents", incidents)
        plan = {"hourly": (days, hourly), "daily": (days, daily), "scored": (scored_days, scored), "incidents": (start_days, fresh)}
        redo = {"stage": stage, "tables": {}}
        for name, (own, df) in plan.items():
            there = {r.day for r in df.select("day").distinct().collect()}  # a row for each day
            redo["tables"][name] = {"empty": [str(d) for d in own if d not in there], "full": [str(d) for d in sorted(there)]}
        fresh_redo = self.path("." + uuid.uuid4().hex)
        write_text(self.spark, fresh_redo, json.dumps(redo))
        rename(self.spark, fresh_redo, self.path(REDO), replace=True)
        self.replay()
        return {name: [dt.date.fromisoformat(d) for d in sorted(x["full"] + x["empty"])] for name, x in redo["tables"].items()}

    def _incidents(self, scored: DataFrame, days) -> tuple[DataFrame, list[dt.date]]:
        """New content of the partitions of ``incidents`` that incidents touching ``days`` start in."""
        old, grain = self.read("incidents"), self.spec.grain_seconds
        touch = F.lit(False)
        for lo, hi in spans(days):
            touch = touch | ((F.col("starts_at") <= ntz_lit(hi)) & (F.col("ends_at") >= ntz_lit(lo)))
        touched = old.filter(touch)
        bounds = touched.agg(F.min("starts_at").alias("lo"), F.max("ends_at").alias("hi")).first()
        hit = F.col("candidate_status") == S.REVIEW_PRESSURE
        hours = scored.filter(hit)
        if bounds.lo is not None:
            slots = touched.select(*self.keys, F.explode(F.sequence("starts_at", F.col("ends_at") - F.expr(f"INTERVAL {grain} SECONDS"),
                                                                   F.expr(f"INTERVAL {grain} SECONDS"))).alias("hour_ts"))
            around = self.read("scored").filter(hit & F.col("day").between(date_lit(bounds.lo), date_lit(bounds.hi)) & ~day_in(days))
            hours = hours.unionByName(join_keys(around, slots, [*self.keys, "hour_ts"], "left_semi"))
        found = by_day(inc.incidents(hours.drop("day"), self.spec, self.keys), "starts_at")
        starts = sorted({r.day for r in touched.select("day").unionByName(found.select("day")).distinct().collect()})
        others = old.filter(day_in(starts) & ~F.coalesce(touch, F.lit(False)))
        return others.unionByName(found), starts

    def replay(self) -> bool:
        """Finish a refresh whose redo file is there; replaying twice gives the same tables."""
        if not exists(self.spark, self.path(REDO)):
            return False
        redo, kinds = json.loads(read_text(self.spark, self.path(REDO))), self.schemas()
        fs, _ = _fs(self.spark, self.root)
        remove = lambda p: fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(p), True)
        for name, x in redo["tables"].items():
            if x["full"]:
                (self.spark.read.schema(kinds[name]).parquet(posixpath.join(redo["stage"], name)).repartition("day")
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path(name)))
            for d in x["empty"]:
                remove(self.path(name, f"day={d}"))
        remove(self.path(REDO))
        remove(redo["stage"])
        return True
