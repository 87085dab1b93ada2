"""As-of joins, the dyadic interval index, sketches and bucketed upserts against brute force."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF, ts
from hourwise.operators import intervals as V, sketches as K
from hourwise.operators.asof import asof_join
from hourwise.plans.catalog import readings
from hourwise.sources.buckets import REDO, BucketTable, SnapshotError

T0 = ts(2024, 1, 1)
LEFT, RIGHT = "id long, k string, at timestamp_ntz", "k string, since timestamp_ntz, v int"


def brute(left, right, tolerance=None):
    out = []
    for i, k, at in left:
        best = max(((s, v is not None, v or 0) for kk, s, v in right if kk == k and s is not None and at is not None and s <= at), default=None)
        if best and tolerance is not None and (at - best[0]).total_seconds() > tolerance:
            best = None
        out.append((i, k, at, best[2] if best and best[1] else None, best[0] if best else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,tolerance", [(1, None), (2, 3000), (3, 0)])
def test_asof_against_brute_force(spark, seed, tolerance):
    rng = random.Random(seed)
    at = lambda: rng.choice([None] + [T0 + dt.timedelta(minutes=rng.randrange(4000))] * 20)
    keys = ["a"] * 30 + ["b", "c", None]  # one hot key, nulls, keys of one side
    left = [(i, rng.choice(keys), at()) for i in range(700)] + [(700 + i, "hot", T0) for i in range(300)] + [(1000, "left only", T0)]
    right = [(rng.choice(keys), at(), rng.randrange(50)) for _ in range(300)] + [("hot", T0, 3), ("right only", T0, 1), ("a", T0, None)]
    right += [("b", T0, n) for n in (4, 9, 7)]  # ties take the greatest value
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "at", "since", ["k"],
                    {"v": "v", "since": "since"}, tolerance)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(left, right, tolerance)


def test_asof_without_keys_age_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "x", T0 + dt.timedelta(seconds=90)), (2, "x", None)], LEFT)
    right = spark.createDataFrame([("y", T0, 5)], RIGHT)
    got = asof_join(left, right, "at", "since", values={"v": "match"}, age="age")
    assert got.columns == ["id", "k", "at", "match", "age"]
    assert sorted((r.id, r.match, r.age) for r in got.collect()) == [(1, 5, 90.0), (2, None, None)]
    assert [r.match for r in asof_join(left, right.limit(0), "at", "since", values={"v": "match"}).collect()] == [None, None]
    assert asof_join(left.limit(0), right, "at", "since", values={"v": "match"}).count() == 0


def test_asof_has_no_window_over_a_key(spark):
    left = spark.createDataFrame([(i, "k", T0 + dt.timedelta(seconds=i)) for i in range(500)], LEFT)
    right = spark.createDataFrame([("k", T0, 5)], RIGHT)
    df = asof_join(left, right, "at", "since", ["k"], {"v": "v"})
    # the rows are dealt over several partitions although there is one key
    assert df.count() == 500 and df.filter("v = 5").count() == 500
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan


# ---------------------------------------------------------------- intervals

def test_spans_cover_each_hour_once(spark):
    rng = random.Random(3)
    pairs = [(a, a + n) for a, n in [(0, 0), (5, -3), (-7, 13), (2 ** 40, 2 ** 39 + 1), (473352, 1)]
             + [(rng.randrange(-100, 500000), rng.randrange(0, 700)) for _ in range(200)]]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", V.spans(F.col("a"), F.col("b")).alias("s")).collect()
    for r in got:
        n = max(0, r.b - r.a)
        assert len(r.s) <= 2 * max(1, n).bit_length()
        assert sum(1 << x.level for x in r.s) == n
        edges = sorted((x.number << x.level, (x.number + 1) << x.level) for x in r.s)
        assert not n or (edges[0][0], edges[-1][1]) == (r.a, r.b) and all(x[1] == y[0] for x, y in zip(edges, edges[1:]))


def test_long_reports_make_no_row_for_every_hour(spark):
    rep = spark.range(2000).select((F.col("id") + 1).alias("report_id"), F.lit(T0).cast("timestamp_ntz").alias("starts_at"),
                                   (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.col("id"))).alias("ends_at"))
    index = V.indexed(rep, V.hour_number("starts_at"), V.hour_number("ends_at", up=True))
    assert index.count() < 2000 * 32 < 2000 * 1000 * 24 / 100
    hours = spark.range(24 * 400).select((F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id"))).alias("hour_ts"))
    got = V.sum_covered(index.select("report_id", "level", "number"), ["report_id"], hours, "hour_ts", {"n": F.lit(1)})
    assert {(r.report_id, r.n) for r in got.collect()} == {(i + 1, min(24 * i, 24 * 400)) for i in range(2000) if i}
    assert V.mark_overlap(hours, rep.filter("report_id = 11")).filter("overlaps_reported_failure").count() == 240
    assert V.mark_overlap(hours, rep.limit(0)).filter("overlaps_reported_failure").count() == 0


# ---------------------------------------------------------------- sketches

def test_sketches_merge_and_stay_within_their_bounds(spark):
    rd = readings(spark, SF)
    h = K.hourly_sketches(rd, ["asset_id"])
    days = K.merged(h, F.to_date("hour_ts").alias("reading_date"))
    est = K.estimates(days, ["reading_date"])
    exact = K.against_exact(rd, F.to_date("observed_at"), "reading_date", est).collect()
    assert len(exact) == 30 and all(r.distinct_ok and r.pressure_p50_ok and r.pressure_p95_ok and r.current_p50_ok for r in exact)
    assert all(r.distinct_times_low <= r.distinct_times <= r.distinct_times_high + 1 for r in exact)
    wide = spark.range(300_000).selectExpr("id as source_row", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 200000) as observed_at",
                                           "cast(id % 1000 as double) as tp3", "cast(id as double) as motor_current")
    one = K.merged(K.hourly_sketches(wide), F.lit("all").alias("period"))
    r = K.against_exact(wide, F.lit("all"), "period", K.estimates(one, ["period"])).first()
    assert r.distinct_times == 200_000 and r.distinct_ok and r.pressure_p95_ok and r.current_p50_ok
    assert abs(r.distinct_times_estimate - 200_000) < K.COUNT_ERROR * 200_000 and abs(r.current_p50 - 150_000) < 0.02 * 300_000
    wrong = K.estimates(one, ["period"]).withColumns({"current_p50": F.lit(1000.0), "distinct_times_low": F.lit(210_000.0)})
    r = K.against_exact(wide, F.lit("all"), "period", wrong).first()
    assert not r.current_p50_ok and not r.distinct_ok


# ---------------------------------------------------------------- bucketed upsert

def test_upsert_rewrites_touched_buckets_only(spark, tmp_path, monkeypatch):
    rows = [(i, f"n{i}") for i in range(500)] + [(None, "null key")]
    t = BucketTable(spark, str(tmp_path / "t"))
    t.create(spark.createDataFrame(rows, "id long, name string"), ["id"], 16)
    digests = lambda: {r.path: r.sha for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                       .load(t.path("rows")).select("path", F.sha2("content", 256).alias("sha")).collect()}
    before, old = digests(), {(r.bucket, r.file) for r in t.files().collect()}
    touched = t.upsert(spark.createDataFrame([(3, "new"), (1000, "added")], "id long, name string"))
    assert 1 <= len(touched) <= 2
    want = sorted([(i, "new" if i == 3 else n) for i, n in rows] + [(1000, "added")], key=repr)
    assert sorted(map(tuple, t.read().collect()), key=repr) == want
    kept = {f for b, f in old if b not in touched}
    now = {r.file for r in t.files().collect()}
    assert kept <= now and len(kept) >= 14 and not {f for b, f in old if b in touched} & now
    after = digests()
    assert sum(after.get(p) == s for p, s in before.items()) == len(kept)
    with pytest.raises(SnapshotError, match="duplicate key"):
        t.upsert(spark.createDataFrame([(3, "x"), (3, "y")], "id long, name string"))
    assert t.upsert(t.read().limit(0)) == [] and digests() == after
    # cut off between staging and replacement: the next writer finishes it
    replay = BucketTable.replay
    monkeypatch.setattr(BucketTable, "replay", lambda self: False)
    t.upsert(spark.createDataFrame([(7, "seven")], "id long, name string"))
    monkeypatch.setattr(BucketTable, "replay", replay)
    assert (tmp_path / "t" / REDO).exists() and t.read().filter("name = 'seven'").count() == 0
    assert t.replay() and t.read().filter("name = 'seven'").count() == 1 and t.read().count() == len(want)


# ---------------------------------------------------------------- byte-range digests

def test_range_digests_of_files_of_any_size(spark, tmp_path):
    import hashlib
    import os

    from hourwise.sources.ranges import file_ranges, range_digests
    folder = tmp_path / "some files, with spaces & %20"
    folder.mkdir()
    content = {"a.bin": b"", "b.bin": b"x", "c.bin": os.urandom(1000), "d.bin": os.urandom(1001), "e f%41.bin": os.urandom(12_345)}
    for name, data in content.items():
        (folder / name).write_bytes(data)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for size in (100, 1000, 1 << 20):
        got = {os.path.basename(r.path): (r.bytes, r.sha256) for r in range_digests(spark, str(folder), range_bytes=size).collect()}
        want = {}
        for name, data in ((k, v) for k, v in content.items() if v):  # readers leave empty files out
            parts = [data[i:i + size] for i in range(0, len(data), size)]
            want[name] = (len(data), "tree-" + sha("".join(map(sha, parts)).encode()))
        assert got == want
    ranges = file_ranges(spark, str(folder), range_bytes=100).filter("bytes = 12345")
    assert ranges.count() == 124 and ranges.agg(F.max("size"), F.sum("size")).first() == (100, 12345)
