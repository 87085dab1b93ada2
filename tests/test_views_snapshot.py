"""SQL over the named views; snapshot publish gate and verified read."""
import pytest

from hourwise.operators import incidents as inc, marts, rule
from hourwise.plans.views import register_views
from hourwise.sources import snapshot as S
from hourwise.sources.readings import readings, reports
from hourwise.spec import DEMO_V1
from conftest import SF


def test_reference_style_sql_runs_on_views(spark):
    register_views(spark, readings(spark, SF), reports(spark), DEMO_V1)
    rows = spark.sql("""
        SELECT exclusion_reason, count(*) AS hours, min(hour_ts) AS first_hour, max(hour_ts) AS last_hour
        FROM mart_hourly_investigation GROUP BY 1 ORDER BY 1""").collect()
    assert sum(r.hours for r in rows) == spark.table("mart_hourly").count()
    lost = spark.sql("SELECT (SELECT COUNT(*) FROM readings) - (SELECT COALESCE(SUM(readings), 0) FROM mart_hourly) "
                     "AS lost_rows").first().lost_rows
    assert lost == 0
    q = spark.table("analytics_data_quality").first()
    assert q.reconciliation_difference == 0 and q.state_reconciliation_difference == 0


def _tables(spark):
    rd = readings(spark, SF)
    h = marts.hourly_mart(rd, DEMO_V1)
    inv = rule.investigation(h, reports(spark), DEMO_V1)
    return rd, h, {"hourly_investigation": (inv, ["hour_ts"]), "daily_metrics": (marts.daily_mart(h), ["reading_date"]),
                   "incidents": (inc.incidents(inv, DEMO_V1), ["starts_at"])}


def test_publish_refuses_subset_and_unreconciled(spark, tmp_path):
    rd, h, tables = _tables(spark)
    state = S.provenance_row(rd, "r1", "events", None, False).first().asDict()
    counts = S.reconcile_counts(rd, h, marts.daily_mart(h)).first().asDict()
    with pytest.raises(S.SnapshotError, match="complete-source"):
        S.publish_snapshot(spark, str(tmp_path / "a"), "s1", tables, state, counts, {})
    state["is_complete_source"] = True
    bad = dict(counts, hourly_rows=counts["hourly_rows"] - 1)
    with pytest.raises(S.SnapshotError, match="reconcile"):
        S.publish_snapshot(spark, str(tmp_path / "b"), "s1", tables, state, bad, {})


def test_publish_verify_and_tamper(spark, tmp_path):
    rd, h, tables = _tables(spark)
    state = S.provenance_row(rd, "r1", "events", None, True).first().asDict()
    counts = S.reconcile_counts(rd, h, marts.daily_mart(h)).first().asDict()
    root = str(tmp_path / "snap")
    S.publish_snapshot(spark, root, "s1", tables, state, counts, DEMO_V1.as_dict())
    frames, meta = S.read_snapshot(spark, root)
    assert meta["original_reading_count"] == state["original_rows"]
    assert frames["daily_metrics"].count() == marts.daily_mart(h).count()
    assert S.verify_snapshot(spark, root).filter("NOT ok").count() == 0
    folder, _ = S.current_snapshot(spark, root)
    part = sorted((tmp_path / "snap" / "snapshots" / "s1" / "incidents").glob("part-*"))[0]
    part.write_text(part.read_text() + "tampered\n")
    with pytest.raises(S.SnapshotError, match="checksum"):
        S.read_snapshot(spark, root)
    S.write_text(spark, root + "/CURRENT", "../escape")
    with pytest.raises(S.SnapshotError, match="pointer"):
        S.current_snapshot(spark, root)


def _publish(spark, root, sid, tables, state, counts, **more):
    return S.publish_snapshot(spark, root, sid, tables, state, counts, DEMO_V1.as_dict(), **more)


def test_existing_id_is_refused_and_failed_runs_can_be_repeated(spark, tmp_path):
    rd, h, tables = _tables(spark)
    state = S.provenance_row(rd, "r1", "events", None, True, S.now()).first().asDict()
    counts = S.reconcile_counts(rd, h, marts.daily_mart(h)).first().asDict()
    root = str(tmp_path / "a b")
    broken = dict(tables, incidents=(tables["incidents"][0], ["no_such_column"]))
    with pytest.raises(Exception, match="no_such_column"):
        _publish(spark, root, "s1", broken, state, counts)
    _publish(spark, root, "s1", tables, state, counts)
    with pytest.raises(S.SnapshotError, match="exists"):
        _publish(spark, root, "s1", tables, state, counts)
    assert not [p for p in (tmp_path / "a b" / "snapshots" / "s1").iterdir() if p.name.startswith(".s1")]
    _publish(spark, root, "s2", tables, state, counts)
    folder, meta = S.current_snapshot(spark, root)
    assert folder.endswith("/s2") and meta["exported_at"] and meta["loaded_at"] and meta["first_reading"]
    assert S.read_text(spark, root + "/CURRENT") == "s2"


def test_types_survive_the_round_trip(spark, tmp_path):
    rd, h, tables = _tables(spark)
    state = S.provenance_row(rd, "r1", "events", None, True).first().asDict()
    counts = S.reconcile_counts(rd, h, marts.daily_mart(h)).first().asDict()
    root = str(tmp_path / "snap")
    _publish(spark, root, "s1", tables, state, counts)
    frames, meta = S.read_snapshot(spark, root)
    for name, (df, _) in tables.items():
        assert frames[name].dtypes == df.dtypes
    types = dict(frames["hourly_investigation"].dtypes)
    assert types["hour_ts"] == "timestamp_ntz" and types["rule_eligible"] == "boolean"
    assert frames["hourly_investigation"].select("hour_ts", "rule_eligible", "candidate_status").exceptAll(
        tables["hourly_investigation"][0].select("hour_ts", "rule_eligible", "candidate_status")).count() == 0


def test_digests_of_large_files_and_folders(spark, tmp_path):
    import hashlib
    text = "".join(f"line {i}\n" for i in range(S.CHUNK_LINES + 5)).encode()
    (tmp_path / "a file.txt").write_bytes(text)
    (tmp_path / "b.txt").write_bytes(b"x\xff\ny")
    got = {r["name"]: r.sha256 for r in S.file_digests(spark, str(tmp_path), "*.txt", whole_bytes=100).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = [sha(x) for x in text.split(b"\n")[:-1]]
    chunks = [sha("".join(lines[i:i + S.CHUNK_LINES]).encode()) for i in range(0, len(lines), S.CHUNK_LINES)]
    assert got["b.txt"] == sha(b"x\xff\ny") and len(got) == 2
    assert [v for k, v in got.items() if k != "b.txt"] == ["tree-" + sha("".join(chunks).encode())]
    assert S.source_digest(spark, str(tmp_path / "b.txt")) == sha(b"x\xff\ny")
    both = S.source_digest(spark, str(tmp_path), "*.txt")
    (tmp_path / "b.txt").write_bytes(b"z")
    assert S.source_digest(spark, str(tmp_path), "*.txt") != both


def test_views_follow_their_source(spark, tmp_path):
    rd = readings(spark, "/root/testdata/sf0.01")
    path = str(tmp_path / "rd")
    rd.filter("source_row % 2 = 0").write.parquet(path)
    register_views(spark, spark.read.parquet(path), reports(spark), DEMO_V1)
    before = spark.table("mart_hourly").agg({"readings": "sum"}).first()[0]
    rd.filter("source_row % 2 = 1").write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    register_views(spark, spark.read.parquet(path), reports(spark), DEMO_V1)
    assert spark.table("mart_hourly").agg({"readings": "sum"}).first()[0] == rd.count() == 2 * before
    assert spark.table("mart_incidents").count() == inc.incidents(
        rule.investigation(marts.hourly_mart(rd, DEMO_V1), reports(spark), DEMO_V1), DEMO_V1).count() > 0


def test_queries_see_appended_data(spark, tmp_path):
    """Two calls of a query around an append give the results of their time (no plan or table is kept)."""
    from hourwise.plans import catalog
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    path = str(tmp_path / "events.parquet")
    ev.filter("event_id % 2 = 0").write.parquet(path)
    run = lambda q: catalog.queries()[q](spark, str(tmp_path)).count()
    half = run("incidents"), run("duplicate_timestamps")
    ev.filter("event_id % 2 = 1").write.mode("append").parquet(path)
    both = run("incidents"), run("duplicate_timestamps")
    assert half[0] != both[0] == catalog.queries()["incidents"](spark, "/root/testdata/sf0.01").count()
