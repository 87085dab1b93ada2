"""Small operators: densify per key, upsert guard, table diff, tolerance compare, id stability,
report clipping and context windows."""
import datetime as dt

import pytest

from hourwise.operators import compare as U, review, timegrid as T
from hourwise.sources import snapshot as S
from hourwise.sources.readings import reports

D = dt.datetime


def test_densify_per_key_keeps_gaps_null(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1, 0), 1.0), ("a", D(2024, 1, 1, 2), 2.0), ("b", D(2024, 1, 1, 1), 3.0)],
                               "k string, ts timestamp_ntz, v double")
    out = {(r.k, r.ts.hour): r.v for r in T.densify(df, "ts", 3600, D(2024, 1, 1), D(2024, 1, 1, 3), ["k"]).collect()}
    assert out == {("a", 0): 1.0, ("a", 1): None, ("a", 2): 2.0, ("b", 0): None, ("b", 1): 3.0, ("b", 2): None}


def test_upsert_replaces_by_key_and_rejects_duplicates(spark):
    base = reports(spark)
    new = reports(spark, rows=[(2, D(2024, 1, 14), D(2024, 1, 16), "revised"), (9, D(2024, 1, 2), D(2024, 1, 3), "new")])
    got = {r.report_id: r.report_type for r in S.upsert(base, new, ["report_id"]).collect()}
    assert got[2] == "revised" and got[9] == "new" and len(got) == 5
    dup = reports(spark, rows=[(9, D(2024, 1, 2), D(2024, 1, 3), "x"), (9, D(2024, 1, 4), D(2024, 1, 5), "y")])
    with pytest.raises(S.SnapshotError, match="duplicate key"):
        S.upsert(base, dup, ["report_id"])


def test_table_diff_ignores_volatile_columns(spark):
    a = spark.createDataFrame([(1, "x", 10), (2, "y", 20)], "id int, v string, changed_on int")
    b = spark.createDataFrame([(1, "x", 99), (2, "z", 20)], "id int, v string, changed_on int")
    rows = {(r.id, r.v, r.side) for r in U.table_diff(a, b, ["changed_on"]).collect()}
    assert rows == {(2, "y", "before_only"), (2, "z", "after_only")}


def test_tolerance_compare(spark):
    a = spark.createDataFrame([(1, 1.0, "p"), (2, 2.0, None), (3, 3.0, "q")], "k int, x double, s string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, "p"), (2, 2.1, None), (4, 4.0, "r")], "k int, x double, s string")
    r = {row.k: row for row in U.tolerance_compare(a, b, ["k"], ["x", "s"]).collect()}
    assert r[1].all_match and not r[2].x_matches and r[2].s_matches
    assert not r[3].in_right and not r[4].in_left and not r[3].all_match


def test_id_stability(spark):
    prior = spark.createDataFrame([(D(2024, 1, 1), "INC-a"), (D(2024, 1, 2), "INC-b")], "starts_at timestamp_ntz, incident_id string")
    cur = spark.createDataFrame([(D(2024, 1, 1), "INC-a"), (D(2024, 1, 2), "INC-c")], "starts_at timestamp_ntz, incident_id string")
    assert [r.incident_id for r in U.id_stability(prior, cur, ["starts_at"], "incident_id").collect()] == ["INC-b"]


def test_clip_and_context(spark):
    rep = reports(spark)
    bands = {r.report_id: (r.band_start, r.band_end) for r in review.clip_reports(rep, D(2024, 1, 15), D(2024, 1, 21)).collect()}
    assert bands == {2: (D(2024, 1, 15), D(2024, 1, 15, 6)), 3: (D(2024, 1, 20, 10), D(2024, 1, 21))}
    hours = spark.createDataFrame([(D(2024, 1, 9, 5), "REVIEW_PRESSURE")], "hour_ts timestamp_ntz, candidate_status string")
    ctx = {r.report_id: r for r in review.report_context(rep, hours, 3).collect()}
    assert ctx[1].window_start == D(2024, 1, 6) and ctx[1].window_end == D(2024, 1, 13)  # 23:59 + 3 d -> ceil hour
    assert ctx[1].expected_hours == 168 and ctx[1].observed_hours == 1 and ctx[1].candidate_hours == 1
    with pytest.raises(ValueError):
        review.report_context(rep, hours, -1)


def test_null_asset_key_keeps_its_islands(spark):
    """Keys are joined null-safely: a NULL asset is its own group, not dropped."""
    from hourwise.operators.incidents import assign_islands
    rows = [(None, D(2024, 1, 1, h)) for h in (0, 1, 5)] + [(1, D(2024, 1, 1, h)) for h in (0, 2)]
    df = spark.createDataFrame(rows, "asset int, hour_ts timestamp_ntz")
    got = {(r.asset, r.hour_ts.hour): r.island_start.hour for r in assign_islands(df, ["asset"], chunk_days=1).collect()}
    assert got == {(None, 0): 0, (None, 1): 0, (None, 5): 5, (1, 0): 0, (1, 2): 2}


def _audit_rows(spark, **changes):
    from hourwise.operators import audit as A
    recon = dict(observed_hours=10, eligible_hours=4, not_evaluated_hours=6, evaluated_no_breach=3, evaluated_breach=1,
                 current_only=2, baseline_only=1, both=2, eligible_null_rate=0)
    window = dict(compared_hours=10, mismatched_hours=0, mismatched_eligibility=0)
    missing = dict(missing_rates=1)
    frames = []
    for part in (recon, window, missing):
        values = {k: changes.get(k, v) for k, v in part.items()}
        frames.append(spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} long" for k in values)))
    return {r.check: r.ok for r in A.invariants(*frames).collect()}


def test_every_audit_check_can_fail(spark):
    assert all(_audit_rows(spark).values())
    tampered = {"eligible_hours": {"eligible_plus_not_evaluated_equals_observed", "evaluated_split_equals_eligible"},
                "evaluated_breach": {"evaluated_split_equals_eligible"}, "current_only": {"exclusion_reasons_sum_to_not_evaluated"},
                "missing_rates": {"exclusion_reasons_sum_to_not_evaluated"}, "eligible_null_rate": {"eligible_null_rate_is_zero"},
                "compared_hours": {"compared_equals_observed"}, "mismatched_hours": {"window_mismatches_zero"},
                "mismatched_eligibility": {"eligibility_mismatches_zero"}}
    for column, checks in tampered.items():
        assert {k for k, ok in _audit_rows(spark, **{column: 999}).items() if not ok} == checks


def test_id_stability_reports_changed_ids(spark):
    from hourwise.operators.compare import id_stability
    cols = "starts_at timestamp_ntz, incident_id string"
    prior = spark.createDataFrame([(D(2024, 1, 1), "a"), (D(2024, 1, 2), "b")], cols)
    now = spark.createDataFrame([(D(2024, 1, 1), "a"), (D(2024, 1, 2), "c"), (D(2024, 1, 3), "b")], cols)
    assert [r.incident_id for r in id_stability(prior, now, ["starts_at"], "incident_id").collect()] == ["b"]
    assert id_stability(now, now, ["starts_at"], "incident_id").count() == 0
