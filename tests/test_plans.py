"""Plan-shape checks: no single-partition windows on the hourly/raw paths, period filter above the
baseline window, bucketed self-join without nested loops, pushdown into the parquet scan."""
from hourwise.plans.catalog import queries
from conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_baseline_window_is_partitioned(spark):
    p = plan(queries()["candidate_hours"](spark, SF))
    assert "Window" in p and "SinglePartition" not in p


def test_period_filter_stays_above_window(spark):
    df = queries()["period_hourly"](spark, SF)
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert opt.index("Filter") < opt.index("Window")  # filter printed above (applied after) the window


def test_self_join_is_hash_or_merge_join(spark):
    p = plan(queries()["baseline_self_join"](spark, SF))
    assert "NestedLoopJoin" not in p and ("SortMergeJoin" in p or "HashJoin" in p)


def test_scan_prunes_columns(spark):
    p = plan(queries()["audit_integrity"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in p


def test_raw_period_filter_pushed_to_scan(spark):
    p = plan(queries()["weighted_rollup_check"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_latest_n_limits_per_key_before_the_shuffle(spark):
    p = plan(queries()["alert_log_latest_n"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) and final per-alert limit


def test_no_nested_loop_or_cartesian_joins_in_core_queries(spark):
    for name in ["investigation", "incidents", "report_review", "retrospective_review", "report_context",
                 "window_vs_join_mismatch", "period_kpis", "upsert_reports"]:
        p = plan(queries()[name](spark, SF))
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, name
