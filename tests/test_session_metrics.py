"""Session rules and metric-query options."""
import datetime as dt
from types import SimpleNamespace

import pytest

from hourwise.plans.metrics import datasets, metric_query
from hourwise.session import checkpoint_dir, recommended_conf
from hourwise.spec import DEMO_V1

D = dt.datetime


def test_cluster_without_checkpoint_dir_is_an_error():
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)


def test_recommended_conf_sizes_partitions_by_shuffle():
    conf = recommended_conf(11 * 1024 ** 4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 11 * 1024 ** 4 // (128 << 20)
    assert conf["spark.sql.session.timeZone"] == "UTC"


def test_metric_query_grouping_raw_mode_and_limit(spark):
    inv = spark.createDataFrame(
        [(D(2024, 1, 1, 0), "Not evaluated", False, 0.1), (D(2024, 1, 1, 1), "Evaluated: breach", True, 0.2),
         (D(2024, 1, 2, 5), "Not evaluated", False, None)],
        "hour_ts timestamp_ntz, evaluation_status string, rule_eligible boolean, prior_low_fraction double")
    ds = datasets(DEMO_V1)["mart_hourly_investigation"]
    by = {r.evaluation_status: r.observed_hours
          for r in metric_query(inv, ds, ["observed_hours"], group_by=["evaluation_status"]).collect()}
    assert by == {"Not evaluated": 2, "Evaluated: breach": 1}
    empty = metric_query(inv, ds, ["eligibility_pct"], time_range=(D(2030, 1, 1), D(2030, 2, 1))).collect()
    assert len(empty) == 1 and empty[0].eligibility_pct is None          # no group-by: exactly one row
    grouped_empty = metric_query(inv, ds, ["observed_hours"], group_by=["evaluation_status"],
                                 time_range=(D(2030, 1, 1), D(2030, 2, 1))).collect()
    assert grouped_empty == []                                            # with group-by: no rows
    point = metric_query(inv, ds, ["prior_share_pct"], grain="day", timeseries=True).collect()
    assert {r.ts.day: r.prior_share_pct for r in point} == {1: None, 2: None}  # two hours on day 1 -> no point
    raw = metric_query(inv, ds, grain="day", raw_columns=["hour_ts", "evaluation_status"], order_by=["hour_ts"],
                       row_limit=2).collect()
    assert [r.hour_ts for r in raw] == [D(2024, 1, 1), D(2024, 1, 1)] and len(raw) == 2
