"""hourwise: telemetry investigation on Spark DataFrames.

Raw readings -> hourly/daily marts -> trailing calendar baseline -> versioned
threshold rule -> incidents -> report context, plus quality/audit queries,
a semantic metric layer, snapshots and alert evaluation.  Every operator is a
DataFrame-in, DataFrame-out function that carries optional ``keys`` (asset
columns) through every group and window so it scales out by asset.

Typical use::

    from hourwise import build_session, hourly_mart, investigation, incidents, PRESSURE_V1
    spark = build_session()
    hourly = hourly_mart(readings_df, PRESSURE_V1, keys=["asset_id"])
    inv = investigation(hourly, reports_df, PRESSURE_V1, keys=["asset_id"])
    inc = incidents(inv, PRESSURE_V1, keys=["asset_id"])
"""

from hourwise.spec import RuleSpec, PRESSURE_V1, DEMO_V1  # noqa: F401
from hourwise.session import build_session, checkpoint_dir, materialize, recommended_conf  # noqa: F401
from hourwise.operators.marts import hourly_mart, daily_mart, operating_states  # noqa: F401
from hourwise.operators.baseline import trailing_baseline, trailing_baseline_join  # noqa: F401
from hourwise.operators.rule import candidate_hours, investigation, mark_report_overlap  # noqa: F401
from hourwise.operators.incidents import incidents, assign_islands  # noqa: F401
from hourwise.operators.review import report_review, retrospective_review, report_context  # noqa: F401
from hourwise.operators.period import select_period, kpis  # noqa: F401
from hourwise.operators.alerts import alert_states  # noqa: F401
from hourwise.plans.metrics import datasets, metric_query  # noqa: F401
from hourwise.plans.views import register_views  # noqa: F401
from hourwise.plans.refresh import refresh  # noqa: F401
from hourwise.sources.csv_ingest import scan_csv  # noqa: F401
