"""Driver contract: registry loads without a Spark session; every query has a docstring; entry runs."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_registry_imports_without_spark():
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as E; "
            "q = E.queries(); o = E.oracle_sql(); assert set(o) <= set(q); print(len(q), len(o))" % ROOT)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]


def test_entry_flagship(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    df = E.entry(spark)
    assert len(df.columns) == 33 and df.count() > 0
    assert all(fn.__doc__ for fn in E.queries().values())


def test_executor_python_needs_no_installed_package(tmp_path):
    """Pandas-backed operators run from any working directory (functions are pickled by value)."""
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as E; "
            "from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
            "print(E.queries()['alert_state_log'](s, '/root/testdata/sf0.001').count())" % ROOT)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, cwd=str(tmp_path))
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.strip().splitlines()[-1]) > 0
