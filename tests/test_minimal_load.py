"""F3 minimal load: counts (raw, sum hourly, reports, candidates) = (3, 3, 4, 0); hour 00 overlaps a report;
an identical rerun gives identical results."""
import datetime as dt

from pyspark.sql import functions as F

from hourwise.operators import marts, review, rule
from hourwise.sources.readings import reports
from hourwise.spec import PRESSURE_V1
from helpers import READING_TYPES

D = dt.datetime
# fixed values: the reference's four seeded report intervals
SEED_REPORTS = [(1, D(2020, 4, 18, 0, 0), D(2020, 4, 18, 23, 59), "Reported air leak"),
                (2, D(2020, 5, 29, 23, 30), D(2020, 5, 30, 6, 0), "Reported air leak"),
                (3, D(2020, 6, 5, 10, 0), D(2020, 6, 7, 14, 30), "Reported air leak"),
                (4, D(2020, 7, 15, 14, 30), D(2020, 7, 15, 19, 0), "Reported air leak")]


def run(spark):
    rows = [(i + 1, t, 5.0, tp3, 5.0, 1.0, 7.5, 45.0, 7.0, 0, 0, 0, 0, 0, 0, 0, 0.0)
            for i, (t, tp3) in enumerate([(D(2020, 4, 18, 0, 1), 6.2), (D(2020, 4, 18, 0, 2), 8.0),
                                          (D(2020, 4, 18, 1, 1), 6.0)])]
    rd = spark.createDataFrame(rows, READING_TYPES)
    rep = reports(spark, rows=SEED_REPORTS)
    h = marts.hourly_mart(rd, PRESSURE_V1)
    inv = rule.investigation(h, rep, PRESSURE_V1)
    counts = (rd.count(), h.agg(F.sum("readings")).first()[0], rep.count(),
              inv.filter(F.col("candidate_status") == "REVIEW_PRESSURE").count())
    overlap = {r.hour_ts: r.overlaps_reported_failure for r in inv.collect()}
    rv = review.report_review(rep, rule.candidate_hours(h, PRESSURE_V1)).orderBy("report_id").collect()
    return counts, overlap, [tuple(r) for r in rv]


def test_minimal_load_and_rerun(spark):
    counts, overlap, rv = run(spark)
    assert counts == (3, 3, 4, 0)
    assert overlap[D(2020, 4, 18, 0)] is True and overlap[D(2020, 4, 18, 1)] is True
    assert [r[4:] for r in rv] == [(0, 0)] * 4
    assert run(spark) == (counts, overlap, rv)
