"""Comparison operators: table diff (U1), tolerance compare (U5/J10),
mismatch counting (U3/P13) and id stability (J12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwise.functions.columns import within_tolerance
from hourwise.session import materialize


def table_diff(before: DataFrame, after: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Rows present on one side only (multiset difference both ways), volatile columns ignored."""
    ignore = set(ignore or [])
    cols = [c for c in before.columns if c not in ignore]
    # each side is read by both multiset differences: written once
    b, a = materialize(before.select(*cols), "diff_before"), materialize(after.select(*cols), "diff_after")
    return (b.exceptAll(a).withColumn("side", F.lit("before_only"))
            .unionByName(a.exceptAll(b).withColumn("side", F.lit("after_only"))))


def tolerance_compare(left: DataFrame, right: DataFrame, key: list[str], cols: list[str],
                      rel: float = 1e-10, abs_tol: float = 1e-8) -> DataFrame:
    """Full join on ``key``; per column ``<col>_matches`` (isclose for numbers, null-safe otherwise)."""
    lsel = left.select(*key, *[F.col(c).alias(f"l_{c}") for c in cols], F.lit(True).alias("_l"))
    rsel = right.select(*key, *[F.col(c).alias(f"r_{c}") for c in cols], F.lit(True).alias("_r"))
    j = lsel.join(rsel, on=key, how="full")
    out = [*key, F.coalesce("_l", F.lit(False)).alias("in_left"), F.coalesce("_r", F.lit(False)).alias("in_right")]
    checks = []
    for c in cols:
        dtype = dict(left.dtypes)[c]
        if dtype in ("double", "float") or dtype.startswith("decimal"):
            m = within_tolerance(f"l_{c}", f"r_{c}", rel, abs_tol)
        else:
            m = F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))
        checks.append(m.alias(f"{c}_matches"))
    res = j.select(*out, *checks)
    all_ok = F.col("in_left") & F.col("in_right")
    for c in cols:
        all_ok = all_ok & F.col(f"{c}_matches")
    return res.withColumn("all_match", all_ok)


def id_stability(prior: DataFrame, current: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """Prior (key, id) pairs that no longer map to the same id; must be empty."""
    return prior.select(*key, id_col).join(current.select(*key, id_col), on=[*key, id_col], how="left_anti")
