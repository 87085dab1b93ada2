"""Column-expression helpers (all built-in Spark expressions, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz_lit(x) -> Column:
    """Naive timestamp literal, independent of the driver's and the session's time zone.

    Python datetimes are rendered as ISO text and cast to TIMESTAMP_NTZ (a bare
    ``lit(datetime)`` would be interpreted in the driver process's local zone).
    """
    import datetime as _dt
    if x is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(x, Column):
        return x.cast("timestamp_ntz")
    if isinstance(x, _dt.datetime):
        return F.lit(x.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(x, _dt.date):
        return F.lit(x.isoformat()).cast("timestamp_ntz")
    return F.lit(str(x)).cast("timestamp_ntz")


def date_lit(x) -> Column:
    import datetime as _dt
    if isinstance(x, _dt.datetime):
        x = x.date()
    return F.lit(str(x)).cast("date")


def local_frame(spark, rows, schema):
    """Small literal table built JVM-side (a Generate over one row; no Python RDD)."""
    from pyspark.sql.types import StructType, TimestampNTZType, DateType
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)

    def lit(v, f):
        if v is None:
            return F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, TimestampNTZType):
            return ntz_lit(v)
        if isinstance(f.dataType, DateType):
            return date_lit(v)
        return F.lit(v).cast(f.dataType)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [F.struct(*[lit(v, f).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def join_keys(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` where NULL keys match each other (``<=>``), keeping one copy of each key.

    Spark still plans this as a hash or sort-merge join (null-safe equality is
    rewritten to equi-join keys), so asset keys that are NULL keep their group.
    """
    lft, rgt = left.alias("_jl"), right.alias("_jr")
    cond = [F.col(f"_jl.`{c}`").eqNullSafe(F.col(f"_jr.`{c}`")) for c in cols]
    joined = lft.join(rgt, on=cond, how=how)
    if how in ("left_semi", "semi", "left_anti", "anti"):
        return joined
    if how not in ("inner", "left", "left_outer"):
        raise ValueError(f"join_keys supports inner/left/semi/anti joins, not {how}")
    rest = [F.col(f"_jr.`{c}`") for c in right.columns if c not in cols]
    return joined.select(*[F.col(f"_jl.`{c}`") for c in left.columns], *rest)


def trunc_hour(ts) -> Column:
    """Hour floor of a naive timestamp, kept naive (date_trunc returns LTZ)."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def ceil_hour(ts) -> Column:
    t = trunc_hour(ts)
    return F.when(t == _c(ts), t).otherwise(t + F.expr("INTERVAL 1 HOUR"))


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch of a naive timestamp (UTC session)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def seconds_between(later, earlier) -> Column:
    """Fractional seconds ``later - earlier`` (EXTRACT(EPOCH FROM interval))."""
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / F.lit(1e6)


def ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL (ratio of sums, never mean of ratios)."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double")


def stable_id(prefix: str, version: str, ts, keys: list[str] | None = None) -> Column:
    """prefix + first 12 hex digits of md5('version|[key|…]yyyy-MM-dd HH:mm:ss')."""
    parts = [F.lit(version + "|")]
    for k in keys or []:
        parts += [F.col(k).cast("string"), F.lit("|")]
    parts.append(F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss"))
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat(*parts)), 1, 12))


def truthy(x) -> Column:
    return F.lower(F.trim(_c(x).cast("string"))).isin("t", "true", "1")


def null_safe_differs(left: list, right: list) -> Column:
    """ROW(a…) IS DISTINCT FROM ROW(b…)."""
    return ~F.struct(*[_c(a) for a in left]).eqNullSafe(F.struct(*[_c(b) for b in right]))


def within_tolerance(a, b, rel: float = 1e-10, abs_tol: float = 1e-8) -> Column:
    """math.isclose semantics; two NULLs compare equal, one NULL does not."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    close = F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(close)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column (output hygiene for cross-engine comparison)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
