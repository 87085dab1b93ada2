import datetime as dt

from pyspark.sql import types as T

from hourwise.spec import READING_SCHEMA

READING_TYPES = T.StructType(
    [T.StructField("source_row", T.LongType()), T.StructField("observed_at", T.TimestampNTZType())]
    + [T.StructField(a, T.DoubleType()) for a in READING_SCHEMA.analog]
    + [T.StructField(d, T.ShortType()) for d in READING_SCHEMA.digital]
    + [T.StructField("caudal_impulse", T.DoubleType())])

HOURLY_TYPES = T.StructType([
    T.StructField("hour_ts", T.TimestampNTZType()), T.StructField("readings", T.LongType()),
    T.StructField("loaded_readings", T.LongType()), T.StructField("low_pressure_loaded_readings", T.LongType())])

ORIGIN = dt.datetime(2020, 4, 17)
FLAGGED = {10, 11, 13, 15}
PLANNED = [h for h in range(16) if h != 12]


def island_rows(extra_hours=(), trailing_bad=False):
    """F2: 30 rows per planned hour; tp3 = 6 in seconds 0-14 of a flagged hour, else 8.5."""
    rows, n = [], 0
    for h in list(PLANNED) + list(extra_hours):
        for sec in range(30):
            n += 1
            flagged = h in FLAGGED or h in extra_hours
            tp3 = 6.0 if flagged and sec < 15 else 8.5
            rows.append((n, ORIGIN + dt.timedelta(hours=h, seconds=sec), 5.0, tp3, 5.0, 1.0, 8.5, 45.0, 7.0,
                         0, 0, 0, 0, 0, 0, 0, 0.0))
    return rows


def hourly_rows(spark, rows):
    from hourwise.operators.marts import HOURLY_COLUMNS
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, HOURLY_TYPES)
    for c in HOURLY_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double" if c.startswith(("avg", "panel", "oil", "pressure"))
                                                   else "long"))
    return df.select(*HOURLY_COLUMNS)
