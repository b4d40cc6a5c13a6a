"""Small grids for tests."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tidegrid.model import conform

NAN = float("nan")
RAW = "time timestamp_ntz, zlev int, lat_idx int, lon_idx int, lat double, lon double, sst float, anom float, err float, ice float"


def noon(day: int, month: int = 1, year: int = 2025) -> dt.datetime:
    return dt.datetime(year, month, day, 12)


def cell(time, lat_idx=0, lon_idx=0, sst=1.0, anom=0.5, err=0.25, ice=NAN, zlev=1):
    return (time, zlev, lat_idx, lon_idx, -89.875 + 0.25 * lat_idx, 0.125 + 0.25 * lon_idx, sst, anom, err, ice)


def raw_grid(spark, cells):
    return spark.createDataFrame(cells, RAW)


def grid(spark, cells):
    return conform(raw_grid(spark, cells))


def dense(spark, days: int, n_lat: int, n_lon: int):
    """A full grid with distinct values."""
    ids = spark.range(days * n_lat * n_lon)
    per_day = n_lat * n_lon
    day, rest = F.floor(F.col("id") / per_day), F.col("id") % per_day
    return conform(
        ids.select(
            (F.date_add(F.lit("2025-01-01").cast("date"), day.cast("int")).cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")).alias("time"),
            F.lit(1).alias("zlev"),
            F.floor(rest / n_lon).cast("int").alias("lat_idx"),
            (rest % n_lon).cast("int").alias("lon_idx"),
            (F.floor(rest / n_lon) * 0.25 - 89.875).alias("lat"),
            ((rest % n_lon) * 0.25 + 0.125).alias("lon"),
            F.col("id").cast("float").alias("sst"),
            (F.col("id") % 7).cast("float").alias("anom"),
            (F.col("id") % 5).cast("float").alias("err"),
            (F.col("id") % 3).cast("float").alias("ice"),
        )
    )


def ordered(rows):
    """Rows sorted column by column, None last."""
    return sorted(rows, key=lambda r: [(v is None, isinstance(v, str), 0 if v is None else v) for v in r])


def values(df, *columns):
    """Sorted rows with NaN as text."""
    rows = df.select(*columns).collect()
    return ordered(tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows)
