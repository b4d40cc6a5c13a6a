"""The long-form grid: one row per cell, axes as key columns, variables as value columns.

A cell is identified by ``KEY``. ``day`` is the partition column of a store and always
``to_date(time)``. Instants are ``timestamp_ntz`` holding UTC, so no result depends on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.missing import null_if_missing

KEY = ["time", "zlev", "lat_idx", "lon_idx"]
VARIABLES = ["sst", "anom", "err", "ice"]
HASHED = ["lat", "lon", "sst", "err", "ice", "anom"]  # order in which a cell is fingerprinted
MAX_VERIFIERS = 10
SENTINEL = -999.0

GRID = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("zlev", T.IntegerType()),
        T.StructField("lat_idx", T.IntegerType()),
        T.StructField("lon_idx", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("sst", T.FloatType()),
        T.StructField("anom", T.FloatType()),
        T.StructField("err", T.FloatType()),
        T.StructField("ice", T.FloatType()),
        T.StructField("spatial_hash", T.StringType()),
        T.StructField("verifier_pubkeys", T.ArrayType(T.StringType())),
        T.StructField("source_uri", T.StringType()),
    ]
)


# Columns that say where a cell is or where it came from; every other column is a variable of the data.
BOOKKEEPING = ["day", *KEY, "lat", "lon", "spatial_hash", "verifier_pubkeys", "source_uri", "source_time"]


def variables_of(df: DataFrame) -> list[str]:
    """The variables of a grid, whatever they are called, in the order of its columns."""
    return [c for c in df.columns if c not in BOOKKEEPING]


def conform(df: DataFrame) -> DataFrame:
    """Bring any grid to ``GRID``: derive ``day``, add absent columns as NULL, store missing as NULL.

    Columns that ``GRID`` does not have are further variables or the file's own time; they follow, with their types.
    """
    if "day" not in df.columns:
        df = df.withColumn("day", F.to_date("time"))
    columns = []
    for field in GRID.fields:
        if field.name not in df.columns:
            column = F.lit(None)
        elif field.name in VARIABLES:
            column = null_if_missing(field.name)
        else:
            column = F.col(field.name)
        columns.append(column.cast(field.dataType).alias(field.name))
    for name, kind in df.dtypes:
        if name not in GRID.names:
            columns.append(null_if_missing(name).alias(name) if kind in ("float", "double") else F.col(name))
    return df.select(*columns)
