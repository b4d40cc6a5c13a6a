"""Observations binned into a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.names import noon_of
from tidegrid.functions.times import format_day
from tidegrid.model import KEY


def grid_observations(
    lineitem: DataFrame, step: str = "day", n_lat: int = 720, n_lon: int = 1440, levels: int = 1, further: bool = False
) -> DataFrame:
    """Line items as observations on a global grid.

    The time step is noon of the shipping day (or of the first of its month), supplier and part number
    choose the position. A diagonal pattern of cells has no sst, err and anom, and ice is missing where
    it is low, as in real fields. Values are 32-bit, so sums of them in 64 bits are exact in any order.
    ``further`` adds two variables of other types, the text ``flag`` and the whole number ``items``.
    """
    shipped = F.to_date("l_shipdate")
    cells = lineitem.select(
        noon_of(shipped if step == "day" else F.trunc(shipped, step)).alias("time"),
        (F.lit(1) + F.col("l_linenumber") % levels).cast("int").alias("zlev"),
        (F.col("l_suppkey") % n_lat).cast("int").alias("lat_idx"),
        (F.col("l_partkey") % n_lon).cast("int").alias("lon_idx"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
    )
    more = [F.max("l_returnflag").alias("flag"), F.count("*").cast("int").alias("items")] if further else []
    binned = cells.groupBy(*KEY).agg(
        F.max("l_quantity").cast("float").alias("sst"),
        F.min("l_extendedprice").cast("float").alias("anom"),
        F.min("l_discount").cast("float").alias("err"),
        F.max("l_tax").cast("float").alias("ice"),
        *more,
    )
    nan = F.lit(float("nan")).cast("float")
    land = (F.col("lat_idx") + F.col("lon_idx")) % 5 == 0
    lat_step, lon_step = 180.0 / n_lat, 360.0 / n_lon
    return binned.select(
        F.to_date("time").alias("day"),
        *KEY,
        (F.lit(-90.0 + lat_step / 2) + F.lit(lat_step) * F.col("lat_idx")).alias("lat"),
        (F.lit(lon_step / 2) + F.lit(lon_step) * F.col("lon_idx")).alias("lon"),
        F.when(land, nan).otherwise(F.col("sst")).alias("sst"),
        F.when(land, nan).otherwise(F.col("anom")).alias("anom"),
        F.when(land, nan).otherwise(F.col("err")).alias("err"),
        F.when(F.col("ice") <= F.lit(0.04).cast("float"), nan).otherwise(F.col("ice")).alias("ice"),
        *(["flag", "items"] if further else []),
    )


def file_name(time: str = "time", prefix: str = "grid") -> Column:
    """``<prefix>.YYYYMMDD.nc`` of a time step."""
    return F.concat(F.lit(f"{prefix}."), format_day(time), F.lit(".nc"))
