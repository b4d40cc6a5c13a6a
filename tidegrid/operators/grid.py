"""Selecting from grids and putting them together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.model import KEY, variables_of
from tidegrid.operators.prefix import with_ordinal
from tidegrid.session import broadcast_if_small, settle


def select_first_level(df: DataFrame) -> DataFrame:
    """The first level of each time step.

    The level is found by an aggregate with one small row per time step; the cells themselves are
    filtered by a join with that, not moved into a window.
    """
    first = df.groupBy("time").agg(F.min("zlev").alias("zlev"))
    return df.join(broadcast_if_small(first), ["time", "zlev"], "left_semi")


def select_variables(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """The key and the named variables; others are never read."""
    keys = [c for c in ("day", *KEY, "lat", "lon") if c in df.columns]
    return df.select(*keys, *variables)


def all_floating(df: DataFrame, variables: Sequence[str] | None = None) -> bool:
    """Is every variable of a floating type? Told by the schema."""
    types = dict(df.dtypes)
    return all(types[v] in ("float", "double") for v in (variables or variables_of(df)))


def squeeze(df: DataFrame, axes: Sequence[str] | None = None) -> DataFrame:
    """Drop axes of length one.

    Named axes must have one label, otherwise this is an error; without names every length-one axis
    goes. The lengths are checked with one aggregate over the key columns.
    """
    candidates = list(axes or [c for c in ("time", "zlev", "lat", "lon") if c in df.columns])
    ends = df.agg(*[F.struct(F.min(a).alias("low"), F.max(a).alias("high")).alias(a) for a in candidates]).first()
    single = [a for a in candidates if ends[a]["low"] == ends[a]["high"]]
    longer = [a for a in candidates if a not in single]
    if axes and longer:
        raise ValueError(f"not of length one: {', '.join(longer)}")
    belonging = {"time": ["day"], "lat": ["lat_idx"], "lon": ["lon_idx"], "zlev": []}
    return df.drop(*single, *[c for a in single for c in belonging.get(a, [])])


def point_by_index(df: DataFrame, points: DataFrame, n_lat: int, n_lon: int, on_error: str = "skip") -> DataFrame:
    """Cells at positions ``points(lat_idx, lon_idx, ...)``; negative positions count from the end.

    A position outside the axis selects nothing, or with ``on_error='raise'`` fails.
    """
    inside = F.col("lat_idx").between(-n_lat, n_lat - 1) & F.col("lon_idx").between(-n_lon, n_lon - 1)
    if on_error == "raise":
        points = points.withColumn("_inside", F.assert_true(inside, F.lit("point outside the grid")))
        points = points.filter(F.col("_inside").isNull()).drop("_inside")
    else:
        points = points.filter(inside)
    positions = points.withColumns(
        {
            "lat_idx": F.pmod("lat_idx", F.lit(n_lat)).cast("int"),
            "lon_idx": F.pmod("lon_idx", F.lit(n_lon)).cast("int"),
        }
    )
    return df.join(broadcast_if_small(positions), ["lat_idx", "lon_idx"])


def point_by_label(df: DataFrame, points: DataFrame) -> DataFrame:
    """Cells at exact coordinate labels ``points(lat, lon, ...)``."""
    return df.join(broadcast_if_small(points), ["lat", "lon"])


def axis(df: DataFrame, label: str) -> DataFrame:
    """The labels of an axis in ascending order with their position ``<label>_idx``."""
    return with_ordinal(settle(df.select(label).distinct()), label, f"{label}_idx")


def _along(df: DataFrame, axis_table: DataFrame, position: str) -> DataFrame:
    """Every row of ``df`` once for each label of an axis.

    A row generates the positions 0 .. n-1 itself and these find their labels by an equi-join, so
    there is no product join and the rows stay in their tasks.
    """
    labels = broadcast_if_small(axis_table)
    n = labels.count()
    positions = F.sequence(F.lit(0).cast("bigint"), F.lit(max(n, 1) - 1).cast("bigint"))
    return df.withColumn(position, F.explode(positions)).join(labels, position)


def build_grid(lat_axis: DataFrame, lon_axis: DataFrame) -> DataFrame:
    """The two-dimensional grid of two axes ``(lat, lat_idx)`` and ``(lon, lon_idx)``."""
    return _along(lat_axis, lon_axis, "lon_idx").select("lat_idx", "lon_idx", "lat", "lon")


def expand_time(grid: DataFrame, time_axis: DataFrame) -> DataFrame:
    """The grid once for each step of an axis ``(time, time_idx)``."""
    return _along(grid, time_axis, "time_idx").select("time", *grid.columns)


def align_variables(variables: dict[str, DataFrame], on: Sequence[str] = KEY, on_mismatch: str = "raise") -> DataFrame:
    """One grid of separate variables, each a DataFrame of the key and a column of its own name.

    All tables go through one shuffle on the cell key. A cell a variable has twice is an error. A cell some variable lacks is an error;
    ``on_mismatch='inner'`` leaves such cells out and ``'outer'`` fills them with NULL.
    """
    names = list(variables)
    stacked = None
    for name, table in variables.items():
        others = [F.lit(None).cast(dict(variables[n].dtypes)[n]).alias(n) if n != name else F.col(n) for n in names]
        part = table.select(*on, F.lit(1 << names.index(name)).alias("_has"), *others)
        stacked = part if stacked is None else stacked.unionByName(part)
    merged = stacked.groupBy(*on).agg(F.bit_or("_has").alias("_has"), F.count("_has").alias("_n"), *[F.max(n).alias(n) for n in names])
    twice = F.concat(F.lit("a variable has twice the cell "), F.to_json(F.struct(*on)))
    once = F.when(F.col("_n") == F.bit_count("_has"), F.col("_has")).otherwise(F.raise_error(twice).cast("int"))
    merged = merged.withColumn("_has", once).drop("_n")
    complete = F.col("_has") == (1 << len(names)) - 1
    if on_mismatch == "raise":
        problem = F.concat(F.lit("variables do not share the cell "), F.to_json(F.struct(*on)))
        merged = merged.filter(F.when(complete, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))
    elif on_mismatch == "inner":
        merged = merged.filter(complete)
    return merged.drop("_has")


def attach_variable(df: DataFrame, derived: DataFrame, on: Sequence[str] = KEY) -> DataFrame:
    """Add a variable computed apart, by the cell key; NULL where it has no value."""
    return df.join(derived, list(on), "left")


def recenter_longitude(df: DataFrame, n_lon: int = 1440) -> DataFrame:
    """Longitudes 0..360 as -180..180 with the positions to match, so that 0 degrees is in the middle."""
    columns = {"lon": F.pmod(F.col("lon") + 180.0, F.lit(360.0)) - 180.0}
    if "lon_idx" in df.columns:
        columns["lon_idx"] = F.pmod(F.col("lon_idx") + n_lon // 2, F.lit(n_lon)).cast("int")
    return df.withColumns(columns)
