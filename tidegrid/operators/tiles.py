"""Dense tiles of one variable and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.missing import null_if_missing
from tidegrid.model import variables_of

# The layout used when the configuration names none.
DEFAULT_CHUNKS = {"time": 1, "zlev": 1, "lat": 72, "lon": 144}
AXES = ["time", "zlev", "lat", "lon"]


def config_table(spark: SparkSession, config: Mapping | None, variables: Sequence[str], axes: Sequence[str] = AXES) -> DataFrame:
    """A configuration as rows ``variable, chunks``: the chunk sizes of each variable for the axes it has.

    Without configured variables all have the default sizes. NULL: the variable is left whole.
    """
    wanted = (config or {}).get("variables")
    rows = [(v, DEFAULT_CHUNKS if wanted is None else wanted.get(v, {}).get("chunks", {})) for v in variables]
    table = spark.createDataFrame(rows, "variable string, chunks map<string,int>")
    kept = F.map_filter("chunks", lambda axis, size: axis.isin(list(axes)))
    return table.select("variable", F.when(F.size(kept) > 0, kept).alias("chunks"))


def chunk_sizes(config: Mapping | None, variable: str, axes: Sequence[str] = AXES) -> dict[str, int] | None:
    """Chunk sizes of one variable for the axes it has; None when the configuration leaves it whole."""
    if "variables" not in (config or {}):
        wanted = DEFAULT_CHUNKS
    else:
        wanted = config["variables"].get(variable, {}).get("chunks", {})
    return {axis: wanted[axis] for axis in axes if axis in wanted} or None


def tile_ids(df: DataFrame, config: Mapping | None = None, variable: str = "sst") -> DataFrame:
    """Add ``tile_i, tile_j``: the tile of each cell along latitude and longitude."""
    sizes = chunk_sizes(config, variable, [a for a in AXES if a in df.columns]) or {}

    def tile(position: str, size: int | None) -> Column:
        return F.floor(F.col(position) / size).cast("int") if size else F.lit(0)

    return df.withColumns({"tile_i": tile("lat_idx", sizes.get("lat")), "tile_j": tile("lon_idx", sizes.get("lon"))})


def _dense(entries: Column, slots: Column, kind: str) -> Column:
    """Values of ``array<struct<pos, value>>`` sorted by position, NULL in the gaps.

    A complete tile is taken as it is. Otherwise each entry brings the gap before it along, which stays
    linear in the tile; two entries at one position fail.
    """
    complete = entries["pos"] == F.sequence(F.lit(0), slots - 1)
    null = F.lit(None).cast(kind)

    def with_gap(entry: Column, i: Column) -> Column:
        previous = F.when(i == 0, F.lit(-1)).otherwise(F.get(entries, i - 1)["pos"])
        twice = F.raise_error(F.lit("two cells at one position of a tile")).cast("int")
        gap = F.when(entry["pos"] > previous, entry["pos"] - previous - 1).otherwise(twice)
        return F.concat(F.array_repeat(null, gap), F.array(entry["value"]))

    tail = F.array_repeat(null, slots - 1 - F.get(entries, F.size(entries) - 1)["pos"])
    padded = F.concat(F.flatten(F.transform(entries, with_gap)), tail)
    return F.when(complete, entries["value"]).otherwise(padded)


def pack_tiles(
    df: DataFrame, lat_size: int = 72, lon_size: int = 144, variable: str = "sst"
) -> DataFrame:
    """One row per tile with the dense ``values``, row by row, NULL where there is no cell.

    A tile holds at most ``lat_size * lon_size`` cells. Cells are gathered inside each map task first,
    so a scan of whole days already sends whole tiles.
    """
    slots = lat_size * lon_size
    position = (F.col("lat_idx") % lat_size) * lon_size + F.col("lon_idx") % lon_size
    cells = df.select(
        "time",
        "zlev",
        F.floor(F.col("lat_idx") / lat_size).cast("int").alias("tile_i"),
        F.floor(F.col("lon_idx") / lon_size).cast("int").alias("tile_j"),
        F.struct(position.cast("int").alias("pos"), F.col(variable).alias("value")).alias("_entry"),
    )
    gathered = cells.groupBy("time", "zlev", "tile_i", "tile_j").agg(
        F.sort_array(F.collect_list("_entry")).alias("_entries")
    )
    return gathered.withColumn("values", _dense(F.col("_entries"), F.lit(slots), dict(df.dtypes)[variable])).drop("_entries")


def pack_variables(df: DataFrame, config: Mapping | None = None, variables: Sequence[str] | None = None) -> DataFrame:
    """The dense tiles of all numeric variables: ``variable, day, time, zlev, tile_i, tile_j, lat_size, lon_size, values``.

    Sizes are those of the configuration; along an axis for which it has none, a variable is one tile. All variables go through
    one shuffle, gathered into tiles inside each map task first. Missing values are NULL.
    """
    types = dict(df.dtypes)
    numeric = [v for v in (variables or variables_of(df)) if types[v] in ("tinyint", "smallint", "int", "bigint", "float", "double")]
    kind = "float" if all(types[v] == "float" for v in numeric) else "double"
    ends = df.agg(F.max("lat_idx").alias("lat"), F.max("lon_idx").alias("lon")).first()
    whole = {"lat": (ends.lat or 0) + 1, "lon": (ends.lon or 0) + 1}
    # A tile never reaches further than the grid needs, counted in whole tiles.
    entries = []
    for v in numeric:
        sizes = {**whole, **(chunk_sizes(config, v) or {})}
        value = null_if_missing(v) if types[v] in ("float", "double") else F.col(v)
        entries.append(F.struct(F.lit(v).alias("variable"), F.lit(sizes["lat"]).alias("lat_size"), F.lit(sizes["lon"]).alias("lon_size"), value.cast(kind).alias("value")))
    cells = df.select("time", "zlev", "lat_idx", "lon_idx", F.inline(F.array(*entries)))
    position = (F.col("lat_idx") % F.col("lat_size")) * F.col("lon_size") + F.col("lon_idx") % F.col("lon_size")
    keys = ["variable", "time", "zlev", "tile_i", "tile_j", "lat_size", "lon_size"]
    placed = cells.select(
        "variable",
        "time",
        "zlev",
        F.floor(F.col("lat_idx") / F.col("lat_size")).cast("int").alias("tile_i"),
        F.floor(F.col("lon_idx") / F.col("lon_size")).cast("int").alias("tile_j"),
        "lat_size",
        "lon_size",
        F.struct(position.cast("int").alias("pos"), "value").alias("_entry"),
    )
    gathered = placed.groupBy(*keys).agg(F.sort_array(F.collect_list("_entry")).alias("_entries"))
    dense = _dense(F.col("_entries"), F.col("lat_size") * F.col("lon_size"), kind)
    return gathered.select(F.to_date("time").alias("day"), *keys, dense.alias("values"))


def unpack_tiles(
    tiles: DataFrame, lat_size: int = 72, lon_size: int = 144, variable: str = "sst", keep_empty: bool = False
) -> DataFrame:
    """The cells of tiles, by position; slots without a value are left out unless ``keep_empty``."""
    cells = tiles.select("time", "zlev", "tile_i", "tile_j", F.posexplode("values").alias("_pos", variable))
    if not keep_empty:
        cells = cells.filter(F.col(variable).isNotNull())
    return cells.select(
        "time",
        "zlev",
        (F.col("tile_i") * lat_size + F.floor(F.col("_pos") / lon_size)).cast("int").alias("lat_idx"),
        (F.col("tile_j") * lon_size + F.col("_pos") % lon_size).cast("int").alias("lon_idx"),
        variable,
    )
