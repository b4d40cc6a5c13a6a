"""Profile of a dataset and the storage layout it suggests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.model import variables_of

# The size a chunk should have, and below the settings of the codec and the fields of the layout document.
TARGET_CHUNK_BYTES = 100 * 1024 * 1024
ITEM_SIZES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8, "date": 8, "timestamp_ntz": 8}
AXES = ["time", "zlev", "lat", "lon"]


def variable_types(df: DataFrame, variables: Sequence[str] | None = None) -> DataFrame:
    """``variable_no, variable, dtype`` of every variable of a grid, from its schema; no data is read."""
    types = dict(df.dtypes)
    present = [(i, v, types[v]) for i, v in enumerate(v for v in (variables or variables_of(df)) if v in types)]
    return df.sparkSession.createDataFrame(present, "variable_no int, variable string, dtype string")


def profile_dataset(df: DataFrame, variables: Sequence[str] | None = None, title: str | None = None) -> DataFrame:
    """One row per variable and axis: position and length of the axis, type and item size, title.

    Without a list all variables count, whatever their type. The axis lengths come from one pass over the key columns.
    A type without a fixed size has no item size.
    """
    types = dict(df.dtypes)
    axes = [a for a in AXES if a in types]
    present = [v for v in (variables or variables_of(df)) if v in types]
    lengths = df.agg(*[F.countDistinct(a).alias(a) for a in axes])
    entries = [
        F.struct(
            F.lit(v).alias("variable"),
            F.lit(i).alias("variable_no"),
            F.lit(a).alias("axis"),
            F.lit(j).alias("axis_no"),
            F.col(a).alias("axis_size"),
            F.lit(types[v]).alias("dtype"),
            F.lit(ITEM_SIZES.get(types[v])).alias("itemsize"),
            F.lit(title).cast("string").alias("title"),
        )
        for i, v in enumerate(present)
        for j, a in enumerate(axes)
    ]
    return lengths.select(F.inline(F.array(*entries)))


def suggest_chunks(profile: DataFrame) -> DataFrame:
    """Add ``chunk``: 1 along time, elsewhere the side of a square of 100 MiB, at most the axis.

    Where the item size is not known, values are taken for references of eight bytes.
    """
    side = F.floor(F.sqrt(F.lit(TARGET_CHUNK_BYTES) / F.coalesce("itemsize", F.lit(8))))
    return profile.withColumn(
        "chunk", F.when(F.col("axis") == "time", F.lit(1)).otherwise(F.least(side, "axis_size")).cast("bigint")
    )


def _floating():
    return F.bool_and(F.col("dtype").isin("float", "double"))


def floating_profile(profile: DataFrame) -> DataFrame:
    """Is every variable of a profile, or of :func:`variable_types`, of a floating type?"""
    return profile.agg(_floating().alias("all_floating"))


def suggest_codec(profile: DataFrame) -> DataFrame:
    """Codec for the whole dataset: lz4 level 5 with bit shuffle when all variables are floating.

    A profile or :func:`variable_types` tells the types. ``parquet_codec`` is the write option that comes closest; NULL codec fields mean no compression.
    """
    return floating_profile(profile).select(
        F.inline(F.array(_codec("all_floating"))),
        F.when(F.col("all_floating"), "lz4_raw").otherwise("none").alias("parquet_codec"),
    )


def _codec(floating: str):
    floating = F.col(floating)
    return F.struct(
        F.when(floating, "blosc").alias("id"),
        F.when(floating, "lz4").alias("cname"),
        F.when(floating, 5).alias("clevel"),
        F.when(floating, 2).alias("shuffle"),
    )


def suggest_layout(profile: DataFrame, dataset: str = "custom") -> DataFrame:
    """The whole recommendation as one JSON document in column ``layout``.

    A profile has one row per variable and axis, so it is a handful of rows for any amount of data.
    """
    axes = F.array_sort(F.collect_list(F.struct("axis_no", "axis", "chunk")))
    by_variable = (
        suggest_chunks(profile)
        .groupBy("variable_no", "variable", "dtype")
        .agg(axes.alias("axes"), F.max("title").alias("title"))
    )
    in_order = F.array_sort(F.collect_list(F.struct("variable_no", "variable", "axes")))

    def chunks(variable):
        sizes = F.map_from_entries(F.transform(variable["axes"], lambda x: F.struct(x["axis"], x["chunk"])))
        return F.struct(variable["variable"], F.struct(sizes.alias("chunks")))

    single = by_variable.agg(
        F.map_from_entries(F.transform(in_order, chunks)).alias("variables"),
        F.coalesce(F.max("title"), F.lit("Custom dataset")).alias("description"),
        _floating().alias("_floating"),
    )
    document = F.struct(
        F.lit(dataset).alias("dataset"),
        "description",
        F.when(F.col("_floating"), _codec("_floating")).alias("compressor"),
        F.struct("variables").alias("conversion"),
    )
    return single.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("layout"))


def write_profile(layout: DataFrame, path: str) -> None:
    """Save the recommendation as a JSON text file; it is a single document."""
    layout.select(F.col("layout").alias("value")).coalesce(1).write.mode("overwrite").text(path)
