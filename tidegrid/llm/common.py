"""Pieces several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import discard, scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    What reads it afterwards does not depend on the executors that computed it. ``options`` are the writer's.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(df: DataFrame, name: str, **options: str) -> DataFrame:
    """:func:`stored`, with the files of its shuffles deleted at the end, not when the driver next collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name, **options)
    finally:
        conf.set(CLEANUP, before)


def free(table: DataFrame) -> None:
    """Delete a :func:`stored` table that nothing is computed from any more."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        discard(table.sparkSession, folder)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is."""
    return F.translate(text, UPPER, LOWER)
