"""The whole way from daily files to a verified store, and from a store to its report."""

from __future__ import annotations

from collections.abc import Mapping
from json import loads

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.fingerprint import add_fingerprints
from tidegrid.functions.text import format_stat
from tidegrid.functions.times import format_day
from tidegrid.operators.stats import daily_stats, running_components, running_mean
from tidegrid.operators.tiles import pack_variables
from tidegrid.operators.verify import add_verifiers
from tidegrid.session import settle
from tidegrid.sources.events import dedup_events, filter_object_events, lookup_config, parse_object_events
from tidegrid.sources.files import (
    Decoder,
    Opener,
    binary_files,
    file_facts,
    in_bins,
    ingest_with_status,
    read_whole,
    with_file_time,
)
from tidegrid.sources.listing import ATTEMPTS, list_objects, poll_work, work_list
from tidegrid.sources.store import Layout, refresh_summary, write_overwrite, write_store


def convert_files(
    files: DataFrame,
    store_path: str,
    decode: Decoder,
    suffix: str = "",
    name: Column | None = None,
    on_error: str = "continue",
    algorithm: str = "blake3",
    extra: T.StructType | str | int = 1,
    opener: Opener = read_whole,
    new_store: bool = False,
    summary_path: str | None = None,
    tiles_path: str | None = None,
    config: Mapping | None = None,
) -> DataFrame:
    """Decode files, fingerprint every cell, add empty verifier lists, and upsert the days.

    ``files`` has ``path, modificationTime`` and either ``content`` or nothing more, then each task opens the files it
    decodes. Returns the status of each file. Each day sits in the task that decoded it, so nothing is shuffled on the way to
    the store. All variables are kept, and a store grows by those it did not have. ``new_store`` puts a new store in the
    place of any old one; the table at ``summary_path`` is brought up to date for the days that were written. With ``tiles_path``
    the variables are kept as dense tiles as well, of the sizes in ``config``.
    """
    ingested = ingest_with_status(with_file_time(files, suffix, name), decode, on_error, extra, opener)
    try:
        cells, layout = add_verifiers(add_fingerprints(ingested.grid, algorithm)), Layout(gather=False)
        if new_store:
            write_overwrite(cells, store_path, layout)
        else:
            write_store(cells, store_path, layout, grow=True)
        if tiles_path is not None:
            tiles = pack_variables(ingested.grid, config)
            (write_overwrite if new_store else write_store)(tiles, tiles_path)
        status = settle(ingested.status)
        if summary_path is not None:
            days = status.filter("status = 'ok'").select(F.to_date("file_time").alias("day")).distinct()
            refresh_summary(status.sparkSession, store_path, summary_path, None if new_store else days)
        return status
    finally:
        ingested.release()


def convert_paths(spark: SparkSession, paths, store_path: str, decode: Decoder, glob: str = "*.nc", **options) -> DataFrame:
    """:func:`convert_files` for files, folders or patterns."""
    return convert_files(binary_files(spark, paths, glob), store_path, decode, **options)


def convert_listed(files: DataFrame, store_path: str, status_path: str, decode: Decoder, **options) -> DataFrame:
    """Convert the files named in ``path`` and keep their statuses in a table; the statuses.

    Names are dealt out by the bytes behind them and opened by the tasks that decode them; no name passes through the
    driver. The statuses of a set of file versions are a partition of the table of their own, so the same set again, e.g. a
    batch that is run once more, replaces them.
    """
    known = {"path", "modificationTime", "length"} <= set(files.columns)
    listed = settle(files.select("path", "modificationTime", "length").distinct() if known else file_facts(files))
    status = convert_files(in_bins(listed), store_path, decode, **options)
    versions = F.sum(F.xxhash64("path", "modificationTime").cast("decimal(38,0)")).cast("string")
    batch = listed.agg(F.concat_ws("_", F.count("*"), versions).alias("batch")).first().batch
    kept = status.withColumn("batch", F.lit(batch))
    kept.write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(status_path)
    return status


def event_files(documents: DataFrame, json: str = "json", suffix: str = ".nc", on_error: str = "raise") -> DataFrame:
    """Files named by object events, as ``path, event_time``; re-deliveries dropped. Batch or stream."""
    created = filter_object_events(parse_object_events(documents, json, on_error), suffix)
    return dedup_events(created).select(F.col("uri").alias("path"), "event_time")


def convert_events(
    documents: DataFrame, configs: DataFrame, status_path: str, decode: Decoder, json: str = "json", on_error: str = "raise", **options
) -> None:
    """Convert the files named by object events, each bucket as its configuration says.

    ``configs`` has ``bucket, store_path``, and optionally ``suffix`` (what is struck out of file names), ``tiles_path`` and
    ``conversion`` (a JSON document with chunk sizes by variable). It is a small table, and each of its rows is one
    conversion. Events of buckets without a configuration are left out.
    """
    created = filter_object_events(parse_object_events(documents, json, on_error))
    events = settle(dedup_events(lookup_config(created, configs.select("bucket", "store_path"))).filter("store_path is not null"))
    for row in configs.collect():
        given = row.asDict()
        own = {k: given[k] for k in ("suffix", "tiles_path") if given.get(k)}
        if given.get("conversion"):
            own["config"] = loads(given["conversion"])
        files = events.filter(F.col("bucket").eqNullSafe(F.lit(given["bucket"]))).select(F.col("uri").alias("path"))
        convert_listed(files, given["store_path"], status_path, decode, **own, **options)


def poll_convert(
    spark: SparkSession,
    path: str,
    store_path: str,
    state_path: str,
    decode: Decoder,
    start: str | None = None,
    glob: str = "*.nc",
    attempts: int = ATTEMPTS,
    **options,
) -> DataFrame:
    """One poll: convert the files modified since the stored mark that are not done yet, and move the mark.

    The mark moves with every poll. A file that failed is in the work list beside the marks and tried again by
    later polls, ``attempts`` times in all; one that is done is not decoded again. Returns the statuses of the files of
    this poll.
    """
    listing = list_objects(spark, path, glob)
    suffix, name = options.get("suffix", ""), options.get("name")
    statuses = []

    def versions(files: DataFrame) -> DataFrame:
        modified = F.to_timestamp_ltz(F.concat("last_modified", F.lit("+00:00"))).alias("modificationTime")
        return with_file_time(files.select(F.col("key").alias("path"), modified, *[c for c in ("size",) if c in files.columns]), suffix, name)

    def handle(files: DataFrame) -> DataFrame:
        due = settle(versions(files).withColumnRenamed("size", "length"))
        # A file that is tried again must not replace a later file of its time step that is done.
        done = versions(work_list(spark, state_path).filter("state = 'done'")).groupBy("file_time").agg(F.max(F.struct("modificationTime", "path")).alias("_done"))
        late = settle(due.join(done, "file_time").filter(F.struct("modificationTime", "path") < F.col("_done")).select(*due.columns))
        status = convert_files(in_bins(due.join(late, "path", "left_anti").drop("file_time")), store_path, decode, **options)
        left_out = late.select("path", "modificationTime", "file_time", F.lit("superseded").alias("status"))
        statuses.append(status.unionByName(left_out, allowMissingColumns=True))
        return statuses[0].select(F.col("path").alias("key"), (F.col("status") != "failed").alias("ok"))

    poll_work(spark, listing, state_path, handle, start, suffix=None, attempts=attempts)
    return statuses[0]


def analyse(store: DataFrame, variable: str = "sst", sticky_nan: bool = False) -> DataFrame:
    """Daily statistics with day numbers and running means; the store is scanned once."""
    return running_mean(settle(daily_stats(store, variable)), sticky_nan=sticky_nan)


def report(store: DataFrame, variable: str = "sst", unit: str = "°C") -> DataFrame:
    """What a person reads: per day minimum, maximum, average, running average and its components as text."""
    daily = settle(daily_stats(store, variable))
    numbered = running_mean(daily).select(
        "time",
        "day_number",
        format_day("time").alias("date"),
        *[format_stat(f"daily_{c}", 0, unit).alias(c) for c in ("min", "max", "mean")],
        format_stat("running_mean", 0, unit).alias("running_mean"),
    )
    return numbered.join(running_components(daily, unit=unit), ["time", "day_number"])
