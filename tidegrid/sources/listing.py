"""Discovery by polling: object listings and the stored high-water mark.

A listing has ``key`` and ``last_modified`` (UTC ``timestamp_ntz``). A mark is a one-row DataFrame
with the column ``mark``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.times import EPOCH, instant_to_utc
from tidegrid.session import settle

SUFFIX = ".nc"
ATTEMPTS = 3  # how often a file is tried that fails
WORK = "key string, last_modified timestamp_ntz, attempt int, state string, modified_day date"


def list_objects(spark: SparkSession, path: str, glob: str = "*.nc") -> DataFrame:
    """Listing of the files below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        F.col("path").alias("key"),
        instant_to_utc("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
    )


def as_instant(value: datetime | str | Column | DataFrame) -> Column:
    """A mark as a column: a literal, a column, or the single value of a one-row DataFrame."""
    if isinstance(value, DataFrame):
        return value.select("mark").scalar()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def discover_since(listing: DataFrame, mark, suffix: str | None = None) -> DataFrame:
    """Objects modified on or after the *date* of the mark.

    Files of the mark's own day come back on every poll, so delivery is at least once. The bound is
    midnight of that day compared with the bare column, which reaches the scan as a pushed filter.
    """
    start = as_instant(mark).cast("date").cast("timestamp_ntz")
    kept = listing.filter(F.col("last_modified") >= start)
    return kept.filter(F.col("key").endswith(suffix)) if suffix else kept


def read_mark(state: DataFrame, start: datetime | str | None = None) -> DataFrame:
    """The stored mark, else the configured start, else 1970-01-01."""
    fallback = F.lit(str(start or EPOCH)).cast("timestamp_ntz")
    return state.agg(F.coalesce(F.max("mark"), fallback).alias("mark"))


def stored_marks(spark: SparkSession, path: str) -> DataFrame:
    """The append-only table of marks; empty when nothing was written yet."""
    try:
        return spark.read.schema("mark timestamp_ntz").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "mark timestamp_ntz")


def write_mark(mark: DataFrame, path: str, old: DataFrame | None = None) -> bool:
    """Append a mark unless it is the old one; returns whether it was written.

    Marks never go down, so the largest one is the current one.
    """
    new = mark.first().mark
    if old is not None and old.first().mark == new:
        return False
    written = mark.sparkSession.createDataFrame([(new,)], "mark timestamp_ntz")
    written.coalesce(1).write.mode("append").parquet(path)
    return True


def max_modified(listing: DataFrame) -> DataFrame:
    return listing.agg(F.max("last_modified").alias("max_modified"))


def advance_mark(kept: DataFrame, mark) -> DataFrame:
    """New mark after handling ``kept``: the newest modification, never below the old mark.

    With a boolean column ``ok`` the mark stops at the earliest failed file, whose day is then
    listed again. No file kept leaves the mark as it was.
    """
    old = as_instant(mark)
    newest = F.max("last_modified")
    if "ok" in kept.columns:
        first_failed = F.min(F.when(~F.col("ok"), F.col("last_modified")))
        newest = F.least(newest, first_failed)
    return kept.agg(newest.alias("newest")).select(F.greatest(F.col("newest"), old).alias("mark"))


def discovery_counts(listing: DataFrame, mark, suffix: str | None = None, page_size: int = 1000) -> DataFrame:
    """Objects listed, pages they fill at ``page_size`` objects each, and objects kept."""
    start = as_instant(mark).cast("date").cast("timestamp_ntz")
    keep = F.col("last_modified") >= start
    if suffix:
        keep = keep & F.col("key").endswith(suffix)
    return listing.agg(
        F.count("*").alias("objects"),
        F.ceil(F.count("*") / F.lit(page_size)).cast("bigint").alias("pages"),
        F.count_if(keep).alias("new_files"),
    )


def poll_state(
    spark: SparkSession,
    listing: DataFrame,
    state_path: str,
    start: datetime | str | None = None,
    handle=None,
    suffix: str | None = SUFFIX,
) -> DataFrame:
    """One poll: read the mark, list what is new, hand it over, store the new mark, return it.

    ``handle(files)`` does the work and may return the files with an ``ok`` column; the mark then
    stops at the earliest failure.
    """
    mark = settle(read_mark(stored_marks(spark, state_path), start))
    files = discover_since(listing, mark, suffix)
    handled = handle(files) if handle else None
    new_mark = advance_mark(files if handled is None else handled, mark)
    write_mark(new_mark, state_path, mark)
    return read_mark(stored_marks(spark, state_path), start)


def work_list(spark: SparkSession, state_path: str) -> DataFrame:
    """What became of each attempt at each version of a file; empty before the first poll.

    Partitioned by state and by the day of modification: failures are few and found without reading what is done, and of
    what is done only the days a poll lists again are read.
    """
    try:
        return spark.read.schema(WORK).parquet(f"{state_path.rstrip('/')}/_work")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WORK)


def due_work(listing: DataFrame, work: DataFrame, mark, suffix: str | None = SUFFIX, attempts: int = ATTEMPTS) -> DataFrame:
    """The listed files to handle now, with the number of the ``attempt``.

    A version of a file is its key and the time it was modified. Due are versions on or after the date of the mark that are not in
    the work list, and whatever failed, however old: a version that is still there until it was tried ``attempts`` times, and
    the version that has taken its place since, as a first attempt.
    """
    version = ["key", "last_modified"]
    failed = settle(work.filter("state = 'failed'").groupBy(*version).agg(F.max("attempt").alias("attempt")))
    day = F.to_date("last_modified")
    since = F.least(as_instant(mark).cast("date"), failed.agg(F.min(day).alias("day")).scalar())
    done = work.filter(F.col("state") == "done").filter(F.col("modified_day") >= since).select(*version)
    fresh = discover_since(listing, mark, suffix).join(failed, version, "left_anti").withColumn("attempt", F.lit(1))
    tried = failed.withColumnsRenamed({"last_modified": "_tried", "attempt": "_attempts"})
    same = F.col("last_modified") == F.col("_tried")
    again = listing.join(tried, "key").groupBy(*listing.columns).agg(F.max(F.when(same, F.col("_attempts"))).alias("attempt"))
    again = again.withColumn("attempt", F.coalesce("attempt", F.lit(0)) + 1).filter(F.col("attempt") <= attempts)
    both = fresh.unionByName(again).dropDuplicates(version)
    return both.join(done, version, "left_anti")


def record_work(handled: DataFrame, state_path: str) -> None:
    """Append what became of ``handled(key, last_modified, attempt, ok)`` to the work list."""
    state = F.when(F.col("ok"), "done").otherwise("failed").alias("state")
    rows = handled.select("key", "last_modified", "attempt", state, F.to_date("last_modified").alias("modified_day"))
    rows.write.partitionBy("state", "modified_day").mode("append").parquet(f"{state_path.rstrip('/')}/_work")


def poll_work(
    spark: SparkSession,
    listing: DataFrame,
    state_path: str,
    handle,
    start: datetime | str | None = None,
    suffix: str | None = SUFFIX,
    attempts: int = ATTEMPTS,
) -> DataFrame:
    """One poll with a work list: hand over what is due, keep what became of it, move the mark; returns the mark.

    ``handle(files)`` does the work and returns ``key, ok``; a file it does not mention counts as failed. The
    mark moves to the newest version that was handled whether or not all went well: what failed is remembered, not the time. A
    poll that is lost before its results are kept is repeated by the next one.
    """
    mark = settle(read_mark(stored_marks(spark, state_path), start))
    due = settle(due_work(listing, work_list(spark, state_path), mark, suffix, attempts))
    outcome = handle(due).select("key", "ok")
    handled = due.join(outcome, "key", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    record_work(settle(handled.select("key", "last_modified", "attempt", "ok")), state_path)
    new_mark = advance_mark(due.select("key", "last_modified"), mark)
    write_mark(new_mark, state_path, mark)
    return read_mark(stored_marks(spark, state_path), start)
