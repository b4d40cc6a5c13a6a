"""The jobs as streams. Every sink is idempotent: a batch that is run again leaves the same store."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions.times import instant_to_utc
from tidegrid.operators.stats import daily_stats
from tidegrid.plans.convert import convert_listed
from tidegrid.session import broadcast_if_small
from tidegrid.sources.arrivals import stream_arrivals
from tidegrid.sources.events import dedup_events
from tidegrid.sources.files import BINARY_FILE, Decoder
from tidegrid.sources.listing import as_instant
from tidegrid.sources.store import Layout, read_store, touched, write_merge, write_store

POLL_INTERVAL = "15 minutes"


def stream_files(
    spark: SparkSession, path: str, glob: str = "*.nc", max_files: int | None = None, max_age: str = "7d", folders: Sequence[str] = ()
) -> DataFrame:
    """New files below ``path``, each exactly once, as ``path, modificationTime, length``.

    Contents are not part of the stream. A file is taken however late it comes (``stream_arrivals``); what was taken is
    remembered in the state store, and the driver's memory does not grow with it.

    With ``max_files`` the batches are bounded instead. Spark's file source, which can do that, keeps names in the driver for
    ``max_age`` and leaves out a file older than the newest one by more than that.
    """
    if max_files is None:
        return stream_arrivals(spark, path, glob, folders)
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", max_age)
        .load(path)
    )
    return files.select("path", "modificationTime", "length")


def _start(
    stream: DataFrame,
    handle: Callable[[DataFrame], None],
    checkpoint: str,
    available_now: bool,
    interval: str,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(lambda batch, _: handle(batch)).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def _once(handle: Callable[[DataFrame], None]) -> Callable[[DataFrame], None]:
    """Keep a batch on executor disks while it is read several times."""

    def run(batch: DataFrame) -> None:
        kept = batch.persist(StorageLevel.DISK_ONLY)
        try:
            if not kept.isEmpty():
                handle(kept)
        finally:
            kept.unpersist()

    return run


def stream_convert(
    files: DataFrame,
    store_path: str,
    status_path: str,
    decode: Decoder,
    checkpoint: str,
    suffix: str = "",
    name: Column | None = None,
    algorithm: str = "blake3",
    available_now: bool = False,
    interval: str = POLL_INTERVAL,
) -> StreamingQuery:
    """Convert each new file of a stream with a ``path`` into the store and keep its status; a batch that is run again
    replaces its statuses.

    The stream is :func:`stream_files`, or the addresses in object events (``event_files``).
    """

    def handle(batch: DataFrame) -> None:
        convert_listed(batch, store_path, status_path, decode, suffix=suffix, name=name, algorithm=algorithm)

    return _start(files, _once(handle), checkpoint, available_now, interval)


def _put(batch: DataFrame, store_path: str, whole_steps: bool, order_by: Sequence[str], grow: bool) -> None:
    if whole_steps:
        write_store(batch, store_path, grow=grow)
    else:
        write_merge(batch, store_path, order_by, grow=grow)


def stream_upsert(
    stream: DataFrame,
    store_path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = POLL_INTERVAL,
    whole_steps: bool = False,
    order_by: Sequence[str] = (),
    grow: bool = True,
) -> StreamingQuery:
    """Put the cells of each batch into the store, creating it if need be.

    A time step may come in parts over several batches: cells are merged one by one (``write_merge``), the later one of a
    cell counting, or the greater one in ``order_by``. With ``whole_steps`` a batch holds its time steps whole, and
    they replace the stored ones with every cell.
    """
    return _start(stream, _once(lambda batch: _put(batch, store_path, whole_steps, order_by, grow)), checkpoint, available_now, interval)


def stream_daily_stats(
    stream: DataFrame,
    store_path: str,
    stats_path: str,
    checkpoint: str,
    variable: str = "sst",
    available_now: bool = False,
    interval: str = POLL_INTERVAL,
    whole_steps: bool = False,
    order_by: Sequence[str] = (),
) -> StreamingQuery:
    """As :func:`stream_upsert`, keeping a table of daily statistics current.

    Only the time steps of the batch are recomputed, from the store, so parts that came before count. The table is
    partitioned by month; running means are computed when it is read.
    """

    def handle(batch: DataFrame) -> None:
        _put(batch, store_path, whole_steps, order_by, True)
        steps = broadcast_if_small(batch.select("day", "time").distinct())
        stored = touched(read_store(batch.sparkSession, store_path), steps).join(steps, ["day", "time"], "left_semi")
        stats = daily_stats(stored, variable).withColumn("month", F.trunc("time", "month"))
        write_store(stats, stats_path, Layout(partition="month"))

    return _start(stream, _once(handle), checkpoint, available_now, interval)


def stream_dedup(
    events: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", available_now: bool = False
) -> StreamingQuery:
    """Object events without re-deliveries, appended to a table."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    writer = dedup_events(events, delay).writeStream.format("parquet").outputMode("append")
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def late_files(files: DataFrame, newest_stored, mark) -> DataFrame:
    """Files with ``late``: older than the newest stored step, and ``polled``: visible to the next poll.

    Late files are accepted like any other; their day is simply an older partition. A file modified
    before the day of the mark is not listed by a poll any more and needs an event.
    """
    start = as_instant(mark).cast("date").cast("timestamp_ntz")
    return files.withColumns(
        {
            "late": F.col("file_time") < as_instant(newest_stored),
            "polled": F.col("last_modified") >= start,
        }
    )


def listing_of(files: DataFrame) -> DataFrame:
    """A file stream or table as a listing ``key, last_modified``."""
    return files.select(F.col("path").alias("key"), instant_to_utc("modificationTime").alias("last_modified"))
