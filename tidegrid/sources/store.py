"""The day-partitioned store.

Slices are replaced partition by partition, so the cost of a write depends on the days it touches
and not on the size of the store. Writes to one store come from one writer at a time.

Two records lie beside the days: the schema once it has grown, and a replacement that is under way. A replacement that
needs rows of the old partitions is staged whole and recorded before anything is removed; if the writer is lost then, the
next write publishes what was staged before it does anything else.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.missing import null_if_missing
from tidegrid.model import KEY
from tidegrid.session import broadcast_if_small, discard, settle
from tidegrid.sources import records


class StoreNotFound(FileNotFoundError):
    """There is no store at the path."""


class SliceExists(ValueError):
    """A time step to be appended is already in the store."""


def _open(spark: SparkSession, path: str) -> DataFrame | None:
    _, schema = records.latest(spark, path, "schema")
    reader = spark.read.schema(T.StructType.fromJson(schema)) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The grid in a store; :class:`StoreNotFound` when there is none."""
    store = _open(spark, path)
    if store is None:
        raise StoreNotFound(f"no store at {path}")
    return store


@dataclass(frozen=True)
class Layout:
    """How rows are laid out in a store.

    ``gather`` moves the rows of a partition together before writing: rebalancing sizes tasks by bytes,
    so small days share a task and a day larger than the advisory size is split over several. Turn it
    off when each day already sits in one task, as after decoding daily files; nothing is shuffled then.
    """

    partition: str = "day"
    key: str = "time"
    codec: str = "zstd"
    gather: bool = True


DAILY = Layout()


def _write(df: DataFrame, path: str, mode: str, layout: Layout, **options: str) -> None:
    if layout.gather:
        df = df.hint("rebalance", layout.partition)
    order = [c for c in (layout.partition, "time", "zlev", "lat_idx", "lon_idx") if c in df.columns]
    writer = df.sortWithinPartitions(*order).write.partitionBy(layout.partition).mode(mode)
    writer.options(compression=layout.codec, **options).parquet(path)


def write_create(df: DataFrame, path: str, layout: Layout = DAILY) -> None:
    """A new store; fails when there is one."""
    _write(df, path, "errorifexists", layout)


def write_overwrite(df: DataFrame, path: str, layout: Layout = DAILY) -> None:
    """A new store in place of any old one. ``df`` must not read from ``path``."""
    _write(df, path, "overwrite", layout)


def _as_stored(df: DataFrame, store: DataFrame, grow: bool = False) -> DataFrame:
    """The columns of the store in its types, then, with ``grow``, those that the store does not have yet.

    Without ``grow`` such a column is an error.
    """
    unknown = [c for c in df.columns if c not in store.columns]
    if unknown and not grow:
        raise ValueError(f"the store has no column {', '.join(sorted(unknown))}")
    stored = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in store.schema.fields
    ]
    return df.select(*stored, *unknown)


def _record_growth(df: DataFrame, store: DataFrame, path: str, layout: Layout) -> None:
    """Keep the schema of a store that gets new columns, so that reading need not open every file to find them."""
    if set(df.columns) - set(store.columns):
        fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name != layout.partition]
        schema = T.StructType([*fields, df.schema[layout.partition]])
        records.put(df.sparkSession, path, "schema", schema.jsonValue())


def write_append(df: DataFrame, path: str, layout: Layout = DAILY, grow: bool = False) -> None:
    """Add time steps the store does not have; :class:`SliceExists` when it has one of them."""
    finish_replacement(df.sparkSession, path, layout)
    store = read_store(df.sparkSession, path)
    df = _as_stored(df, store, grow)
    slices = _slices(df, layout)
    present = touched(store, slices, layout.partition).join(slices, [layout.partition, layout.key], "left_semi")
    if not present.isEmpty():
        raise SliceExists(f"the store at {path} already has some of these time steps")
    _record_growth(df, store, path, layout)
    _write(df, path, "append", layout)


def write_upsert(df: DataFrame, path: str, layout: Layout = DAILY, grow: bool = False) -> None:
    """Replace the time steps ``df`` has, append the new ones, leave all others as they are.

    Partitions ``df`` touches are replaced whole. When such a partition also holds other time steps, they are
    staged together with ``df`` beside the store first, so the store never reads what it overwrites and a lost writer loses
    nothing. Otherwise a failed write is repaired by running it again. With ``grow`` columns that the
    store does not have are added to it. ``df`` is read twice, for its time steps and for its rows.
    """
    finish_replacement(df.sparkSession, path, layout)
    _replace(df, read_store(df.sparkSession, path), path, layout, grow)


def _replace(df: DataFrame, store: DataFrame, path: str, layout: Layout, grow: bool) -> None:
    df = _as_stored(df, store, grow)
    _record_growth(df, store, path, layout)
    slices = _slices(df, layout)
    others = touched(store, slices, layout.partition).join(slices, [layout.partition, layout.key], "left_anti")
    if others.isEmpty():
        _write(df, path, "overwrite", layout, partitionOverwriteMode="dynamic")
    else:
        _publish(concat_time(others, df), path, layout)


def _publish(partitions: DataFrame, path: str, layout: Layout) -> None:
    """Put whole partitions in the place of the old ones, by way of a copy that outlives the writer."""
    spark, staged = partitions.sparkSession, f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    _write(partitions, staged, "overwrite", layout)
    records.put(spark, path, "replacement", {"staged": staged, "schema": partitions.schema.jsonValue()})
    finish_replacement(spark, path, layout)


def finish_replacement(spark: SparkSession, path: str, layout: Layout = DAILY) -> bool:
    """Publish a replacement that was staged but not known to be published; whether there was one.

    Every write begins with this. Publishing twice is the same as once.
    """
    _, under_way = records.latest(spark, path, "replacement")
    if not under_way or under_way.get("published"):
        return False
    staged = spark.read.schema(T.StructType.fromJson(under_way["schema"])).parquet(under_way["staged"])
    # What was staged is laid out already; it is copied file by file, without a shuffle.
    _write(staged, path, "overwrite", replace(layout, gather=False), partitionOverwriteMode="dynamic")
    records.put(spark, path, "replacement", {"published": True})
    discard(spark, under_way["staged"])
    return True


def write_store(df: DataFrame, path: str, layout: Layout = DAILY, grow: bool = False) -> str:
    """Create the store or upsert into it; returns which."""
    finish_replacement(df.sparkSession, path, layout)
    store = _open(df.sparkSession, path)
    if store is None:  # nothing there, or only what an empty batch left
        _write(df, path, "append", layout)
        return "created"
    _replace(df, store, path, layout, grow)
    return "upserted"


def newest_cells(df: DataFrame, order: Sequence[Column], key: Sequence[str] = ("day", *KEY)) -> DataFrame:
    """One row for each cell, the one greatest in ``order``; of equal ones the one whose values are greatest.

    A partial aggregate: repeated cells meet in their task first, and a shuffle deals the rest out by cell.
    """
    others = [c for c in df.columns if c not in key]
    plain = [c for c, kind in df.dtypes if c not in key and not kind.startswith("map")]
    rank = F.struct(*[o.alias(f"_order{i}") for i, o in enumerate(order)], *plain)
    # The greatest rank holds the values as well, so they are sorted and shuffled once; maps have no order and go beside it.
    best = F.max(rank) if plain == others else F.max_by(F.struct(*others), rank)
    return df.groupBy(*key).agg(best.alias("_best")).select(*[c if c in key else F.col(f"_best.`{c}`").alias(c) for c in df.columns])


def write_merge(df: DataFrame, path: str, order_by: Sequence[str] = (), layout: Layout = DAILY, grow: bool = False) -> str:
    """Create the store, or put the cells of ``df`` in it one by one: a cell replaces its like, all other cells stay.

    So a time step may come in parts, in any number of batches. Which of two versions of a cell counts is told by
    the columns ``order_by`` (e.g. the time at which a file was modified), kept in the store; without them, or where they
    are equal or NULL in both, by arrival, the later one. The same batch again changes nothing.

    Only the partitions that ``df`` touches are read and written, staged as in :func:`write_upsert`. ``df`` is read twice.
    """
    spark = df.sparkSession
    key = [layout.partition, *[c for c in KEY if c in df.columns]]
    order = [F.col(c) for c in order_by]
    finish_replacement(spark, path, layout)
    store = _open(spark, path)
    if store is None:
        _write(newest_cells(df, order, key), path, "append", layout)
        return "created"
    df = _as_stored(df, store, grow)
    _record_growth(df, store, path, layout)
    partitions = _slices(df, layout)
    both = concat_time(touched(store, partitions, layout.partition).withColumn("_new", F.lit(0)), df.withColumn("_new", F.lit(1)))
    merged = newest_cells(both, [*order, F.col("_new")], key).drop("_new")
    _publish(merged.select(*df.columns), path, layout)
    return "merged"


def replace_partitions(df: DataFrame, path: str, layout: Layout = DAILY) -> None:
    """Put ``df``, made of whole partitions of the store at ``path``, in their place; it may read from the store."""
    finish_replacement(df.sparkSession, path, layout)
    _publish(_as_stored(df, read_store(df.sparkSession, path)), path, layout)


def _slices(df: DataFrame, layout: Layout) -> DataFrame:
    """The time steps of a batch with their partitions."""
    return broadcast_if_small(df.select(layout.partition, layout.key).distinct())


LISTED = 1000  # partitions up to which a scan is told each one by name


def _named(store: DataFrame, partitions: DataFrame, partition: str) -> DataFrame:
    """Store rows in some partitions, which are literals in the plan and so chosen before anything is read.

    Beyond ``LISTED`` partitions the literals are the first and the last, and a join leaves out those between.
    """
    some = settle(partitions.select(partition).distinct())
    first = some.limit(LISTED + 1).collect()
    if len(first) <= LISTED:
        values = [row[0] for row in first]
        known = F.col(partition).isin([v for v in values if v is not None])
        return store.filter(known | F.col(partition).isNull() if None in values else known)
    ends = some.agg(F.min(partition), F.max(partition)).first()
    return store.filter(F.col(partition).between(F.lit(ends[0]), F.lit(ends[1]))).join(broadcast_if_small(some), partition, "left_semi")


def touched(store: DataFrame, slices: DataFrame, partition: str = "day") -> DataFrame:
    """Store rows in the partitions of some time steps."""
    return _named(store, slices, partition)


def has_time(times: DataFrame, store: DataFrame, key: str = "time") -> DataFrame:
    """The distinct time steps of ``times`` that the store has; only their partitions are read.

    With ``stored_times`` of a summary as ``store`` no cell is read.
    """
    wanted = settle(times.select(key).distinct())
    if "day" in store.columns:
        store = _named(store, wanted.select(F.to_date(key).alias("day")), "day")
    return wanted.join(store.select(key).distinct(), key, "left_semi")


def drop_time(store: DataFrame, times: DataFrame, key: str = "time") -> DataFrame:
    """The store without the given time steps; the cells stay where they are while the steps are few."""
    return store.join(broadcast_if_small(times.select(key).distinct()), key, "left_anti")


def concat_time(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both grids, one after the other; nothing is deduplicated."""
    return first.unionByName(second, allowMissingColumns=True)


def upsert_logical(store: DataFrame, batch: DataFrame, key: str = "time") -> DataFrame:
    """What :func:`write_upsert` leaves in the store, as a query."""
    return concat_time(drop_time(store, batch, key), batch)


def sort_by_time(df: DataFrame) -> DataFrame:
    """Ordered by time and then by position, so that one large day spans several sort ranges."""
    return df.orderBy(*[c for c in ("time", "zlev", "lat_idx", "lon_idx") if c in df.columns])


def select_time(df: DataFrame, *times) -> DataFrame:
    """The slices at exact times; also filters on ``day`` so that a store reads only those partitions."""
    instants = [F.lit(str(t)).cast("timestamp_ntz") for t in times]
    selected = df.filter(F.col("time").isin(instants))
    if "day" in df.columns:
        selected = selected.filter(F.col("day").isin([i.cast("date") for i in instants]))
    return selected


def select_first_time(df: DataFrame) -> DataFrame:
    """The first time step."""
    if "day" in df.columns:  # a partition column: the first day is found without reading cells
        df = df.filter(F.col("day") == df.agg(F.min("day").alias("day")).scalar())
    return df.filter(F.col("time") == df.agg(F.min("time").alias("time")).scalar())


def fingerprint_checksum(name: str = "spatial_hash") -> Column:
    """Order-independent roll-up of fingerprints: the sum of their leading 60 bits, so that repeated cells count."""
    return F.sum(F.conv(F.substring(name, 1, 15), 16, 10).cast("decimal(38,0)"))


def store_summary(store: DataFrame, variable: str = "sst") -> DataFrame:
    """One row per day: time steps, cells, valid cells, axis extents, value range, fingerprint roll-up.

    All aggregates have small buffers and combine before the shuffle.
    """
    value = null_if_missing(variable)
    return store.groupBy("day").agg(
        F.array_sort(F.collect_set("time")).alias("times"),
        F.count("*").alias("cells"),
        F.count(value).alias("valid_cells"),
        F.min("lat_idx").alias("first_lat_idx"),
        F.max("lat_idx").alias("last_lat_idx"),
        F.min("lon_idx").alias("first_lon_idx"),
        F.max("lon_idx").alias("last_lon_idx"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        fingerprint_checksum().alias("checksum"),
    )


SUMMARY = Layout(partition="month", key="day")


def _by_month(summary: DataFrame) -> DataFrame:
    return summary.withColumn("month", F.trunc("day", "month"))


def write_summary(store: DataFrame, path: str) -> None:
    """Keep the summary beside the store, in place of any old one."""
    write_overwrite(_by_month(store_summary(store)), path, SUMMARY)


def refresh_summary(spark: SparkSession, store_path: str, path: str, days: DataFrame | None = None) -> None:
    """Bring a summary up to date for ``days(day)``, all days without them; only those partitions of the store are read."""
    store = read_store(spark, store_path)
    if days is None:
        write_summary(store, path)
    else:
        write_store(_by_month(store_summary(touched(store, days))), path, SUMMARY)


def stored_times(summary: DataFrame) -> DataFrame:
    """The time steps of a store from its summary, without reading the store."""
    return summary.select(F.explode("times").alias("time"))
