"""Every operator as a query over the given tables.

The grid is made of ``lineitem`` (see ``gridding``), object listings and events of ``events``, file
names of ``documents`` and ``pages``. Values are shown as 64-bit so that results compare plainly.
"""

from __future__ import annotations

import time

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions import names, text, times
from tidegrid.functions.fingerprint import add_fingerprints, cell_fingerprint, fingerprint_fallback
from tidegrid.functions.missing import fill_sentinel, mask_missing, null_if_missing
from tidegrid.model import HASHED, KEY, VARIABLES, conform
from tidegrid.operators import grid as g
from tidegrid.operators import layout, stats, tiles, verify
from tidegrid.operators.cellwise import apply_cellwise
from tidegrid.plans.convert import analyse, convert_files
from tidegrid.plans.convert import poll_convert as convert_poll
from tidegrid.plans.gridding import file_name, grid_observations
from tidegrid.session import scratch_path, settle
from tidegrid.sources import events as ev
from tidegrid.sources import files as fs
from tidegrid.sources import listing as ls
from tidegrid.sources import store as st
from tidegrid.streaming import jobs

MARK = "2024-01-15 18:00:00"
START = "2024-01-10 00:00:00"
TILE = (6, 8)
COARSE = {"n_lat": 12, "n_lon": 16}
# A configuration as users write it.
CONFIG = {"variables": {"sst": {"chunks": {"time": 1, "zlev": 1, "lat": 180, "lon": 360}}}}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_grid(spark, sf_dir, **shape) -> DataFrame:
    return grid_observations(table(spark, sf_dir, "lineitem"), "day", **shape)


def monthly_grid(spark, sf_dir, **shape) -> DataFrame:
    return grid_observations(table(spark, sf_dir, "lineitem"), "month", **shape)


def wide(df: DataFrame, *columns: str) -> DataFrame:
    """The cell key and some variables, floats as doubles and missing as NULL."""
    types = dict(df.dtypes)
    shown = [
        null_if_missing(c).cast("double").alias(c) if types[c] in ("float", "double") else F.col(c)
        for c in columns or VARIABLES
    ]
    return df.select(*[k for k in KEY if k in types], *shown)


def iso_day(day):
    return F.date_format(day, "yyyy-MM-dd")


def joined(verifiers):
    return F.array_join(verifiers, ",")


def object_listing(spark, sf_dir) -> DataFrame:
    """Objects named after events; clicks are text files, all others grid files."""
    suffix = F.when(F.col("event_type") == "click", ".txt").otherwise(".nc")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("grids/obj-"), F.col("event_id"), suffix).alias("key"),
        F.col("ts").alias("last_modified"),
        (F.col("event_type") != "error").alias("ok"),
    )


def event_documents(spark, sf_dir) -> DataFrame:
    """Notification documents with two records each; every other one is in an envelope."""
    rows = table(spark, sf_dir, "events")

    def record(suffix: str):
        key = F.concat(F.lit("in/e."), F.col("event_id"), F.lit(suffix))
        return F.struct(
            F.when(F.col("event_id") % 7 == 0, "ObjectRemoved:Delete").otherwise("ObjectCreated:Put").alias("eventName"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("eventTime"),
            F.struct(
                F.struct(F.concat(F.lit("bucket-"), F.col("event_type")).alias("name")).alias("bucket"),
                F.struct(key.alias("key"), F.col("user_id").alias("size"), F.col("props").alias("eTag")).alias("object"),
            ).alias("s3"),
        )

    bare = F.to_json(F.struct(F.array(record(".nc"), record(".txt")).alias("Records")))
    envelope = F.to_json(F.struct(F.array(F.struct(F.struct(bare.alias("Message")).alias("Sns"))).alias("Records")))
    return rows.select("event_id", F.when(F.col("event_id") % 2 == 0, envelope).otherwise(bare).alias("json"))


def parsed_events(spark, sf_dir) -> DataFrame:
    return ev.parse_object_events(event_documents(spark, sf_dir)).drop("json")


def day_files(spark, sf_dir, path: str) -> None:
    """The monthly grid as one Parquet file per time step, in folders that carry the file names."""
    grid = monthly_grid(spark, sf_dir).withColumn("file", file_name())
    grid.drop("day").withColumnRenamed("time", "source_time").repartition("file").write.partitionBy(
        "file"
    ).parquet(path)


def further_files(spark, sf_dir, path: str) -> None:
    """As ``day_files``, with two variables more."""
    grid = monthly_grid(spark, sf_dir, further=True).withColumn("file", file_name())
    grid.drop("day").withColumnRenamed("time", "source_time").repartition("file").write.partitionBy("file").parquet(path)


def folder_name():
    return F.element_at(F.split("path", "/"), -2)


def decode_parquet(content: bytes) -> pd.DataFrame:
    return pq.read_table(pa.BufferReader(content), use_threads=False).to_pandas(split_blocks=True, self_destruct=True)


def decode_but_december(content: bytes) -> pd.DataFrame:
    cells = decode_parquet(content)
    if cells["source_time"].iloc[0].month == 12:
        raise ValueError("unreadable")
    return cells


def finished(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


# --- sources -----------------------------------------------------------------------------------


def discover_since(spark, sf_dir):
    found = ls.discover_since(object_listing(spark, sf_dir), MARK, ".nc")
    return found.select("key", "last_modified")


def read_mark(spark, sf_dir):
    state = object_listing(spark, sf_dir).filter("not ok").select(F.col("last_modified").alias("mark"))
    return ls.read_mark(state, START)


def advance_mark(spark, sf_dir):
    kept = ls.discover_since(object_listing(spark, sf_dir), MARK, ".nc")
    return ls.advance_mark(kept, MARK)


def parse_object_events(spark, sf_dir):
    return parsed_events(spark, sf_dir).drop("parsed")


def filter_object_events(spark, sf_dir):
    return ev.filter_object_events(parsed_events(spark, sf_dir)).select("event_id", "uri", "event_name")


def ingest_files(spark, sf_dir):
    path = scratch_path(spark, "files")
    day_files(spark, sf_dir, path)
    return wide(fs.ingest_files(spark, path, glob="*.parquet", name=folder_name()))


def _written(spark, sf_dir, name="store"):
    path = scratch_path(spark, name)
    st.write_create(conform(monthly_grid(spark, sf_dir)), path)
    return path


def read_store(spark, sf_dir):
    stored = st.read_store(spark, _written(spark, sf_dir))
    return wide(stored.withColumn("day", iso_day("day")), "day", *VARIABLES)


def select_existing_files(spark, sf_dir):
    def named(df):
        return df.select(F.concat(F.lit("docs/d."), F.col("doc_id"), F.lit(".nc")).alias("key"))

    requested = named(table(spark, sf_dir, "documents"))
    return fs.select_existing_files(requested, named(table(spark, sf_dir, "labels")))


# --- sinks ---------------------------------------------------------------------------------------


def write_create(spark, sf_dir):
    path = _written(spark, sf_dir)
    return st.read_store(spark, path).groupBy(iso_day("day").alias("day")).agg(
        F.count("*").alias("cells"), F.sum(F.col("sst").cast("double")).alias("sum_sst")
    )


def write_append(spark, sf_dir):
    grid, path = conform(monthly_grid(spark, sf_dir)), scratch_path(spark, "store")
    st.write_create(grid.filter("day < date '1998-01-01'"), path)
    st.write_append(grid.filter("day >= date '1998-01-01'"), path)
    return wide(st.read_store(spark, path))


def write_upsert(spark, sf_dir):
    grid, path = conform(monthly_grid(spark, sf_dir)), scratch_path(spark, "store")
    st.write_create(grid, path)
    newer = grid.filter("year(day) = 1998").withColumn("sst", F.col("sst") + 100)
    st.write_upsert(newer, path)
    st.write_upsert(newer, path)
    return wide(st.read_store(spark, path))


def write_overwrite(spark, sf_dir):
    path = _written(spark, sf_dir)
    st.write_overwrite(conform(monthly_grid(spark, sf_dir)).filter("year(day) >= 1998"), path)
    return wide(st.read_store(spark, path))


def _summarized(spark, sf_dir) -> str:
    """A store written in two parts, its summary kept up to date with each."""
    path, summary = scratch_path(spark, "store"), scratch_path(spark, "summary")
    cells = conform(add_fingerprints(monthly_grid(spark, sf_dir), "sha256"))
    st.write_create(cells.filter("year(day) < 1998"), path)
    st.refresh_summary(spark, path, summary)
    later = cells.filter("year(day) >= 1998")
    st.write_store(later, path)
    st.refresh_summary(spark, path, summary, later.select("day").distinct())
    return summary


def store_summary(spark, sf_dir):
    rows = st.read_store(spark, _summarized(spark, sf_dir)).drop("month", "times")
    doubles = {c: F.col(c).cast("double") for c in ("min_value", "max_value")}
    return rows.withColumns({"day": iso_day("day"), "checksum": F.col("checksum").cast("string"), **doubles})


def catalogue_has_time(spark, sf_dir):
    summary = st.read_store(spark, _summarized(spark, sf_dir))
    return st.has_time(_order_times(spark, sf_dir), st.stored_times(summary))


def write_profile(spark, sf_dir):
    path = scratch_path(spark, "profile")
    layout.write_profile(suggest_layout(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("layout"))


def ingest_with_status(spark, sf_dir):
    path = scratch_path(spark, "files")
    day_files(spark, sf_dir, path)
    # Contents do not travel with the rows: tasks open the files they decode.
    found = settle(fs.with_file_time(fs.binary_files(spark, path, "*.parquet").drop("content"), name=folder_name()))
    ingested = fs.ingest_with_status(fs.in_bins(found), decode_but_december)
    per_day = ingested.grid.groupBy("time").agg(F.count("*").alias("rows_written"))
    status = ingested.status.join(per_day, F.col("file_time") == F.col("time"), "left")
    result = settle(
        status.select(
            "file_time",
            "status",
            "error",
            F.col("cells"),
            F.coalesce("rows_written", F.lit(0)).alias("rows_written"),
        )
    )
    ingested.release()
    return result


def ingest_all_variables(spark, sf_dir):
    """Variables the schema does not name, and the file's own time, from files through a store that did not have them."""
    folder, path = scratch_path(spark, "files"), scratch_path(spark, "store")
    further_files(spark, sf_dir, folder)
    found = fs.with_file_time(fs.binary_files(spark, folder, "*.parquet"), name=folder_name())
    cells = conform(fs.decoded_cells(fs.decode_files(found, decode_parquet, "raise", 3)))
    st.write_create(conform(monthly_grid(spark, sf_dir)).filter("year(day) = 1997"), path)
    st.write_store(cells, path, grow=True)
    stored = st.read_store(spark, path).withColumn("items", F.col("items").cast("bigint"))
    return wide(stored, "sst", "flag", "items", "source_time")


def poll_convert(spark, sf_dir):
    """Two polls of a folder in which the files of each December cannot be read, and what the work list has then."""
    folder, store, state = scratch_path(spark, "files"), scratch_path(spark, "store"), scratch_path(spark, "marks")
    day_files(spark, sf_dir, folder)
    decoded = []
    for _ in range(2):
        status = convert_poll(spark, folder, store, state, decode_but_december, glob="*.parquet", name=folder_name(), algorithm="sha256")
        decoded.append(status.select("file_time", F.lit(1).alias("_times")))
    rows = st.read_store(spark, store).groupBy("time").agg(F.count("*").alias("cells"), F.sum(F.col("sst").cast("double")).alias("sum_sst"))
    work = ls.work_list(spark, state).groupBy(F.element_at(F.split("key", "/"), -2).alias("folder")).agg(
        F.max("attempt").alias("attempts"), F.max_by("state", "attempt").alias("state")
    )
    work = work.withColumn("file_time", names.noon_of(names.file_date("folder")))
    times = decoded[0].unionByName(decoded[1]).groupBy("file_time").agg(F.sum("_times").alias("polls"))
    joined_rows = work.join(times, "file_time").join(rows, F.col("file_time") == F.col("time"), "left")
    return joined_rows.select("file_time", "attempts", "state", "polls", "cells", "sum_sst")


# --- projections, filters, predicates --------------------------------------------------------------


def ensure_zlev(spark, sf_dir):
    return wide(fs.ensure_zlev(daily_grid(spark, sf_dir).drop("zlev")), "sst")


def select_first_level(spark, sf_dir):
    return wide(g.select_first_level(daily_grid(spark, sf_dir, levels=2)), "sst")


def select_time(spark, sf_dir):
    return wide(st.select_time(daily_grid(spark, sf_dir), "1998-06-15 12:00:00", "1999-01-01 12:00:00"))


def select_first_time(spark, sf_dir):
    return wide(st.select_first_time(monthly_grid(spark, sf_dir)))


def point_by_index(spark, sf_dir):
    points = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_nationkey") > 20, F.lit(5000)).otherwise(F.col("s_suppkey") % 720 - 720).alias("lat_idx"),
        F.col("s_nationkey").alias("lon_idx"),
        F.col("s_name").alias("name"),
    )
    return wide(g.point_by_index(daily_grid(spark, sf_dir), points, 720, 1440), "name", "lat", "lon", "sst")


def point_by_label(spark, sf_dir):
    points = table(spark, sf_dir, "supplier").select(
        (F.lit(-89.875) + F.lit(0.25) * (F.col("s_suppkey") % 720)).alias("lat"),
        (F.lit(0.125) + F.lit(0.25) * F.col("s_nationkey")).alias("lon"),
        F.col("s_name").alias("name"),
    )
    return wide(g.point_by_label(daily_grid(spark, sf_dir), points), "name", "sst")


def select_variables(spark, sf_dir):
    return wide(g.select_variables(daily_grid(spark, sf_dir), ["sst"]), "lat", "lon", "sst")


def mask_missing_query(spark, sf_dir):
    masked = mask_missing(daily_grid(spark, sf_dir), VARIABLES)
    return masked.select(*KEY, *[F.col(v).cast("double").alias(v) for v in VARIABLES])


def fill_sentinel_query(spark, sf_dir):
    filled = fill_sentinel(daily_grid(spark, sf_dir), VARIABLES)
    return filled.select(*KEY, *[F.col(v).cast("double").alias(v) for v in VARIABLES])


def _schemas(spark, sf_dir) -> dict[str, DataFrame]:
    return {"plain": daily_grid(spark, sf_dir), "further": daily_grid(spark, sf_dir, further=True)}


def _of_schemas(spark, sf_dir, answer) -> DataFrame:
    """An answer for a grid and for one with variables of other types, told by their schemas."""
    rows = [answer(layout.variable_types(df)).select(F.lit(name).alias("grid"), "*") for name, df in _schemas(spark, sf_dir).items()]
    return rows[0].unionByName(rows[1])


def all_floating(spark, sf_dir):
    return _of_schemas(spark, sf_dir, layout.floating_profile)


def squeeze(spark, sf_dir):
    return wide(g.squeeze(daily_grid(spark, sf_dir), ["zlev"]), "lat", "lon", "sst")


# --- joins -----------------------------------------------------------------------------------------


def build_grid(spark, sf_dir):
    cells = daily_grid(spark, sf_dir)
    return g.build_grid(g.axis(cells, "lat"), g.axis(cells, "lon"))


def expand_time(spark, sf_dir):
    cells = daily_grid(spark, sf_dir, **COARSE)
    plane = g.build_grid(g.axis(cells, "lat"), g.axis(cells, "lon"))
    return g.expand_time(plane, g.axis(cells, "time"))


def _order_times(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(names.noon_of("o_orderdate").alias("time"))


def has_time(spark, sf_dir):
    return st.has_time(_order_times(spark, sf_dir), daily_grid(spark, sf_dir))


def drop_time(spark, sf_dir):
    gone = _order_times(spark, sf_dir).filter("year(time) = 1997")
    return wide(st.drop_time(daily_grid(spark, sf_dir), gone), "sst")


def align_variables(spark, sf_dir):
    cells = daily_grid(spark, sf_dir)
    return wide(g.align_variables({v: cells.select(*KEY, v) for v in VARIABLES}))


def attach_variable(spark, sf_dir):
    cells = daily_grid(spark, sf_dir)
    warm = cells.filter(null_if_missing("sst") > 25).select(*KEY, (F.col("sst") - 25).alias("excess"))
    return wide(g.attach_variable(cells, warm), "sst", "excess")


def lookup_config(spark, sf_dir):
    configs = table(spark, sf_dir, "region").select(
        F.concat(F.lit("bucket-"), F.element_at(F.array(*map(F.lit, ["click", "view", "purchase", "error", "none"])), F.col("r_regionkey") + 1)).alias("bucket"),
        F.col("r_name").alias("dataset"),
    )
    found = ev.lookup_config(parsed_events(spark, sf_dir), configs)
    return found.select("uri", "bucket", "dataset")


def _changed(cells: DataFrame) -> DataFrame:
    """A store that lacks one year and has other values where the error of another year is large."""
    touched = (F.year("time") == 1999) & (null_if_missing("err") > 0.05)
    kept = cells.filter(F.year("time") != 1996)
    return kept.withColumn("sst", F.when(touched, F.col("sst") + 1).otherwise(F.col("sst")))


def reconcile_stats(spark, sf_dir):
    cells = daily_grid(spark, sf_dir)
    source = cells.filter(F.year("time") != 2000)
    result = stats.reconcile_stats(source, _changed(cells))
    return result.select("time", "status", "source_daily_min", "store_daily_min", "source_daily_max", "store_daily_max")


def verify_fingerprints(spark, sf_dir):
    cells = daily_grid(spark, sf_dir)
    store = add_fingerprints(_changed(cells), "sha256")
    return verify.compare_fingerprints(store, cells.filter(F.year("time") != 2000), "sha256").select(*KEY, "status")


def compare_by_tiles(spark, sf_dir):
    """A store against its source by digests of tiles, with the default fingerprint."""
    gridded = scratch_path(spark, "cells")
    daily_grid(spark, sf_dir).write.parquet(gridded)
    cells = spark.read.parquet(gridded)  # store and source are read twice each
    few = (F.col("lat_idx") < 30) & (F.month("time") == 5)
    store = cells.withColumn("sst", F.when(few, F.col("sst") + 1).otherwise(F.col("sst"))).filter("not (year(time) = 1995 and lon_idx = 7)")
    source = cells.filter("not (year(time) = 1996 and lon_idx = 9)")
    return verify.compare_by_tiles(add_fingerprints(store), source).select(*KEY, "status")


def tile_digests(spark, sf_dir):
    digests = verify.tile_digests(add_fingerprints(daily_grid(spark, sf_dir)), "spatial_hash")
    return digests.select(iso_day("day").alias("day"), "tile_i", "tile_j", "cells")


# --- aggregations and windows ----------------------------------------------------------------------


def daily_stats(spark, sf_dir):
    return stats.daily_stats(daily_grid(spark, sf_dir))


def dataset_overview(spark, sf_dir):
    return stats.dataset_overview(daily_grid(spark, sf_dir))


def array_shapes(spark, sf_dir):
    return stats.array_shapes(daily_grid(spark, sf_dir))


def discovery_counts(spark, sf_dir):
    return ls.discovery_counts(object_listing(spark, sf_dir), MARK, ".nc")


def ingest_metrics(spark, sf_dir):
    observed, observation = fs.ingest_metrics(daily_grid(spark, sf_dir), f"ingest-{time.monotonic_ns()}")
    observed.write.format("noop").mode("overwrite").save()
    seen = observation.get
    return spark.createDataFrame([(seen["cells"], seen["valid_cells"])], "cells bigint, valid_cells bigint")


def max_modified(spark, sf_dir):
    return ls.max_modified(object_listing(spark, sf_dir))


def running_mean(spark, sf_dir):
    report = analyse(daily_grid(spark, sf_dir))
    return report.select("time", "day_number", F.round("daily_mean", 6).alias("daily_mean"), F.round("running_mean", 6).alias("running_mean"))


def day_number(spark, sf_dir):
    days = settle(daily_grid(spark, sf_dir).select("time").distinct())
    return stats.day_number(days)


def running_components(spark, sf_dir):
    return stats.running_components(settle(stats.daily_stats(monthly_grid(spark, sf_dir))))


def running_terms(spark, sf_dir):
    return stats.running_terms(settle(stats.daily_stats(daily_grid(spark, sf_dir))))


def components_of_days(spark, sf_dir):
    """The components of the first day of each quarter that has one, over all days of the grid."""
    daily = settle(stats.daily_stats(daily_grid(spark, sf_dir)))
    first = daily.groupBy(F.trunc("time", "quarter").alias("quarter")).agg(F.min("time").alias("time"))
    shown = stats.running_components(daily, days=first)
    return shown.select("time", "day_number", F.length("components").alias("chars"), F.sha2("components", 256).alias("sha256"))


# --- order, samples, sets --------------------------------------------------------------------------


def sort_by_time(spark, sf_dir):
    return st.sort_by_time(wide(daily_grid(spark, sf_dir), "sst"))


def sample_cells(spark, sf_dir):
    picked = stats.sample_cells(daily_grid(spark, sf_dir), columns=HASHED)
    shown = add_fingerprints(picked).select("time", "draw", "lat", "lon", "sst", "spatial_hash")
    return shown.withColumn("sst", null_if_missing("sst").cast("double"))


def sample_verifiers(spark, sf_dir):
    picked = stats.sample_verifiers(verify.add_verifiers(daily_grid(spark, sf_dir)))
    return picked.withColumn("verifier_pubkeys", joined("verifier_pubkeys"))


def first_last_time(spark, sf_dir):
    arrival = -F.datediff("time", F.lit("1990-01-01"))
    return stats.first_last_time(daily_grid(spark, sf_dir).withColumn("arrival", arrival), "arrival")


def concat_time(spark, sf_dir):
    cells = daily_grid(spark, sf_dir)
    return wide(st.concat_time(cells.filter("year(time) <= 1998"), cells.filter("year(time) >= 1998").drop("ice")))


def upsert_logical(spark, sf_dir):
    cells = daily_grid(spark, sf_dir)
    batch = cells.filter((F.year("time") == 1998) & (null_if_missing("sst") > 25)).withColumn("sst", F.col("sst") + 100)
    return wide(st.upsert_logical(cells, batch), "sst")


def recenter_longitude(spark, sf_dir):
    return wide(g.recenter_longitude(daily_grid(spark, sf_dir)), "lon", "sst")


# --- column expressions ----------------------------------------------------------------------------


def _document_names(spark, sf_dir):
    """File names of documents: some preliminary, some with an impossible month, some without a date."""
    number = F.col("doc_id") % 400
    month = F.lpad((number % 13 + 1).cast("string"), 2, "0")
    date = F.concat(F.lit("2025"), month, F.lpad((number % 28 + 1).cast("string"), 2, "0"))
    marker = F.when(F.col("doc_id") % 3 == 0, "_preliminary").otherwise("")
    dated = F.concat(F.lit("data/"), F.col("lang"), F.lit("/grid-v02."), date, marker, F.lit(".nc"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 11 == 0, "sample.nc").otherwise(dated).alias("path")
    )


def file_date(spark, sf_dir):
    named = _document_names(spark, sf_dir)
    return named.select(
        "path", "doc_id", names.file_date("path", "_preliminary").alias("file_date"), names.file_date("path").alias("plain_date")
    )


def strip_suffix(spark, sf_dir):
    return _document_names(spark, sf_dir).select("doc_id", names.strip_suffix(names.base_name("path"), "_preliminary").alias("name"))


def noon_of(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", names.noon_of("o_orderdate").alias("noon"))


def dotted_date(spark, sf_dir):
    return _document_names(spark, sf_dir).select("doc_id", names.dotted_date("path").alias("dotted"))


def to_utc(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.element_at(F.array(F.lit(""), F.lit("Z"), F.lit("+02:00")), (F.col("event_id") % 3 + 1).cast("int"))
    written = table(spark, sf_dir, "events").select("event_id", F.concat(stamp, zone).alias("written"))
    instant = times.to_utc("written")
    return written.select("event_id", "written", instant.alias("instant"), times.iso_text(instant).alias("iso"))


def date_part(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", iso_day(times.date_part("ts")).alias("date"))


def format_day(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.format_day("ts").alias("day"))


def object_uri(spark, sf_dir):
    address = names.split_uri(F.regexp_replace("url", "^https?://", "s3://"))
    parts = table(spark, sf_dir, "pages").select("page_id", address["bucket"].alias("bucket"), address["key"].alias("key"))
    return parts.withColumn("uri", names.object_uri("bucket", "key"))


def cell_fingerprint_query(spark, sf_dir):
    cells = daily_grid(spark, sf_dir)
    return cells.select(*KEY, cell_fingerprint(HASHED, "sha256").alias("spatial_hash"))


def fingerprint_fallback_query(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.lit(0.25) * (F.col("l_suppkey") % 720)).alias("lat"),
        (F.lit(0.25) * (F.col("l_partkey") % 1440)).alias("lon"),
        F.when(F.col("l_linenumber") == 1, F.col("l_returnflag")).otherwise(F.col("l_quantity").cast("string")).alias("sst"),
        F.when(F.col("l_linenumber") == 2, "NaN").otherwise(F.col("l_discount").cast("string")).alias("err"),
        F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_tax").cast("string")).alias("ice"),
        F.lit("1.5").alias("anom"),
    )
    return raw.select("l_orderkey", "l_linenumber", "l_partkey", fingerprint_fallback(HASHED, "sha256").alias("spatial_hash"))


def empty_verifiers(spark, sf_dir):
    return verify.add_verifiers(daily_grid(spark, sf_dir)).select(*KEY, joined("verifier_pubkeys").alias("verifier_pubkeys"))


def _verifier_keys(spark, sf_dir):
    """Order keys as verifier keys of the cells of their items, on the coarse grid: many per cell."""
    shipped = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        names.noon_of(F.trunc(shipped, "month")).alias("time"),
        F.lit(1).alias("zlev"),
        (F.col("l_suppkey") % 12).cast("int").alias("lat_idx"),
        (F.col("l_partkey") % 16).cast("int").alias("lon_idx"),
        F.concat(F.lit("key-"), F.col("l_orderkey") % 50).alias("pubkey"),
        F.col("l_orderkey").alias("seq"),
    )


def append_verifier(spark, sf_dir):
    cells = verify.add_verifiers(monthly_grid(spark, sf_dir, **COARSE))
    appended = verify.append_verifier(cells, _verifier_keys(spark, sf_dir))
    return appended.select(*KEY, joined("verifier_pubkeys").alias("verifier_pubkeys"))


def append_verifier_to_store(spark, sf_dir):
    """Keys for the cells of one year, put into a store of all years."""
    path = scratch_path(spark, "store")
    st.write_create(conform(verify.add_verifiers(monthly_grid(spark, sf_dir, **COARSE))), path)
    verify.append_verifier_to_store(_verifier_keys(spark, sf_dir).filter("year(time) = 1996"), path)
    return st.read_store(spark, path).select(*KEY, joined("verifier_pubkeys").alias("verifier_pubkeys"))


def format_stat(spark, sf_dir):
    daily = stats.daily_stats(daily_grid(spark, sf_dir))
    return daily.select("time", text.format_stat("daily_mean", 10).alias("shown"), text.format_stat("daily_max", 10, "°C").alias("shown_max"))


def json_text(spark, sf_dir):
    return text.json_text(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"))


# --- tiles and layout ------------------------------------------------------------------------------


def tile_ids(spark, sf_dir):
    tiled = tiles.tile_ids(daily_grid(spark, sf_dir), CONFIG, "sst")
    whole = tiles.tile_ids(tiled.withColumnsRenamed({"tile_i": "sst_i", "tile_j": "sst_j"}), CONFIG, "anom")
    plain = tiles.tile_ids(whole.withColumnsRenamed({"tile_i": "anom_i", "tile_j": "anom_j"}))
    return plain.select(*KEY, "sst_i", "sst_j", "anom_i", "anom_j", "tile_i", "tile_j")


def _packed(spark, sf_dir):
    return tiles.pack_tiles(mask_missing(daily_grid(spark, sf_dir, **COARSE), ["sst"]), *TILE)


def pack_tiles(spark, sf_dir):
    whole = F.transform("values", lambda v: v.cast("int").cast("string"))
    return _packed(spark, sf_dir).withColumn("values", F.array_join(whole, ",", "-"))


def convert_tiles(spark, sf_dir):
    """Tiles of all variables, kept by a conversion of files with a configuration, in two polls' worth of files."""
    folder, store, tiled = scratch_path(spark, "files"), scratch_path(spark, "store"), scratch_path(spark, "tiles")
    grid = monthly_grid(spark, sf_dir, **COARSE).withColumn("file", file_name())
    grid.drop("day").withColumnRenamed("time", "source_time").repartition("file").write.partitionBy("file").parquet(folder)
    config = {"variables": {"sst": {"chunks": {"lat": TILE[0], "lon": TILE[1]}}, "anom": {"chunks": {"time": 1, "lat": 4}}}}
    files = fs.binary_files(spark, folder, "*.parquet")
    for half in ("file_time < '1998-01-01'", "file_time >= '1998-01-01'"):
        chosen = fs.with_file_time(files, name=folder_name()).filter(half).drop("file_time")
        convert_files(chosen, store, decode_parquet, name=folder_name(), algorithm="sha256", tiles_path=tiled, config=config)
    hundredths = F.transform("values", lambda v: F.round(v.cast("double") * 100).cast("bigint").cast("string"))
    return st.read_store(spark, tiled).drop("day").withColumn("values", F.array_join(hundredths, ",", "-"))


def unpack_tiles(spark, sf_dir):
    cells = tiles.unpack_tiles(_packed(spark, sf_dir), *TILE)
    return cells.withColumn("sst", F.col("sst").cast("double"))


def _profile(spark, sf_dir):
    return layout.profile_dataset(daily_grid(spark, sf_dir))


def suggest_chunks(spark, sf_dir):
    return layout.suggest_chunks(_profile(spark, sf_dir)).select("variable", "axis", "itemsize", "chunk")


def profile_dataset(spark, sf_dir):
    return _profile(spark, sf_dir).select("variable", "axis", "axis_size", "dtype", "itemsize")


def suggest_codec(spark, sf_dir):
    return _of_schemas(spark, sf_dir, layout.suggest_codec)


def profile_all_variables(spark, sf_dir):
    profile = layout.suggest_chunks(layout.profile_dataset(daily_grid(spark, sf_dir, further=True)))
    return profile.select("variable", "axis", "axis_size", "dtype", "itemsize", "chunk")


def suggest_layout(spark, sf_dir):
    return layout.suggest_layout(_profile(spark, sf_dir))


# --- streams -----------------------------------------------------------------------------------------


def stream_files(spark, sf_dir):
    source, out = scratch_path(spark, "files"), scratch_path(spark, "listed")
    day_files(spark, sf_dir, source)
    listed = jobs.stream_files(spark, source, "*.parquet").select(folder_name().alias("folder"))
    writer = listed.writeStream.format("parquet").option("path", out)
    finished(writer.option("checkpointLocation", scratch_path(spark, "cp")).trigger(availableNow=True).start())
    return spark.read.parquet(out).select(names.noon_of(names.file_date("folder")).alias("file_time"))


def stream_convert(spark, sf_dir):
    source, store = scratch_path(spark, "files"), scratch_path(spark, "store")
    day_files(spark, sf_dir, source)
    listed = jobs.stream_files(spark, source, "*.parquet", max_files=60)
    finished(
        jobs.stream_convert(
            listed,
            store,
            scratch_path(spark, "status"),
            decode_parquet,
            scratch_path(spark, "cp"),
            name=folder_name(),
            available_now=True,
        )
    )
    stored = st.read_store(spark, store)
    return wide(stored.withColumn("verifier_pubkeys", joined("verifier_pubkeys")), "sst", "spatial_hash", "verifier_pubkeys")


def _grid_stream(spark, sf_dir, per_trigger: int):
    """The monthly grid as a stream of files in which every time step is split, with a third of the cells coming twice."""
    source = scratch_path(spark, "batches")
    cells = conform(monthly_grid(spark, sf_dir))
    cells.repartition(12, *KEY).write.parquet(source)
    written = spark.read.schema(cells.schema).parquet(source)  # not gridded again
    written.filter("lon_idx % 3 = 0").repartition(3, *KEY).write.mode("append").parquet(source)
    return spark.readStream.schema(cells.schema).option("maxFilesPerTrigger", per_trigger).parquet(source)


def stream_upsert(spark, sf_dir):
    store = scratch_path(spark, "store")
    stream = _grid_stream(spark, sf_dir, 6)
    finished(jobs.stream_upsert(stream, store, scratch_path(spark, "cp"), available_now=True))
    return wide(st.read_store(spark, store))


def merge_versions(spark, sf_dir):
    """Cells that come in three batches; the last one brings old versions of cells and one version twice."""
    store, gridded = scratch_path(spark, "store"), scratch_path(spark, "cells")
    conform(monthly_grid(spark, sf_dir)).write.parquet(gridded)
    cells = spark.read.parquet(gridded)  # every batch reads it several times

    def version(number: int, kept: str) -> DataFrame:
        return cells.filter(kept).withColumns({"sst": (F.col("sst") + number).cast("float"), "version": F.lit(number)})

    for batch in (
        version(1, "lat_idx % 2 = 0"),
        version(2, "lat_idx % 3 = 0"),
        version(1, "lat_idx % 5 > 0").unionByName(version(1, "lat_idx % 5 = 1")).unionByName(version(0, "lat_idx % 7 = 0")),
    ):
        st.write_merge(batch, store, ["version"])
    return wide(st.read_store(spark, store), "sst", "version")


def dedup_events(spark, sf_dir):
    source, out = scratch_path(spark, "events"), scratch_path(spark, "unique")
    parsed = parsed_events(spark, sf_dir)
    parsed.unionByName(parsed).write.parquet(source)
    stream = spark.readStream.schema(parsed.schema).parquet(source)
    finished(jobs.stream_dedup(stream, out, scratch_path(spark, "cp"), available_now=True))
    return spark.read.parquet(out).select("uri", "etag", "event_id")


def late_files(spark, sf_dir):
    listing = object_listing(spark, sf_dir).withColumn("file_time", names.noon_of(F.date_sub("last_modified", 3)))
    flagged = jobs.late_files(listing, F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"), MARK)
    return flagged.select("key", "file_time", "late", "polled")


def stream_daily_stats(spark, sf_dir):
    store, table_path = scratch_path(spark, "store"), scratch_path(spark, "stats")
    stream = _grid_stream(spark, sf_dir, 6)
    finished(jobs.stream_daily_stats(stream, store, table_path, scratch_path(spark, "cp"), available_now=True))
    kept = stats.running_mean(st.read_store(spark, table_path).drop("month"))
    return kept.select("time", "day_number", "daily_min", "daily_max", F.round("running_mean", 6).alias("running_mean"))


def poll_state(spark, sf_dir):
    state = scratch_path(spark, "marks")
    listing = object_listing(spark, sf_dir).select("key", "last_modified")
    ls.poll_state(spark, listing.filter(F.col("last_modified") < F.lit(MARK).cast("timestamp_ntz")), state, START)
    return ls.poll_state(spark, listing, state, START)


# --- functions over cells ----------------------------------------------------------------------------


def add_fingerprints_query(spark, sf_dir):
    return add_fingerprints(daily_grid(spark, sf_dir)).select(*KEY, "spatial_hash")


def _kelvin(sst: pd.Series) -> pd.Series:
    return sst.astype("float64") + 273.15


def apply_cellwise_query(spark, sf_dir):
    cells = mask_missing(daily_grid(spark, sf_dir), ["sst"])
    kelvin = apply_cellwise(cells, _kelvin, ["sst"], "kelvin")
    return kelvin.select(*KEY, F.round(null_if_missing("kelvin"), 6).alias("kelvin"))


QUERIES = {
    "discover_since": discover_since,
    "read_mark": read_mark,
    "advance_mark": advance_mark,
    "parse_object_events": parse_object_events,
    "filter_object_events": filter_object_events,
    "ingest_files": ingest_files,
    "read_store": read_store,
    "select_existing_files": select_existing_files,
    "write_create": write_create,
    "write_append": write_append,
    "write_upsert": write_upsert,
    "write_overwrite": write_overwrite,
    "store_summary": store_summary,
    "write_profile": write_profile,
    "ingest_with_status": ingest_with_status,
    "ingest_all_variables": ingest_all_variables,
    "poll_convert": poll_convert,
    "catalogue_has_time": catalogue_has_time,
    "ensure_zlev": ensure_zlev,
    "select_first_level": select_first_level,
    "select_time": select_time,
    "select_first_time": select_first_time,
    "point_by_index": point_by_index,
    "point_by_label": point_by_label,
    "select_variables": select_variables,
    "mask_missing": mask_missing_query,
    "fill_sentinel": fill_sentinel_query,
    "all_floating": all_floating,
    "squeeze": squeeze,
    "build_grid": build_grid,
    "expand_time": expand_time,
    "has_time": has_time,
    "drop_time": drop_time,
    "align_variables": align_variables,
    "attach_variable": attach_variable,
    "lookup_config": lookup_config,
    "reconcile_stats": reconcile_stats,
    "verify_fingerprints": verify_fingerprints,
    "compare_by_tiles": compare_by_tiles,
    "tile_digests": tile_digests,
    "daily_stats": daily_stats,
    "dataset_overview": dataset_overview,
    "array_shapes": array_shapes,
    "discovery_counts": discovery_counts,
    "ingest_metrics": ingest_metrics,
    "max_modified": max_modified,
    "running_mean": running_mean,
    "day_number": day_number,
    "running_components": running_components,
    "running_terms": running_terms,
    "components_of_days": components_of_days,
    "sort_by_time": sort_by_time,
    "sample_cells": sample_cells,
    "sample_verifiers": sample_verifiers,
    "first_last_time": first_last_time,
    "concat_time": concat_time,
    "upsert_logical": upsert_logical,
    "recenter_longitude": recenter_longitude,
    "file_date": file_date,
    "strip_suffix": strip_suffix,
    "noon_of": noon_of,
    "dotted_date": dotted_date,
    "to_utc": to_utc,
    "date_part": date_part,
    "format_day": format_day,
    "object_uri": object_uri,
    "cell_fingerprint": cell_fingerprint_query,
    "fingerprint_fallback": fingerprint_fallback_query,
    "empty_verifiers": empty_verifiers,
    "append_verifier": append_verifier,
    "append_verifier_to_store": append_verifier_to_store,
    "format_stat": format_stat,
    "json_text": json_text,
    "tile_ids": tile_ids,
    "pack_tiles": pack_tiles,
    "convert_tiles": convert_tiles,
    "unpack_tiles": unpack_tiles,
    "suggest_chunks": suggest_chunks,
    "profile_dataset": profile_dataset,
    "suggest_codec": suggest_codec,
    "profile_all_variables": profile_all_variables,
    "suggest_layout": suggest_layout,
    "stream_files": stream_files,
    "stream_convert": stream_convert,
    "stream_upsert": stream_upsert,
    "merge_versions": merge_versions,
    "dedup_events": dedup_events,
    "late_files": late_files,
    "stream_daily_stats": stream_daily_stats,
    "poll_state": poll_state,
    "add_fingerprints": add_fingerprints_query,
    "apply_cellwise": apply_cellwise_query,
}
