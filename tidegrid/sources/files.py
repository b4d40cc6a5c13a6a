"""Daily grid files to rows."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from datetime import time as clock
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.missing import null_if_missing
from tidegrid.functions.names import base_name, file_date, noon_of
from tidegrid.model import VARIABLES, conform
from tidegrid.session import broadcast_if_small

# What a decoder may return; absent columns become NULL. ``zlev`` is level 1 when absent.
DECODED = T.StructType(
    [
        T.StructField("source_time", T.TimestampNTZType()),
        T.StructField("zlev", T.IntegerType()),
        T.StructField("lat_idx", T.IntegerType()),
        T.StructField("lon_idx", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        *[T.StructField(v, T.FloatType()) for v in VARIABLES],
    ]
)
STATUS = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("cells", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)
FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("file_time", T.TimestampNTZType()),
    ]
)
ROWS_PER_BATCH = 65536
BIN_BYTES = 32 * 1024 * 1024
TASKS_PER_CORE = 8  # up to so many files for each core have a task of their own
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"

ENTRY = "path string, kind string, name string, type string, attributes map<string,string>"
FACTS = "path string, modificationTime timestamp, length bigint"

Decoder = Callable[[bytes], pd.DataFrame]
Opener = Callable[[str], bytes]


def shared_path(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI as Spark lists it, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if scheme == "file" and not rest.startswith("//"):
        return pafs.FileSystem.from_uri(rest)
    if not colon:
        return pafs.FileSystem.from_uri(path)
    # Spark shows names as they are; a URI has other than plain characters escaped.
    return pafs.FileSystem.from_uri(quote(f"s3:{rest}" if scheme in ("s3a", "s3n") else path, safe=":/@"))


def read_whole(path: str) -> bytes:
    """The bytes of a file, read by the task that needs them."""
    files, inner = shared_path(path)
    with files.open_input_stream(inner, compression=None) as file:
        return file.read()


def file_facts(files: DataFrame) -> DataFrame:
    """``path, modificationTime, length`` of files of which only the path is known, e.g. from events; asked for in tasks.

    A file that is not there has NULL in both and fails when it is decoded.
    """

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                system, inner = shared_path(path)
                info = system.get_file_info(inner)
                rows.append((path, info.mtime, info.size))
            facts = pd.DataFrame(rows, columns=["path", "modificationTime", "length"])
            yield facts.assign(modificationTime=pd.to_datetime(facts["modificationTime"], utc=True), length=facts["length"].astype("Int64"))

    return files.select("path").distinct().mapInPandas(asked, FACTS)


def binary_files(spark: SparkSession, paths: str | list[str], glob: str = "*.nc") -> DataFrame:
    """Whole files as rows ``path, modificationTime, length, content``; unread columns cost nothing."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.load(paths)


def modified_since(files: DataFrame, mark: DataFrame) -> DataFrame:
    """Files modified on or after the date of a mark.

    The bound is a literal on the plain column, which the source applies before it opens a file.
    """
    date = mark.first().mark.date()
    return files.filter(F.col("modificationTime") >= F.lit(datetime.combine(date, clock(), timezone.utc)))


def ensure_zlev(df: DataFrame) -> DataFrame:
    """Level 1 where the source has no level axis."""
    return df if "zlev" in df.columns else df.withColumn("zlev", F.lit(1))


def select_existing_files(requested: DataFrame, listing: DataFrame, on: str = "key") -> DataFrame:
    """Requested files with ``found`` telling whether the listing has them; nothing is dropped."""
    present = listing.select(on).distinct().withColumn("_present", F.lit(True))
    joined = requested.join(present, on, "left")
    return joined.select(*requested.columns, F.col("_present").isNotNull().alias("found"))


def superseded(files: DataFrame) -> DataFrame:
    """Files that a later one of the same time step replaces, e.g. preliminary by final ones."""
    dated = files.select(*FILE.fieldNames()).filter(F.col("file_time").isNotNull())
    newest = F.max_by("path", F.struct("modificationTime", "path"))
    latest = dated.groupBy("file_time").agg(newest.alias("_latest"), F.count("*").alias("_n")).filter("_n > 1")
    return dated.join(latest, "file_time").filter(F.col("path") != F.col("_latest")).select("path")


def latest_per_time(files: DataFrame) -> DataFrame:
    """One file per time step: the one modified last.

    Decided on names and dates before any file is read. Only the superseded files, usually few, take
    part in the final anti-join, so file contents are not shuffled.
    """
    return files.join(broadcast_if_small(superseded(files)), "path", "left_anti")


def with_file_time(files: DataFrame, suffix: str = "", name: Column | None = None) -> DataFrame:
    """Add ``file_time``: noon of the date in the file name, NULL when there is none."""
    named = base_name("path") if name is None else name
    return files.withColumn("file_time", noon_of(file_date(named, suffix)))


def _contents(batch: pd.DataFrame, opener: Opener) -> Iterator[tuple]:
    """The columns of ``FILE`` and a function that gives the bytes, for each file of a batch."""
    for i, file in enumerate(batch[FILE.fieldNames()].itertuples(index=False)):
        if "content" in batch.columns:
            yield file, lambda i=i: bytes(batch["content"].iloc[i])
        else:
            yield file, lambda path=file.path: opener(path)


def _decode_files(
    decode: Decoder, on_error: str, extra: Sequence[str], opener: Opener
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    columns = [*DECODED.fieldNames(), *extra]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (path, modified, file_time), content in _contents(batch, opener):
                started = time.monotonic()
                file = {"path": path, "modificationTime": modified, "file_time": file_time}
                status, error, found, absent = "ok", None, None, {}
                try:
                    if pd.isna(file_time):
                        raise ValueError(f"no valid date in the form .YYYYMMDD. in file name: {path}")
                    found = decode(content())
                    unknown = sorted(set(found.columns) - set(columns))
                    if unknown:
                        found = None
                        raise ValueError(f"variables that were not declared: {', '.join(unknown)}")
                    absent = {c: 1 if c == "zlev" else None for c in columns if c not in found.columns}
                except Exception as failure:
                    if on_error == "raise":
                        raise
                    status, error = "failed", "".join(traceback.format_exception_only(failure)).strip()
                # Columns are added piece by piece, and a file is let go of before the next one is decoded: the whole frame is
                # there once, as the decoder made it.
                count = 0 if found is None else len(found)
                for start in range(0, count, ROWS_PER_BATCH):
                    piece = found.iloc[start : start + ROWS_PER_BATCH].reset_index(drop=True)
                    yield piece.assign(**absent)[columns].assign(**file, **dict.fromkeys(STATUS.fieldNames()))
                found = piece = None
                pa.default_memory_pool().release_unused()
                report = pd.DataFrame([dict.fromkeys(columns)])
                yield report.assign(
                    **file, status=status, error=error, cells=count, seconds=time.monotonic() - started
                )

    return run


def _spark_type(kind: pa.DataType) -> str:
    if pa.types.is_boolean(kind):
        return "boolean"
    if pa.types.is_integer(kind):
        return {8: "tinyint", 16: "smallint", 32: "int"}.get(kind.bit_width, "bigint")
    if pa.types.is_floating(kind):
        return "double" if kind.bit_width == 64 else "float"
    if pa.types.is_timestamp(kind):
        return "timestamp_ntz"
    return "date" if pa.types.is_date(kind) else "string"


def describe_files(files: DataFrame, decode: Decoder, opener: Opener = read_whole, on_error: str = "raise") -> DataFrame:
    """What each file says of itself: ``path, kind, name, type, attributes``.

    One row for the dataset, one for each coordinate and one for each variable. Attributes come from the ``attrs`` of
    the decoded frame: those of the dataset, and under ``variables`` those of each column. Files are
    decoded in tasks; only this table leaves them. With ``on_error='continue'`` a file that cannot be read says nothing.
    """
    axes = {"lat", "lon", "lat_idx", "lon_idx", "zlev", "source_time"}

    def texts(attributes) -> dict[str, str]:
        return {str(k): str(v) for k, v in dict(attributes or {}).items() if k != "variables"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (path, _, _), content in _contents(batch, opener):
                try:
                    cells = decode(content())
                except Exception:
                    if on_error == "raise":
                        raise
                    continue
                of_column = cells.attrs.get("variables", {})
                rows = [(path, "dataset", None, None, texts(cells.attrs))]
                for name in cells.columns:
                    kind = _spark_type(pa.array(cells[name], from_pandas=True).type)
                    rows.append((path, "coordinate" if name in axes else "variable", name, kind, texts(of_column.get(name))))
                yield pd.DataFrame(rows, columns=["path", "kind", "name", "type", "attributes"])

    kept = [c for c in (*FILE.fieldNames(), "content") if c in files.columns]
    for field in FILE.fields:
        if field.name not in kept:
            files = files.withColumn(field.name, F.lit(None).cast(field.dataType))
    return files.select(*FILE.fieldNames(), *[c for c in kept if c == "content"]).mapInPandas(run, ENTRY)


def further_variables(described: DataFrame) -> T.StructType:
    """The variables of described files that ``DECODED`` does not have, each in a type that holds it in all of them."""
    rows = described.filter("kind <> 'dataset'").groupBy("name").agg(F.sort_array(F.collect_set("type")).alias("types")).collect()
    columns = []
    for row in sorted(rows):
        if row.name not in DECODED.fieldNames():
            numbers = set(row.types) <= {"tinyint", "smallint", "int", "bigint", "float", "double"}
            kind = row.types[0] if len(row.types) == 1 else "double" if numbers else "string"
            columns.append(f"`{row.name.replace('`', '``')}` {kind}")
    return T.StructType.fromDDL(", ".join(columns)) if columns else T.StructType()


def decode_files(
    files: DataFrame,
    decode: Decoder,
    on_error: str = "continue",
    extra: T.StructType | str | int = 1,
    opener: Opener = read_whole,
) -> DataFrame:
    """Cells of all files plus one report row per file (``status`` not NULL).

    One file is decoded by one task. A failing file gives a report row and no cells, or with ``on_error='raise'`` fails the
    job. ``files`` has contents, or only paths, which a task opens with ``opener`` when it comes to them.

    ``extra`` declares the variables beyond ``DECODED``, or is the number of files in which to look for them first. A file
    that has others as well fails: no variable is left out in silence.
    """
    if isinstance(extra, str):
        extra = T.StructType.fromDDL(extra)
    if not isinstance(extra, T.StructType):
        extra = discovered(files, decode, extra, opener)
    schema = T.StructType([*DECODED.fields, *extra.fields, *FILE.fields, *STATUS.fields])
    columns = [*FILE.fieldNames(), *[c for c in files.columns if c == "content"]]
    return files.select(*columns).mapInPandas(_decode_files(decode, on_error, extra.fieldNames(), opener), schema)


def discovered(files: DataFrame, decode: Decoder, count: int, opener: Opener = read_whole) -> T.StructType:
    """The variables beyond ``DECODED`` in some of the files. One that cannot be read tells nothing; it is reported when it is decoded."""
    return further_variables(describe_files(files.limit(count), decode, opener, "continue"))


def in_bins(files: DataFrame, bin_bytes: int | None = None) -> DataFrame:
    """``files(path, length, ...)`` dealt out so that a task gets about ``bin_bytes`` of them, and any file whole.

    Without ``bin_bytes`` a task gets ``BIN_BYTES``, or less where files are few: they are dealt out to all cores, however small
    they are, since what a file holds can be many times its length and cells stay in the task that decoded them. Ranges of paths
    are even in number, whereas a hash would leave some tasks with several of few files.
    """
    total = files.agg(F.sum("length").alias("bytes"), F.count("*").alias("files")).first()
    least = 1 if bin_bytes else TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism
    bins = max(1, min(total.files, max(least, -(-(total.bytes or 0) // (bin_bytes or BIN_BYTES)))))
    return files.repartitionByRange(bins, "path")


def decoded_cells(decoded: DataFrame) -> DataFrame:
    """The cells of :func:`decode_files` as a grid keyed on the time of the file name.

    The file's own time is kept as ``source_time``.
    """
    cells = decoded.filter(F.col("status").isNull())
    grid = cells.withColumns(
        {"time": F.col("file_time"), "source_uri": F.col("path"), "day": F.to_date("file_time")}
    )
    return grid.drop(*FILE.fieldNames(), *STATUS.fieldNames())


def decoded_status(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("status").isNotNull()).select(*FILE.fieldNames(), *STATUS.fieldNames())


@dataclass
class Ingested:
    """Grid and status table of one decoding pass; call ``release`` when both have been written."""

    grid: DataFrame
    status: DataFrame
    decoded: list[DataFrame]

    def release(self) -> None:
        for part in self.decoded:
            part.unpersist()


def ingest_with_status(
    files: DataFrame,
    decode: Decoder,
    on_error: str = "continue",
    extra: T.StructType | str | int = 1,
    opener: Opener = read_whole,
) -> Ingested:
    """Decode files into a grid and a status table, no file twice.

    Of several files of one time step the last one that can be decoded counts. That is chosen by name and date before anything is
    decoded; only where it fails are the others of its step decoded, too. The others have the status ``superseded``, without a
    number of cells if they were not opened. The decoded rows are kept on executor disks between grid and status; a lost
    executor's files are decoded again.
    """
    if isinstance(extra, int):
        extra = discovered(files, decode, extra, opener)
    older = broadcast_if_small(superseded(files))
    decoded = decode_files(files.join(older, "path", "left_anti"), decode, on_error, extra, opener).persist(StorageLevel.DISK_ONLY)
    kept = [decoded]
    try:
        report = decoded_status(decoded)
        replaced = older.limit(0)
        unopened = files.select(*FILE.fieldNames()).join(older, "path", "left_semi")
        if not older.isEmpty():
            failed = broadcast_if_small(report.filter("status = 'failed'").select("file_time").distinct())
            again = files.join(older, "path", "left_semi").join(failed, "file_time", "left_semi")
            second = decode_files(again, decode, on_error, extra, opener).persist(StorageLevel.DISK_ONLY)
            kept.append(second)
            decoded, report = decoded.unionAll(second), report.unionAll(decoded_status(second))
            unopened = unopened.join(failed, "file_time", "left_anti")
            replaced = broadcast_if_small(superseded(report.filter("status = 'ok'")))
        cells = decoded_cells(decoded.join(replaced, "path", "left_anti"))
    except Exception:
        for part in kept:
            part.unpersist()
        raise
    flagged = report.join(replaced.withColumn("_replaced", F.lit(True)), "path", "left")
    status = flagged.withColumn("status", F.when(F.col("_replaced"), "superseded").otherwise(F.col("status"))).select(*report.columns)
    status = status.unionByName(unopened.withColumn("status", F.lit("superseded")), allowMissingColumns=True)
    return Ingested(conform(cells), status, kept)


def ingest_files(
    spark: SparkSession,
    paths: str | list[str],
    decode: Decoder | None = None,
    suffix: str = "",
    glob: str | None = None,
    name: Column | None = None,
    extra: T.StructType | str | int = 1,
) -> DataFrame:
    """Grid rows of daily files, with all their variables (``extra`` as in :func:`decode_files`).

    Without a decoder the files are Parquet grids and Spark reads them column by column; with one,
    ``decode(bytes)`` turns a whole binary file into a pandas DataFrame on the executors. The time is
    noon of the date in the file name; ``name`` overrides which part of ``path`` is the name. Of several
    files of one time step the one modified last counts.
    """
    if decode is not None:
        files = with_file_time(binary_files(spark, paths, glob or "*.nc"), suffix, name)
        return conform(decoded_cells(decode_files(latest_per_time(files), decode, "raise", extra)))
    # Files need not have the same variables.
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    grid = (reader.option("pathGlobFilter", glob) if glob else reader).parquet(paths)
    path, modified = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    grid = grid.select("*", path.alias("path"), modified.alias("modificationTime"))
    named = base_name("path") if name is None else name
    time_of_name = noon_of(file_date(named, suffix, on_error="raise"))
    own_time = [F.col("time").alias("source_time")] if "time" in grid.columns else []
    columns = [c for c in grid.columns if c not in ("time", "day", "path", "modificationTime", "source_uri")]
    # The parts of a folder that carries the name are one file: a path counts up to the name.
    rest = F.call_function("substring_index", F.col("path"), named, F.lit(-1))
    grid = grid.withColumn("_file", F.left("path", F.length("path") - F.length(rest)))
    parts = with_file_time(grid.select("_file", "path", "modificationTime").distinct(), suffix, name)
    whole = parts.groupBy(F.col("_file").alias("path")).agg(
        F.max("modificationTime").alias("modificationTime"), F.max("file_time").alias("file_time")
    )
    replaced = broadcast_if_small(superseded(whole).withColumnRenamed("path", "_file"))
    dated = grid.join(replaced, "_file", "left_anti").select(*columns, *own_time, time_of_name.alias("time"), F.col("path").alias("source_uri"))
    return conform(ensure_zlev(dated))


def time_mismatches(files_or_cells: DataFrame) -> DataFrame:
    """Files whose own time differs from the time of their name, with the number of such cells."""
    differs = F.col("source_time").isNotNull() & (F.col("source_time") != F.col("time"))
    return files_or_cells.filter(differs).groupBy("source_uri", "time", "source_time").agg(F.count("*").alias("cells"))


def ingest_metrics(df: DataFrame, name: str = "ingest", variable: str = "sst"):
    """``(df, observation)``: row counts gathered while ``df`` is written, without a second pass."""
    observation = Observation(name)
    total, valid = F.count(F.lit(1)), F.count(null_if_missing(variable))
    return df.observe(observation, total.alias("cells"), valid.alias("valid_cells")), observation


def status_totals(status: DataFrame) -> DataFrame:
    """Files and cells done, per cent of files done, total and average seconds per file."""
    ok = F.col("status") == "ok"
    return status.agg(
        F.count("*").alias("files"),
        F.count_if(ok).alias("files_ok"),
        F.round(100.0 * F.count_if(ok) / F.count("*"), 1).alias("percent_ok"),
        F.coalesce(F.sum("cells"), F.lit(0)).alias("cells"),
        F.sum("seconds").alias("total_seconds"),
        F.avg("seconds").alias("average_seconds"),
    )
