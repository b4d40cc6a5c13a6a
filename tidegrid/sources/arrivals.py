"""A stream of the files in a folder that keeps nothing in the driver.

Every batch lists the folder again, in tasks, and a keyed state in the state store drops the versions of files that came before. So
what the driver holds does not grow with the files seen, and a file is taken however late it comes, and again when it
is replaced.
"""

from __future__ import annotations

import fnmatch
import json
import time
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidegrid.sources.files import FACTS, shared_path

LISTED_AT_ONCE = 10_000


class Folder(InputPartition):
    def __init__(self, path: str, until: int):
        self.path, self.until = path, until


class ListingReader(DataSourceStreamReader):
    """Batches are spans of time; a batch lists every file modified before its end, whatever its start."""

    def __init__(self, options: dict):
        self.path, self.glob = options["path"].rstrip("/"), options.get("glob", "*")
        self.folders = json.loads(options.get("folders", "[]"))

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        return {"until": time.time_ns() // 1000}

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        return [Folder(f"{self.path}/{name}" if name else self.path, end["until"]) for name in self.folders or [""]]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        files, inner = shared_path(partition.path)
        scheme, colon, _ = partition.path.partition("://")
        before = "file:" if not colon or scheme == "file" else f"{scheme}://"
        found = []
        for info in files.get_file_info(pafs.FileSelector(inner, recursive=True, allow_not_found=True)):
            modified = (info.mtime_ns or 0) // 1000
            if info.type == pafs.FileType.File and fnmatch.fnmatch(info.base_name, self.glob) and modified <= partition.until:
                found.append((before + info.path, modified, info.size))
                if len(found) == LISTED_AT_ONCE:
                    yield self.batch(found)
                    found = []
        if found:
            yield self.batch(found)

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        path, modified, length = zip(*rows)
        columns = [pa.array(path), pa.array(modified, pa.timestamp("us", "UTC")), pa.array(length, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["path", "modificationTime", "length"])

    def commit(self, end: dict) -> None:
        pass


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidegrid_listing"

    def schema(self) -> str:
        return FACTS

    def streamReader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def stream_arrivals(spark: SparkSession, path: str, glob: str = "*.nc", folders: Sequence[str] = ()) -> DataFrame:
    """Each version of each file below ``path`` once, as ``path, modificationTime, length``; contents are not part of it.

    One task lists all of ``path``, or one each of its sub-folders ``folders``. A version is a path and the time it was
    modified; the ones taken are kept in the state store, one small row each, and in the checkpoint.
    """
    spark.dataSource.register(Listing)
    reader = spark.readStream.format(Listing.name()).option("glob", glob).option("folders", json.dumps(list(folders)))
    return reader.load(path).dropDuplicates(["path", "modificationTime"])
