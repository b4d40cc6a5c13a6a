"""Web archives: writing pages as gzip members, one per record, and reading them back in byte ranges.

A reading task gets a range of bytes of a file. It looks for the magic bytes of a gzip member, decodes what
follows and takes it for a record only if a complete archive record comes out. The task owns the
records that start in its range, and reads on past its end to finish the last of them. So a large
archive is read by many tasks and needs no index.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = b"\x1f\x8b\x08"
SPLIT = 16 << 20
READ = 1 << 20
URN = "urn:record:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # of every record: a page carries no time
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RECORD = (
    "record_id string, record_type string, target_uri string, payload_digest string, payload_bytes bigint, "
    "refers_to string, payload binary"
)


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI that all executors share, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(value: str | None) -> str | None:
    """A header value without line ends; None if there is nothing left."""
    return "".join(value.split("\r")).replace("\n", "").strip() or None if value else None


def member(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    lines.append(f"Content-Length: {len(block)}")
    record = ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def page_record(page_id, url, payload: bytes, refers_to) -> bytes:
    http = HTTP.format(len(payload)).encode()
    revisit = refers_to is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", plain(url)),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<{URN}{refers_to}>" if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    return member(headers, http if revisit else http + payload)


def with_originals(
    pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, html, refers_to``: the smallest page with an equal payload, null for that page itself.

    Only ids and hashes meet in the groups; the texts are moved once, spread by page. Payloads of fewer than
    ``min_bytes`` refer to nothing. A null text is an empty payload. A null id refers to the group's smallest id
    and is never referred to; rows that repeat the smallest id refer to nothing.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    keys = rows.select("page_id", F.sha2("html", 256).alias("key")).filter(F.octet_length("html") >= min_bytes)
    first = keys.groupBy("key").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("pages"))
    later = keys.distinct().join(first.filter("pages > 1"), "key").filter("not (page_id <=> refers_to) and refers_to is not null")
    later = later.select("page_id", "key", "refers_to")
    # A page id may come with several texts, hence the hash in the key.
    rows = rows.withColumn("key", F.sha2("html", 256))
    same = rows["page_id"].eqNullSafe(later["page_id"]) & (rows["key"] == later["key"])
    return rows.join(later, same, "left").select(rows["page_id"], "url", "html", "refers_to")


def write_archives(pages: DataFrame, path: str) -> DataFrame:
    """Write rows of ``with_originals`` as one archive per task into the folder ``path``; the files and their records.

    A file is written under a name of its own and then renamed, so a task that is run again replaces what an
    earlier run left, and a lost one leaves nothing that is read. ``path`` has to be a folder that the driver and every
    executor reach through a file system that pyarrow knows; it is there, and empty, when there is no page.
    """
    files, root = open_path(path)
    files.create_dir(root, recursive=True)

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        files, root = open_path(path)
        files.create_dir(root, recursive=True)
        part, count = f"{root}/_{name}.{uuid.uuid4().hex}", 0
        with files.open_output_stream(part, compression=None) as out:
            for batch in batches:
                columns = [batch[c].astype(object) for c in ("page_id", "url", "html", "refers_to")]
                for page_id, url, html, refers_to in zip(*columns):
                    ids = [None if pd.isna(x) else int(x) for x in (page_id, refers_to)]
                    out.write(page_record(ids[0], url, html.encode(), ids[1]))
                    count += 1
        if count:
            files.move(part, f"{root}/{name}")
        else:
            files.delete_file(part)
        yield pd.DataFrame({"file": [name], "records": [count]})

    done = pages.mapInPandas(written, "file string, records bigint")
    return done


class Ranged:
    """Bytes of a file from some place on, read a piece at a time."""

    def __init__(self, file, start: int):
        self.file, self.base, self.data, self.ended = file, start, b"", False

    def more(self) -> bool:
        if not self.ended:
            self.file.seek(self.base + len(self.data))
            piece = self.file.read(READ)
            self.data += piece
            self.ended = not piece
        return not self.ended

    def drop(self, count: int) -> None:
        self.data, self.base = self.data[count:], self.base + count

    def find_magic(self, end: int) -> bool:
        """Move to the next magic bytes that begin before ``end``."""
        while True:
            at = self.data.find(MAGIC)
            if at >= 0:
                self.drop(at)
                return self.base < end
            self.drop(max(0, len(self.data) - len(MAGIC) + 1))
            if self.base >= end or not self.more():
                return False

    def member(self) -> tuple[bytes, int] | None:
        """The decoded gzip member here and its size; None if it isn't one that holds a record."""
        unpacker, out, taken = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if taken == len(self.data) and not self.more():
                return None
            try:
                out.append(unpacker.decompress(self.data[taken:]))
            except zlib.error:
                return None
            taken = len(self.data)
            if len(out) == 1 and not out[0][:5] == b"WARC/"[: len(out[0][:5])]:
                return None
        return b"".join(out), taken - len(unpacker.unused_data)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers (lower-case names) and block of a record; None unless it is whole."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        return None
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isdigit() or "warc-type" not in headers or rest[int(length) :] != b"\r\n\r\n":
        return None
    return headers, rest[: int(length)]


def records_of(file, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records that start in the bytes ``start`` to ``end`` of a file."""
    data = Ranged(file, start)
    while data.find_magic(end):
        found = data.member()
        record = parse_record(found[0]) if found else None
        if record is None:
            data.drop(1)
        else:
            yield record
            data.drop(found[1])


def bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def read_archives(spark: SparkSession, path: str, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """A row per record of the ``*.warc.gz`` files under ``path``.

    The payload is what follows the HTTP headers of a response, else the whole block; its digest is computed from it
    and has to agree with the record's own, or the read fails. A revisit has no payload: its digest is what its record
    says and its size null. A record must fit in a task's memory.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true")
    files = listed.load(path).select("path", "length")
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split).cast("bigint")))
    ranges = files.select("path", start.alias("start"))
    ranges = ranges.repartition(spark.sparkContext.defaultParallelism * 4, "path", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for file_path, begin in zip(batch["path"], batch["start"]):
                files, inner = open_path(file_path)
                rows, size = [], 0
                with files.open_input_file(inner) as file:
                    for headers, block in records_of(file, int(begin), int(begin) + split):
                        row = record_row(headers, block, payloads)
                        rows.append(row)
                        size += len(row[-1] or b"")
                        if len(rows) >= 10_000 or size > 16 << 20:
                            yield pd.DataFrame(rows, columns=names, dtype=object)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names, dtype=object)

    return ranges.mapInPandas(read, RECORD)


def record_row(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind, said = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload, size = None, None
    if kind != "revisit":
        payload = block.partition(b"\r\n\r\n")[2] if "application/http" in headers.get("content-type", "") else block
        size, own = len(payload), digest_of(payload)
        if said is not None and said != own:
            raise ValueError(f"digest of {headers.get('warc-record-id')} is {own}, not {said}")
        said = own
    return (
        bare(headers.get("warc-record-id")),
        kind,
        headers.get("warc-target-uri"),
        said,
        size,
        bare(headers.get("warc-refers-to")),
        payload if payloads else None,
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with the payload size of revisits taken from the response they refer to.

    Responses with one record id count once. A revisit of a record that isn't there keeps a null size.
    """
    plain_rows = records.filter("record_type <> 'revisit'")
    sizes = (
        plain_rows.filter("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("size"))
    )
    revisits = records.filter("record_type = 'revisit'").join(sizes, ["refers_to", "payload_digest"], "left")
    revisits = revisits.withColumn("payload_bytes", F.coalesce("payload_bytes", "size")).select(records.columns)
    return plain_rows.unionByName(revisits)


def page_of(record_id: Column) -> Column:
    """The page id in a record id of ``write_archives``; null for a page without one."""
    return F.nullif(F.regexp_replace(record_id, f"^{URN}", ""), F.lit("")).cast("bigint")
