"""Token ids of a corpus in binary files: one array of ids, and Elias-Fano coded boundaries of the documents.

A file is the ids of its documents one after the other, then the boundaries and the document ids, both
Elias-Fano coded, then a footer of fixed size. Ids take two bytes where the vocabulary allows it, else four. A document is found
by selecting two boundaries and reading the bytes between; nothing else of the array is read.

Documents lie in ascending order of id over all files. The manifest, a table with a row per file, has their order
and the number of ids in each. Files that it does not name were left by tasks that were lost.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import stored
from tidegrid.llm.eliasfano import EliasFano
from tidegrid.llm.tokens import byte_encoder
from tidegrid.llm.warc import open_path
from tidegrid.operators.prefix import with_running_totals

MAGIC = b"TGTOKEN1"
# Documents, ids, documents without an id, smallest id, bytes per token id; of each coded list: low bits, words of
# low bits, words of high bits; magic.
FOOTER = "<QQQqI4x" + "I4xQQ" * 2 + "8s"
FOOTER_SIZE = struct.calcsize(FOOTER)
FILE_IDS, FILE_DOCUMENTS = 1 << 25, 1 << 22  # a file is closed when it holds so many
READ_DOCUMENTS, READ_IDS = 1 << 16, 1 << 22  # of one reading task, and at once
MANIFEST = "file string, task bigint, part bigint, documents bigint, ids bigint"
DOCUMENT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_FILE = pa.schema([("file", pa.string())] + [(name, pa.int64()) for name in ("task", "part", "documents", "ids")])
_DOCUMENT = ["doc_id", "start", "n_tokens", "ids_crc32"]


class TokenFile:
    """A file opened for reading; the ids stay where they are until asked for."""

    def __init__(self, path: str):
        files, inner = open_path(path)
        self.file = files.open_input_file(inner)
        size = self.file.size()
        footer = struct.unpack(FOOTER, self.file.read_at(FOOTER_SIZE, size - FOOTER_SIZE))
        if footer[-1] != MAGIC:
            raise ValueError(f"not a whole token file: {path}")
        self.documents, self.ids, self.nulls, self.smallest, self.width = footer[:5]
        lists = (footer[5:8], footer[8:11])
        at = size - FOOTER_SIZE - 8 * sum(low + high for _, low, high in lists)
        coded = []
        for count, (bits, low, high) in zip((self.documents + 1, self.documents - self.nulls), lists):
            words = np.frombuffer(self.file.read_at(8 * (low + high), at), "<u8")
            at += 8 * (low + high)
            coded.append(EliasFano.from_words(count, bits, words[:low], words[low:]))
        self.boundaries, self.names = coded

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        """The ids of the documents ``first`` to ``last - 1``; null ids come first in a file."""
        named = self.names[np.arange(max(first, self.nulls), max(last, self.nulls)) - self.nulls]
        return [None] * (min(last, self.nulls) - min(first, self.nulls)) + [int(x) + self.smallest for x in named]

    def tokens(self, begin: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def document(self, number: int) -> np.ndarray:
        """The token ids of one document."""
        begin, end = self.boundaries[[number, number + 1]].tolist()
        return self.tokens(begin, end)

    def close(self) -> None:
        self.file.close()

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *_) -> None:
        self.close()


class Writer:
    """One file being written; only the boundaries and ids of its documents are held in memory."""

    def __init__(self, folder: str, name: str, kind: str):
        self.files, root = open_path(folder)
        self.files.create_dir(root, recursive=True)
        self.place, self.out = f"{root}/{name}", None
        self.out = self.files.open_output_stream(self.place, compression=None)
        self.name, self.width = name, np.dtype(kind).itemsize
        self.ends, self.names, self.nulls = array("Q", [0]), array("q"), 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.ends.append(self.ends[-1] + len(ids) // self.width)
        if doc_id is None:
            self.nulls += 1
        else:
            self.names.append(doc_id)

    def full(self) -> bool:
        return self.ends[-1] >= FILE_IDS or len(self.ends) > FILE_DOCUMENTS

    def close(self) -> tuple[str, int, int]:
        names = np.frombuffer(self.names, np.int64) if self.names else np.zeros(0, np.int64)
        smallest = int(names[0]) if len(names) else 0
        # Differences of 64-bit numbers in unsigned arithmetic, which holds the widest of them.
        lists = [EliasFano.of(np.frombuffer(self.ends, np.uint64)), EliasFano.of(names.view(np.uint64) - np.array(smallest).astype(np.uint64))]
        for coded in lists:
            self.out.write(coded.low.tobytes() + coded.high.tobytes())
        sizes = [n for coded in lists for n in (coded.low_bits, len(coded.low), len(coded.high))]
        documents, ids = len(self.ends) - 1, self.ends[-1]
        self.out.write(struct.pack(FOOTER, documents, ids, self.nulls, smallest, self.width, *sizes, MAGIC))
        self.out.close()
        return self.name, documents, ids

    def discard(self) -> None:
        self.out.close()
        self.files.delete_file(self.place)


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    tasks: int | None = None,
) -> DataFrame:
    """Encode every text, put ``end_id`` behind it and write the ids below ``folder``; the manifest.

    A null text is empty: one id. Repeated rows and rows that share an id are documents each, one after the other, those
    with one id in the order of a hash of their texts; null ids come first. The names of special tokens in a text
    are read as such, as the tokenizer does by default. Other columns are ignored. An empty table gives no file.

    The texts are dealt out by ranges of id, hash and place, so rows that share an id are spread as well. A task writes
    its range text by text, in files of bounded size with names of their own. ``folder`` has to be one that
    every executor reaches through a file system that pyarrow knows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), F.asc("_hash"), F.asc("_row")]
    tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranges = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = byte_encoder(tokenizer_path), TaskContext.get().partitionId()
        end, done, writer = np.array([end_id], encoder.kind).tobytes(), [], None
        try:
            for batch in batches:
                for name, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                    if writer is None:
                        file = f"tokens-{task:06d}-{len(done):04d}-{uuid.uuid4().hex}.bin"
                        writer = Writer(folder, file, encoder.kind)
                    writer.add(name, ids + end)
                    if writer.full():
                        done.append(writer.close())
                        writer = None
            if writer is not None:
                done.append(writer.close())
                writer = None
        except BaseException:
            if writer is not None:
                writer.discard()
            raise
        rows = [(file, task, part, documents, ids) for part, (file, documents, ids) in enumerate(done)]
        yield pa.RecordBatch.from_pylist([dict(zip(_FILE.names, row)) for row in rows], schema=_FILE)

    return stored(ranges.mapInArrow(written, MANIFEST), "token-files")


def read_documents(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of the files of a manifest, read from the files.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is taken over ids of four bytes whatever the
    file has. A task reads a number of documents of one file, so a large file is read by several; rows come in
    no order.
    """
    upto = with_running_totals(manifest, "part", {"_upto": F.col("ids")}, block=F.col("task"))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("documents") - 1, F.lit(READ_DOCUMENTS).cast("bigint")))
    pieces = upto.select("file", (F.col("_upto") - F.col("ids")).alias("base"), first.alias("first"))
    pieces = pieces.repartition(spark.sparkContext.defaultParallelism * 4, "file", "first")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                with TokenFile(f"{folder}/{piece['file']}") as tokens:
                    last = min(piece["first"] + READ_DOCUMENTS, tokens.documents)
                    bounds = tokens.boundaries[np.arange(piece["first"], last + 1)].astype(np.int64)
                    names = tokens.doc_ids(piece["first"], last)
                    sums: list[int] = []
                    while len(sums) < len(names):
                        begin = len(sums)
                        # As many documents as fit, one at least.
                        stop = int(np.searchsorted(bounds, bounds[begin] + READ_IDS, side="right")) - 1
                        stop = max(begin + 1, stop)
                        raw = tokens.tokens(int(bounds[begin]), int(bounds[stop])).astype("<u4").tobytes()
                        places = ((bounds[begin : stop + 1] - bounds[begin]) * 4).tolist()
                        sums.extend(zlib.crc32(raw[a:b]) for a, b in zip(places, places[1:]))
                    columns = [
                        pa.array(names, pa.int64()),
                        pa.array(bounds[:-1] + piece["base"]),
                        pa.array(np.diff(bounds)),
                        pa.array(sums, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, _DOCUMENT)

    return pieces.mapInArrow(read, DOCUMENT)
