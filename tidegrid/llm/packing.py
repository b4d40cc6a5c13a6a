"""Packing documents into token sequences of a fixed size, best fit, merged in a tree.

Every task packs the pieces it tokenized itself, longest first, each into the fullest bin that takes it. Bins
that are nearly full are done. The others become items of the next round, where the bins of several tasks are
packed together in one task in the same way, and so on up a tree. Only underfull bins travel, as numbers.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import stored

SIZE = 2048
SLACK = 8  # a bin with at most so many free tokens is done
FAN_IN = 8  # tasks whose underfull bins meet in one task of the next round
MOST = 400_000  # items that one task packs at once; a task with more packs them in several lots
MEMO, MEMO_CHARS = 1_000_000, 40  # parts of texts a process remembers, and the longest of them
MARKS = ".,;:!?*$%&#|()[]{}<>=+-/\"_~^@"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder(dict):
    """Token ids of texts as little-endian 32-bit bytes; a dictionary of the parts it has met.

    Only for tokenizers that drop white space, never look past it and read ASCII letters in lower case, as
    word-level BPE does. Then the ids of a text are those of its parts between spaces, tabs and line ends, one
    after the other, and a part that is letters with punctuation behind has the ids of the two.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)

    def ids(self, part: str) -> bytes:
        if part.isascii() and part.isalpha() and part.islower():  # one word to the tokenizer, and spelled as its bytes
            found = [token.id for token in self.tokenizer.model.tokenize(part)]
        else:
            found = self.tokenizer.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def __missing__(self, part: str) -> bytes:
        word = part.rstrip(MARKS)
        # Only of ASCII words is it certain how the tokenizer lowers them and that punctuation behind stays apart.
        if word.isascii() and word.isalpha() and word.lower() != part:
            found = self[word.lower()] + self[part[len(word) :]]
        else:
            found = self.ids(part)
        if len(part) <= MEMO_CHARS:
            self[part] = found
        return found

    def encode(self, text: str) -> bytes:
        if len(self) > MEMO:
            self.clear()
            self[""] = b""
        parts = text.replace("\n", " ").replace("\t", " ").split(" ")
        return b"".join(map(self.__getitem__, parts))


def encoder(path: str) -> Encoder:
    """The encoder of this Python process: tasks that run in it one after the other share what it has met."""
    import tokenizers

    known = vars(tokenizers).setdefault("_encoders_by_path", {})
    if path not in known:
        known[path] = Encoder(path)
    return known[path]


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each item the number of its bin and its place there, and how many bins there are.

    Items are taken longest first; each goes into the bin with the least room that is enough. A set of
    bits says which amounts of room exist, so a bin is found without a search.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, count = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_ = size, count
            count += 1
        bins[i], places[i] = bin_, size - room
        left = room - length
        if left:
            with_room[left].append(bin_)
            rooms |= 1 << left
    return bins, places, count


def pack_locally(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = 0) -> DataFrame:
    """The pieces of every document, each in a bin of the task that read it.

    Adds ``bin`` (task and number) and ``place``. A task holds five numbers for each of its pieces, never texts.
    """

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, end = encoder(tokenizer_path), np.array([end_id], dtype="<u4").tobytes()
        first = TaskContext.get().partitionId() << 32
        lot: list[tuple] = []

        def bins() -> pd.DataFrame:
            nonlocal first
            out = pd.DataFrame(lot, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            number, place, count = best_fit(out["length"].to_numpy(np.int64), size)
            out["bin"], out["place"] = number + first, place
            first += count
            lot.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = ids_of.encode(text or "") + end
                for piece, start in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[start : start + 4 * size]
                    lot.append((None if pd.isna(doc_id) else int(doc_id), piece, start // 4, len(part) // 4, zlib.crc32(part)))
            if len(lot) >= MOST:
                yield bins()
        if lot:
            yield bins()

    return docs.mapInPandas(packed, f"{PIECES}, bin bigint, place bigint")


def merge_round(bins: DataFrame, group, size: int) -> DataFrame:
    """Pack underfull bins (``bin, task, fill``) as items: ``bin, task, fill, parent, place``."""

    def merged(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["fill", "bin"]).reset_index(drop=True)
        number, place, _ = best_fit(items["fill"].to_numpy(np.int64), size)
        # A merged bin is called after its first member.
        items["parent"] = items["bin"].groupby(number).transform("min")
        items["place"] = place
        return items.drop(columns="group")

    schema = "bin bigint, task bigint, fill bigint, parent bigint, place bigint"
    return bins.withColumn("group", group).groupBy("group").applyInPandas(merged, schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    end_id: int = 0,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every document.

    A document is its token ids and then ``end_id``; one of more than ``size`` tokens is cut into pieces of
    ``size``, of which the last may be shorter, others stay whole. A null text is empty: one token. Repeated rows
    and null ids are documents like others. The numbers of sequences have gaps. Other columns are ignored.

    A merging task takes the underfull bins of FAN_IN tasks, and fewer when these hold over MOST bins, so that its
    memory does not grow with the corpus. Rounds end when all tasks have met, or when a round saves less
    than one bin in a hundred.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = stored(pack_locally(rows, tokenizer_path, size, end_id), "pack-pieces")
    open_bins = (
        pieces.groupBy("bin").agg(F.sum("length").alias("fill")).filter(F.col("fill") < size - SLACK)
        .select("bin", F.shiftright("bin", 32).alias("task"), "fill")
    )
    found = pieces.withColumn("offset", F.col("place")).drop("place")
    span = FAN_IN
    while True:
        open_bins = stored(open_bins, "pack-open")
        about = open_bins.agg(F.count(F.lit(1)), F.max("task"), F.countDistinct("task")).first()
        count, last, tasks = about
        if not count or not tasks:
            break
        # So many groups in each span of tasks that none holds more than MOST bins on average.
        spans = last // span + 1
        lots = max(1, -(-count // (spans * MOST)))
        group = F.floor(F.col("task") / span) * lots + F.pmod(F.xxhash64("bin"), F.lit(lots))
        merged = stored(merge_round(open_bins, group, size), "pack-round")
        moves = merged.filter("bin <> parent or place > 0").select("bin", "parent", F.col("place").alias("shift"))
        found = (
            found.join(moves, "bin", "left")
            .withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
            .withColumn("bin", F.coalesce("parent", "bin"))
            .drop("parent", "shift")
        )
        parents = merged.groupBy(F.col("parent").alias("bin")).agg(F.min("task").alias("task"), F.sum("fill").alias("fill"))
        left = stored(parents, "pack-parents")
        remaining = left.count()
        if spans == 1 and (lots == 1 or remaining > 0.99 * count):
            break
        open_bins, span = left.filter(F.col("fill") < size - SLACK), span * FAN_IN
    return found.withColumnRenamed("bin", "sequence_id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
