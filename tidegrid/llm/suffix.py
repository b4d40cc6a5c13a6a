"""Removing long strings that an earlier document holds as well, by sorting and merging suffixes.

Of all suffixes of a text, only some are taken: those that begin at an anchor. Each window of ``length`` bytes has
one anchor, the place in it where the hash of the next few bytes is smallest. It depends on the window's bytes
alone, so two equal windows have their anchors at one place, and all windows that two documents share are found by
comparing suffixes at equal anchors, with the bytes before them. Neighbouring windows mostly have the same anchor; they
make a run.

First the hashes of anchors and of whole runs meet. A run whose anchor no other document has is done. One that an earlier
document holds as a whole is removed as a whole. A window holds the bytes at its anchor and as many again as two or
three times that either before or behind it; a run none of whose two such strings another document has is done as well.
Only where documents agree on one of them but not on the run, which
is where shared passages begin and end, are the bytes themselves sent: every task sorts its suffixes, codes
each as the length it shares with the one before and the rest, and the sorted runs are merged by a loser
tree that remembers these lengths and compares only what lies behind them.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import stored
from tidegrid.llm.jaccard import mixed, powers

LENGTH = 50
GRAM = 16  # bytes that are hashed to choose anchors; a power of two
PIECE = 4 << 20  # bytes of a text handled at once
PLACES = (8 << 20) - 1  # a piece's places, the last windows' bytes behind it included
FLUSH = 1_000_000  # rows of runs written together
LONG_GROUP = 200_000  # rows of one anchor before those of later documents are let go
SUFFIXES = 100_000  # suffixes that one task merges
BROADCAST_IDS = 1_000_000
U64 = np.uint64


def byte_values() -> np.ndarray:
    return np.random.default_rng(2).integers(0, 1 << 64, 256, dtype=np.uint64)


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from every place on; ``values`` has a random number for each byte."""
    hashes, size = values, 1
    while size < gram:
        hashes = mixed(hashes[:-size] * U64(0x9E3779B97F4A7C15) + hashes[size:])
        size *= 2
    return hashes


def window_least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of the ``width`` numbers from every place on."""
    least, size = hashes, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:])


def anchored_runs(data: np.ndarray, length: int, gram: int) -> list[np.ndarray]:
    """Anchor, first window, last window, anchor hash, run hash and sides of every run of windows.

    The sides are 16 bits each of the hashes of two strings, or 0: one begins at the anchor and is in all windows that begin less than
    half a window's anchors before it, the other ends with the anchor's bytes and is in all other windows.
    """
    values = byte_values()[data]
    hashes = gram_hashes(values, gram)
    width = length - gram + 1
    # With its place in the low bits, the smallest hash of a window tells the first place that has it.
    ranked = (hashes & ~U64(PLACES)) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (window_least(ranked, width) & U64(PLACES)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    last = np.concatenate((first[1:] - 1, [len(anchors) - 1]))
    anchor = anchors[first]
    up, down = powers(1 << max(12, int(len(data)).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[: len(data)], dtype=np.uint64)))
    end = last + length
    shape = (anchor - first).astype(np.uint64) * U64(1 << 20) + (end - first).astype(np.uint64)
    run = mixed(mixed((sums[end] - sums[first]) * down[first]) ^ shape)
    half = width // 2
    sides = np.zeros(len(first), np.uint32)
    for shift, start, stop in ((0, anchor, anchor + length - half + 1), (16, anchor - half, anchor + gram)):
        inside = (start >= first) & (stop <= end)
        start, stop = start[inside], stop[inside]
        side = mixed((sums[stop] - sums[start]) * down[start]) >> U64(48)
        sides[inside] |= np.maximum(side, U64(1)).astype(np.uint32) << np.uint32(shift)
    return [anchor, first, last, hashes[anchor].view(np.int64), run.view(np.int64), sides.view(np.int32)]


def text_runs(data: np.ndarray, length: int, gram: int) -> Iterator[list[np.ndarray]]:
    """``anchored_runs`` of a text, piece by piece. A run that two pieces cut counts as two."""
    for start in range(0, max(0, len(data) - length + 1), PIECE):
        found = anchored_runs(data[start : start + PIECE + length - 1], length, gram)
        yield [x + start for x in found[:3]] + found[3:]


def all_runs(docs: DataFrame, length: int, gram: int, wide: bool = False) -> DataFrame:
    """``anchor, run, doc_id, place, shape, sides`` of every run of windows of every text (``doc_id, variant, text``).

    ``shape`` packs the variant, the bytes before the anchor and those from it on, in 64 bits if ``wide``: variants are many
    when very many texts share an id. Of equal texts that a task reads
    together, only the one with the smallest id is looked at; of the others all is known, and they get one row
    of which ``place`` is minus their size.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids, variants = (batch.column(c).to_pylist() for c in ("doc_id", "variant"))
            texts = batch.column("text").cast(pa.binary())
            firsts: dict[bytes, int] = {}
            keys = []
            for i, doc_id in enumerate(ids):
                data = texts[i].as_buffer()
                keys.append(hashlib.sha256(data).digest() if data.size >= length else None)
                firsts[keys[-1]] = min(doc_id, firsts.get(keys[-1], doc_id))
            for i, doc_id in enumerate(ids):
                if keys[i] is None:
                    continue
                data, variant = np.frombuffer(texts[i].as_buffer(), dtype=np.uint8), variants[i] << 16
                if firsts[keys[i]] < doc_id:
                    held.append([np.array([x]) for x in (hash((doc_id, variants[i])), 0, doc_id, -len(data), variant, 0)])
                    count += 1
                    continue
                for anchor, first, last, key, run, sides in text_runs(data, length, gram):
                    shape = variant + (anchor - first) * 256 + (last + length - anchor)
                    held.append([key, run, np.full(len(key), doc_id), anchor, shape, sides])
                    count += len(key)
                if count > FLUSH:
                    yield rows(held)
                    held, count = [], 0
        if held:
            yield rows(held)

    def rows(held):
        names = ["anchor", "run", "doc_id", "place", "shape", "sides"]
        kinds = [np.int64, np.int64, np.int64, np.int32, np.int64 if wide else np.int32, np.int32]
        columns = [pa.array(np.concatenate(x).astype(kind)) for x, kind in zip(zip(*held), kinds)]
        return pa.RecordBatch.from_arrays(columns, names)

    shape = "bigint" if wide else "int"
    return docs.mapInArrow(found, f"anchor bigint, run bigint, doc_id bigint, place int, shape {shape}, sides int")


def shared_runs(runs: DataFrame) -> DataFrame:
    """``doc_id, variant, start, size, anchor, left``: with a null ``anchor``, a stretch of a text that an earlier
    document has; else a run (its bytes, its anchor's hash, the bytes before it) whose anchor and one of whose
    sides are in other runs of other documents.

    The runs are dealt out by anchor and sorted in the partitions, so that those of an anchor are read in pieces. Of
    equal runs only those of the first document are held on to.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, most = None, LONG_GROUP
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "run", "doc_id", "place", "shape", "sides")]
            rows = new if carry is None else [np.concatenate(x) for x in zip(carry, new)]
            last = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
            yield from decided([x[:last] for x in rows])
            carry = [x[last:] for x in rows]
            if len(carry[0]) > most:
                later = later_rows(carry)
                yield from written(carry, later, np.zeros(len(later), bool))
                carry = [x[~later] for x in carry]
                most = max(LONG_GROUP, 2 * len(carry[0]))
        if carry is not None:
            yield from decided(carry)

    def later_rows(rows):
        """Rows whose run the first document of that run has as well; the rows are sorted."""
        anchor, run, doc_id, place, *_ = rows
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (run[1:] != run[:-1])))
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        return (doc_id > doc_id[head]) | (place < 0)

    def decided(rows):
        anchor, _, doc_id, _, _, sides = rows
        if len(anchor):
            later = later_rows(rows)
            group = np.cumsum(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            # The first row of every run is of its first document, so these are all there are.
            first = np.flatnonzero(~later)
            first = first[in_two_documents(group[first], doc_id[first])]
            compare = np.zeros(len(anchor), bool)
            for shift in (0, 16):
                side = sides[first] >> shift & 0xFFFF
                some = first[side > 0]
                key = group[some] << 16 | side[side > 0]
                order = np.argsort(key, kind="stable")
                compare[some[order]] |= in_two_documents(key[order], doc_id[some[order]])
            yield from written(rows, later, compare)

    def in_two_documents(key, doc_id):
        """For each of the ascending keys, whether it comes with more than one document."""
        new = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
        starts = np.flatnonzero(new)
        if len(starts) == 0:
            return np.zeros(0, bool)
        return (np.minimum.reduceat(doc_id, starts) < np.maximum.reduceat(doc_id, starts))[np.cumsum(new) - 1]

    def written(rows, removed, compare):
        anchor, _, doc_id, place, shape, _ = (x[removed | compare] for x in rows)
        if len(anchor):
            whole, left, right = place < 0, shape // 256 % 256, shape % 256
            start, size = np.where(whole, 0, place - left), np.where(whole, -place, left + right)
            arrays = [doc_id, (shape >> 16).astype(np.int32), start.astype(np.int32), size.astype(np.int32), anchor, left.astype(np.int32)]
            arrays = [pa.array(x) for x in arrays]
            arrays[4] = pa.array(anchor, mask=removed[removed | compare])
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "variant", "start", "size", "anchor", "left"])

    dealt = runs.repartition("anchor").sortWithinPartitions("anchor", "run", "doc_id", "place")
    return dealt.mapInArrow(found, "doc_id bigint, variant int, start int, size int, anchor bigint, left int")


# --- sorted runs of suffixes -------------------------------------------------------------------


def shared_length(a: bytes, b: bytes, known: int) -> int:
    """How long the common beginning is, of which ``known`` bytes need not be looked at."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    low, high = known, end  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_code(suffixes: list[tuple[bytes, bytes]]) -> bytes:
    """Sorted pairs of a key and what comes with it: shared length, length of the rest, the rest, and the load."""
    out, before = [], b""
    for key, load in suffixes:
        shared = shared_length(before, key, 0)
        out.append(struct.pack("<BBB", shared, len(key) - shared, len(load)) + key[shared:] + load)
        before = key
    return b"".join(out)


def front_decode(blob: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """Shared length, key and load, in order."""
    at, key = 0, b""
    while at < len(blob):
        shared, rest, load = blob[at : at + 3]
        at += 3
        key = key[:shared] + blob[at : at + rest]
        at += rest
        yield shared, key, blob[at : at + load]
        at += load


def merge_runs(blobs: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
    """The keys of all runs in order, each with the length it shares with the key before it, and its load.

    A tree of losers. With every stream stands the length its key shares with the key that was last put out, which is
    also the winner its node last lost against. Of two streams, the one that shares more is the smaller and
    nothing is compared; at equal lengths only the bytes behind are.
    """
    streams = [front_decode(b) for b in blobs]
    size = 1
    while size < len(streams):
        size *= 2
    keys: list[bytes | None] = [None] * size
    loads: list[bytes] = [b""] * size
    lengths = [0] * size  # shared with the last key put out

    def advance(i: int) -> None:
        item = next(streams[i], None) if i < len(streams) else None
        if item is None:
            keys[i], lengths[i] = None, -1
        else:
            lengths[i], keys[i], loads[i] = item

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's length becomes what it shares with the winner."""
        if lengths[a] != lengths[b]:
            return (a, b) if lengths[a] > lengths[b] else (b, a)
        x, y = keys[a], keys[b]
        if x is None or y is None:
            return (a, b)
        shared = shared_length(x, y, lengths[a])
        if x[shared : shared + 1] <= y[shared : shared + 1]:
            lengths[b] = shared
            return a, b
        lengths[a] = shared
        return b, a

    for i in range(size):
        advance(i)
    level, lost_at = list(range(size)), []  # the losers of every level of the tree, from its leaves up
    while len(level) > 1:
        games = [play(a, b) for a, b in zip(level[::2], level[1::2])]
        lost_at.append([loser for _, loser in games])
        level = [winner for winner, _ in games]
    top = level[0]
    while keys[top] is not None:
        yield lengths[top], keys[top], loads[top]
        # The stream's next key is coded against the one just put out, so its shared length is the one wanted.
        advance(top)
        at = top
        for losers in lost_at:
            at //= 2
            top, losers[at] = play(top, losers[at])


LOAD = "<qiq"  # id, variant and place of an anchor
KEY = 8  # bytes of an anchor's hash, with which a key begins
LOADED = np.dtype([("doc_id", "<i8"), ("variant", "<i4"), ("place", "<i8")])


def boundary_windows(shared: np.ndarray, sizes: np.ndarray, loads: list[bytes], length: int) -> pd.DataFrame:
    """``doc_id, variant, start, size`` of stretches of which every window is in a record of a smaller document too.

    Records are in the order of their keys, ``sizes`` bytes long, each of which has ``shared`` bytes in common with the one before. A
    window that begins so many bytes before the anchor is told by the keys' common beginning and by the common end of the bytes before the
    anchors, which are put in order as well, from their last byte on.
    """
    fixed = LOADED.itemsize
    heads = np.frombuffer(b"".join(x[:fixed] for x in loads), LOADED)
    doc_id, place = heads["doc_id"].astype(np.int64), heads["place"].astype(np.int64)
    lefts = np.array([len(x) - fixed for x in loads])
    widest = max(1, int(lefts.max()))
    ends = np.frombuffer(b"".join(x[: fixed - 1 : -1].ljust(widest, b"\0") for x in loads), f"S{widest}")
    by = np.argsort(ends, kind="stable")
    ends = ends[by].view(np.uint8).reshape(len(by), widest)
    differ = ends[1:] != ends[:-1]
    agreed = np.concatenate(([-1], np.where(differ.any(axis=1), differ.argmax(axis=1), widest)))
    before, records, backs = np.empty(len(by), np.int64), [], []
    for back in range(int(lefts.max()) + 1):
        behind = np.cumsum(shared < KEY + length - back)
        before[by] = np.cumsum(agreed < back)
        at = np.flatnonzero((lefts >= back) & (sizes >= KEY + length - back))
        if len(at) == 0:
            continue
        window = behind[at] * (len(by) + 1) + before[at]
        order = np.argsort(window, kind="stable")
        window, at = window[order], at[order]
        starts = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1])))
        least = np.repeat(np.minimum.reduceat(doc_id[at], starts), np.diff(starts, append=len(at)))
        records.append(at[least < doc_id[at]])
        backs.append(np.full(len(records[-1]), back))
    record, back = (np.concatenate([np.empty(0, np.int64), *x]) for x in (records, backs))
    order = np.argsort(record, kind="stable")
    record, back = record[order], back[order]
    low = np.flatnonzero(np.concatenate(([True], (record[1:] != record[:-1]) | (back[1:] != back[:-1] + 1)))[: len(record)])
    high = np.append(low[1:], len(record))[: len(low)] - 1
    found = record[low]
    columns = [doc_id[found], heads["variant"][found], place[found] - back[high], back[high] - back[low] + length]
    return pd.DataFrame(dict(zip(["doc_id", "variant", "start", "size"], columns)))


def sorted_suffixes(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, blob``: every task's suffixes, sorted and front-coded, dealt out by anchor.

    ``docs`` has ``doc_id, variant, text, runs``, the last an array of ``start, size, anchor, left``.
    """

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, bytes, bytes]] = []

        def blobs() -> pd.DataFrame:
            held.sort()
            by: dict[int, list] = {}
            for bucket, key, load in held:
                by.setdefault(bucket, []).append((key, load))
            held.clear()
            return pd.DataFrame([(b, front_code(x)) for b, x in by.items()], columns=["bucket", "blob"])

        for batch in batches:
            for doc_id, variant, text, runs in zip(*(batch[c] for c in ("doc_id", "variant", "text", "runs"))):
                data = text.encode()
                for run in runs:
                    start, size, anchor, left = run["start"], run["size"], run["anchor"], run["left"]
                    key = struct.pack(">q", anchor) + data[start + left : start + size]
                    load = struct.pack(LOAD, doc_id, variant, start + left) + data[start : start + left]
                    held.append((anchor % buckets, key, load))
                    if len(held) >= SUFFIXES:
                        yield blobs()
        if held:
            yield blobs()

    return docs.mapInPandas(coded, "bucket bigint, blob binary")


def merged_windows(blobs: DataFrame, length: int) -> DataFrame:
    """``doc_id, variant, start, size`` of stretches found by merging the suffixes of every bucket."""

    def merged(runs: pd.DataFrame) -> pd.DataFrame:
        shares, sizes, loads = array("B"), array("B"), []
        for shared, key, load in merge_runs(list(runs["blob"])):
            shares.append(shared)
            sizes.append(len(key))
            loads.append(load)
        return boundary_windows(*(np.array(x, np.int64) for x in (shares, sizes)), loads, length)

    return blobs.groupBy("bucket").applyInPandas(merged, "doc_id bigint, variant int, start int, size int")


def kept_bytes(data: bytes, stretches: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left without the stretches (start and size), and how many gaps there are."""
    parts, end, gaps = [], 0, 0
    for start, size in sorted(stretches):
        if start > end or gaps == 0:
            parts.append(data[end:start])
            gaps += 1
        end = max(end, start + size)
    parts.append(data[end:])
    return b"".join(parts), gaps


def only_ids(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``df`` joined with the distinct ``ids``, which are sent to every task when they are few."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, ids.columns, how)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, texts: bool = False
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row; with ``texts`` also ``kept``, as bytes.

    Of every text's UTF-8 bytes, those are removed that lie in a string of ``length`` bytes which also
    starts in a document with a smaller id, judged on the texts as they came. Null texts are empty. Rows that repeat an
    id are one document to others and not repeats of each other. From a row without an id nothing is removed, and
    nothing because of it. Other columns are ignored.

    Equal runs of windows are told by two 64-bit hashes. Memory of a task is bounded by a text's piece, by SUFFIXES in
    sorting and merging, and by the number of different surroundings of one anchor.
    """
    if not gram < length <= 127:
        raise ValueError("length must be over the gram and at most 127")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    # Ids that come with several texts, which are told apart by a number.
    keys = rows.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("key")).distinct()
    twice = keys.groupBy("doc_id").agg(F.sort_array(F.collect_set("key")).alias("keys")).filter(F.size("keys") > 1)
    twice = stored(twice.select("doc_id", F.posexplode("keys").alias("variant", "key")), "suffix-ids")
    if twice.isEmpty():
        rows = rows.withColumn("variant", F.lit(0))
    else:
        rows = rows.withColumn("key", F.xxhash64("text")).join(twice, ["doc_id", "key"], "left")
        rows = rows.select("doc_id", "text", F.coalesce("variant", F.lit(0)).alias("variant"))
    named = rows.filter("doc_id is not null").select("doc_id", "variant", "text")

    shared = stored(shared_runs(all_runs(named, length, gram, not twice.isEmpty())), "suffix-shared")
    open_runs = shared.filter("anchor is not null")
    buckets = max(1, -(-open_runs.count() // SUFFIXES))
    per_doc = open_runs.groupBy("doc_id", "variant").agg(F.collect_list(F.struct("start", "size", "anchor", "left")).alias("runs"))
    per_doc = stored(per_doc, "suffix-open")
    with_text = only_ids(named, per_doc.select("doc_id", "variant"), "left_semi").distinct().join(per_doc, ["doc_id", "variant"])
    blobs = stored(sorted_suffixes(with_text, buckets), "suffix-runs")
    stretches = shared.filter("anchor is null").select("doc_id", "variant", "start", "size").unionByName(merged_windows(blobs, length))
    stretches = stretches.groupBy("doc_id", "variant").agg(F.collect_list(F.struct("start", "size")).alias("stretches"))
    stretches = stored(stretches, "suffix-stretches")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch["doc_id"], batch["text"], batch["stretches"]):
                data = text.encode()
                kept, gaps = kept_bytes(data, [(x["start"], x["size"]) for x in found])
                out.append((doc_id, len(data), len(data) - len(kept), gaps, hashlib.sha256(kept).hexdigest(), kept if texts else None))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    ids = stretches.select("doc_id", "variant")
    changed = only_ids(named, ids, "left_semi").join(stretches, ["doc_id", "variant"]).mapInPandas(cut, schema)
    same = only_ids(rows, ids, "left_anti").select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        F.encode("text", "utf-8").alias("kept"),
    )
    found = changed.unionByName(same)
    return found if texts else found.drop("kept")
