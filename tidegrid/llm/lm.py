"""Scoring documents by how well the rest of the corpus predicts their words: stupid backoff over n-grams of words.

The score of a word is the share of times it follows the words before it, in all other documents: the longest n-gram
that another document has counts, and each shorter one costs a factor of ALPHA. Every word and every n-gram has its own
count. Texts are written in chunks of a bounded size. A chunk sends its different n-grams, counted, to the hash ranges
they belong to: one row holds what a chunk has in a range. A range adds up the counts and answers every row with
those of the other chunks, in the order of its n-grams. This is done for n-grams of one length after those of another, and the
answers are stored, so that what was sent for one length is gone from the disks before the next. With the
answers a chunk scores its documents, without each one's own.
So an n-gram is sent once by each chunk that has it, however many of its documents do, and no list of words or
n-grams is held in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.common import stored, stored_alone
from tidegrid.llm.jaccard import U64, byte_tables, distinct_counts, mixed, text_words

ORDER = 3
ALPHA = 0.4
FLUSH = 2_000_000
CHUNK = 7 << 20  # bytes of text in a chunk; a longer text is one of its own
RANGES = 512  # hash ranges at least
RANGE_BYTES = 4 << 20  # bytes of text for each range: about 700,000 n-grams of one length


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, times``: how often every word (its hash) occurs; each task counts what it reads first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = text_words(text) if text else np.empty(0, np.uint64)
                held.append(words)
                size += len(words)
                if size > FLUSH:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    def rows(held):
        words, times = distinct_counts(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times)], ["word", "times"])

    return docs.mapInArrow(counted, "word bigint, times bigint").groupBy("word").agg(F.sum("times").alias("times"))


def how_many_words(text: str) -> int:
    """As many as text_words finds, without their hashes."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    gap = byte_tables()[1][data]
    return int(np.count_nonzero(gap[:-1] & ~gap[1:])) + int(len(gap) > 0 and not gap[0])


def chunks_of(rows: DataFrame, size: int) -> DataFrame:
    """``chunk, bytes, words, ids, texts``: one row for neighbouring documents of ``size`` bytes together."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        held, total = [], 0
        for batch in batches:
            lengths = np.diff(np.frombuffer(batch.column("text").buffers()[1], np.int32)[batch.column("text").offset :][: batch.num_rows + 1])
            start = 0
            for at, length in enumerate(lengths.tolist()):
                total += length
                if total >= size:
                    held.append(batch.slice(start, at + 1 - start))
                    yield row(chunk, total, held)
                    chunk, held, total, start = chunk + 1, [], 0, at + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield row(chunk, total, held)

    def row(chunk, total, held):
        ids, texts = (pa.concat_arrays([x.column(c) for x in held]) for c in ("doc_id", "text"))
        texts = texts.to_pylist()
        words = sum(how_many_words(text) for text in texts)
        arrays = [pa.array([x], pa.int64()) for x in (chunk, total, words)]
        arrays += [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([folded(texts)], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["chunk", "bytes", "words", "ids", "texts"])

    ids = T.ArrayType(rows.schema["doc_id"].dataType)
    fields = [("chunk", T.LongType()), ("bytes", T.LongType()), ("words", T.LongType()), ("ids", ids), ("texts", T.BinaryType())]
    return rows.mapInArrow(gathered, T.StructType([T.StructField(*f) for f in fields]))


def folded(texts: list[str]) -> bytes:
    """Texts compressed together, since they are stored and sent once more."""
    data = [text.encode("utf-8", "surrogatepass") for text in texts]
    whole = np.array([len(data), *map(len, data)], dtype=np.int64).tobytes() + b"".join(data)
    return len(whole).to_bytes(8, "little") + pa.Codec("zstd", compression_level=9).compress(whole, asbytes=True)


def unfolded(blob: bytes) -> list[str]:
    whole = pa.Codec("zstd").decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), asbytes=True)
    n = int.from_bytes(whole[:8], "little")
    ends = (8 + 8 * n + np.cumsum(np.frombuffer(whole, np.int64, n, 8))).tolist()
    return [whole[a:b].decode("utf-8", "surrogatepass") for a, b in zip([8 + 8 * n, *ends], ends)]


class Grams:
    """The words of a chunk, the documents and places they are at, and the hashes of its n-grams."""

    def __init__(self, texts: list[str], known: np.ndarray | None):
        found = [text_words(text) if text else np.empty(0, np.uint64) for text in texts]
        self.lengths = np.array([len(x) for x in found], dtype=np.int64)
        words = np.concatenate([np.empty(0, np.uint64), *found])
        if known is not None:
            at = np.minimum(np.searchsorted(known, words), max(len(known) - 1, 0))
            words = np.where(known[at] == words, words, U64(0)) if len(known) else np.zeros_like(words)
        self.words = words
        self.doc = np.repeat(np.arange(len(found)), self.lengths)
        self.place = np.arange(len(words)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The places where n-grams of ``n`` words end, and their hashes."""
        ends = np.flatnonzero(self.place >= n - 1)
        total = np.full(len(ends), n, dtype=np.uint64)
        for back in range(n - 1, -1, -1):
            total *= U64(0xD6E8FEB86659FD93)
            total += self.words[ends - back]
        return ends, mixed(total)


def counted_grams(chunks: DataFrame, n: int, ranges: int, known: np.ndarray | None) -> DataFrame:
    """``range, chunk, grams, times``: a chunk's different n-grams of ``n`` words in a hash range, ascending, and how often it has each."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, texts in zip(batch.column("chunk").to_pylist(), batch.column("texts")):
                grams, times = distinct_counts(Grams(unfolded(texts.as_py()), known).of(n)[1])
                number = ((grams >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)
                starts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else np.empty(0, np.int64)
                steps = np.diff(grams, prepend=U64(0))
                steps[starts] = grams[starts]
                arrays = [pa.array(number[starts]), pa.array(np.full(len(starts), chunk, dtype=np.int64))]
                arrays += [squeezed(x, np.append(starts, len(grams))) for x in (steps, times)]
                yield pa.RecordBatch.from_arrays(arrays, ["range", "chunk", "grams", "times"])

    return chunks.select("chunk", "texts").mapInArrow(counted, "range bigint, chunk bigint, grams binary, times binary")


def squeezed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The 64-bit ``values`` between every two bounds, compressed: first bytes, then second bytes, and so on."""
    codec, out = pa.Codec("zstd", compression_level=1), []
    for start, end in zip(bounds.tolist(), bounds[1:].tolist()):
        planes = np.ascontiguousarray(values[start:end]).view(np.uint8).reshape(-1, 8).T.tobytes()
        out.append((end - start).to_bytes(4, "little") + codec.compress(planes, asbytes=True))
    return pa.array(out, pa.binary())


def restored(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    planes = pa.Codec("zstd").decompress(blob[4:], decompressed_size=8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view(np.uint64).ravel()


def others_of(counted: DataFrame) -> DataFrame:
    """``chunk, range, others``: for every row of :func:`counted_grams`, how often the other chunks have each of its n-grams."""

    def added(table: pa.Table) -> pa.Table:
        steps, counts = ([restored(x) for x in table.column(c).to_pylist()] for c in ("grams", "times"))
        grams, times = np.concatenate([np.cumsum(x, dtype=np.uint64) for x in steps]), np.concatenate(counts)
        order = np.argsort(grams)
        grams = grams[order]
        starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
        totals = np.empty(len(grams), dtype=np.uint64)
        totals[order] = np.repeat(np.add.reduceat(times[order], starts), np.diff(starts, append=len(grams)))
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in steps])))
        return pa.table({"chunk": table.column("chunk"), "range": table.column("range"), "others": squeezed(totals - times, bounds)})

    return counted.groupBy("range").applyInArrow(added, "chunk bigint, range bigint, others binary")


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: int | None = None,
    frequent: int | None = None,
    alpha: float = ALPHA,
    order: int = ORDER,
    chunk_bytes: int = CHUNK,
) -> DataFrame:
    """``doc_id, n_words, n_seen, log_score, mean_log_score`` for every row of ``docs``.

    Words are split at white space, A-Z count as a-z. N-grams have up to ``order`` words, at least 2. Counts are those of
    all rows but the scored one; rows that repeat count for each other. ``n_seen`` words follow the one before them in
    another row too. A word that no other row has counts as met once. The first word has no word before it and is
    scored by its share. A null or empty text has no words, a score of 0 and a null mean. Other columns are ignored.

    All words count as they are. Only a caller who gives a ``vocabulary`` has all but so many most frequent words (of equal
    counts, those with the smaller hash) scored as one word. ``frequent`` is taken for older callers and changes nothing.
    N-grams are told apart by 64-bit hashes.
    """
    if order < 2:
        raise ValueError(f"n-grams of at least 2 words, not {order}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # Rows are large: the writer looks at its memory after a few, not after 100.
    chunks = stored(chunks_of(rows, chunk_bytes), "lm-chunks", **{"parquet.page.size.row.check.min": "2"})
    size, total = chunks.agg(F.sum("bytes"), F.sum("words")).first()
    ranges = max(RANGES, -(-(size or 0) // RANGE_BYTES))
    total, known = total or 0, None
    if vocabulary is not None:
        top = word_counts(rows.select("text")).orderBy(F.desc("times"), "word").limit(vocabulary).toPandas()
        known = np.sort(top["word"].to_numpy(np.int64).view(np.uint64))
    lengths = range(1, order + 1)
    answers = [stored_alone(others_of(counted_grams(chunks, n, ranges, known)), f"lm-counts-{n}") for n in lengths]
    answers = reduce(DataFrame.unionByName, [x.withColumn("n", F.lit(n)) for n, x in zip(lengths, answers)])

    def scored(chunk: pa.Table, answer: pa.Table) -> pa.Table:
        ids = chunk.column("ids").combine_chunks().flatten()
        grams = Grams(unfolded(chunk.column("texts")[0].as_py()), known)
        blobs, n, part = answer.column("others").to_pylist(), answer.column("n").to_numpy(), answer.column("range").to_numpy()
        by = np.lexsort((part, n))
        counts = [[restored(blobs[i]) for i in by[n[by] == k]] for k in lengths]
        scores, seen = score(grams, [np.concatenate([np.empty(0, np.uint64), *x]).astype(np.int64) for x in counts])
        n = pa.array(grams.lengths)
        mean = pa.array(scores / np.maximum(grams.lengths, 1), mask=grams.lengths == 0)
        return pa.table({"doc_id": ids, "n_words": n, "n_seen": pa.array(seen), "log_score": pa.array(scores), "mean_log_score": mean})

    def elsewhere_of(grams: Grams, n: int, counts: np.ndarray) -> np.ndarray:
        """How often other documents have the n-gram of ``n`` words that ends at a place; ``counts`` are those of other chunks."""
        ends, hashes = grams.of(n)
        by = np.argsort(hashes, kind="stable")  # equal n-grams stay in the order of their documents
        hashes, owner = hashes[by], grams.doc[ends[by]]
        first = np.concatenate(([True], hashes[1:] != hashes[:-1])) if len(by) else np.empty(0, bool)
        if np.count_nonzero(first) != len(counts):
            raise ValueError("the counts are not those of the chunk's n-grams")
        counts = counts + np.diff(np.flatnonzero(first), append=len(by))
        starts = np.flatnonzero(first | np.concatenate(([True], owner[1:] != owner[:-1]))) if len(by) else np.empty(0, np.int64)
        own = np.diff(starts, append=len(by))
        other = np.zeros(len(grams.doc), dtype=np.int64)
        other[ends[by]] = np.repeat(counts[np.cumsum(first)[starts] - 1] - own, own)
        return other

    def score(grams: Grams, counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        elsewhere = [elsewhere_of(grams, n, x) for n, x in zip(lengths, counts)]
        longest = np.minimum(grams.place + 1, order)
        others = np.maximum(1, total - grams.lengths)[grams.doc]
        gain = np.log(np.maximum(elsewhere[0], 1) / others) + (longest - 1) * np.log(alpha)
        for n in range(2, order + 1):
            met = np.flatnonzero(elsewhere[n - 1] > 0)
            # Where the n-gram is, what it begins with is as well.
            before = np.maximum(elsewhere[n - 2][met - 1], 1)
            gain[met] = np.log(elsewhere[n - 1][met] / before) + (longest[met] - n) * np.log(alpha)
        size = len(grams.lengths)
        seen = np.bincount(grams.doc[elsewhere[1] > 0], minlength=size).astype(np.int64)
        return np.bincount(grams.doc, weights=gain, minlength=size).astype(np.float64), seen

    out = T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_seen", T.LongType()),
                        T.StructField("log_score", T.DoubleType()), T.StructField("mean_log_score", T.DoubleType())])
    return chunks.select("chunk", "ids", "texts").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, out)
