"""Joining documents whose sets of word n-grams have a large Jaccard similarity, and their classes.

All sets are put in one order: n-grams met more than once come last, as far as a bitmap of bounded size tells them, the others
in the order of their hashes. Two sets that are similar enough share an n-gram among their first ones, the prefix, so the join is
dealt out by prefix n-grams: a first level of the tree of ordered sets. What meets there is only the
hash and the size of a set. The prefix is a quarter longer than one shared n-gram needs, so that similar sets share several n-grams
in it, and a set that meets too few others there by chance is left out. In a run of sets that share an n-gram, every set is compared with one of fitting size, not each with
each. The sets found similar enough become classes; further rounds compare members of a run that are still
in different classes, at last all of them. So every link between different classes is looked for,
and links inside a class that is already known are not. Of the pairs, only those are compared whose signatures of
fixed size leave a chance: they bound the overlap from above.

Comparing is done in blocks of one set against others, which are held in a prefix tree: sets that begin alike
share the path and the overlap counted on it, and a path is left when even all of its remaining n-grams could not
make the overlap large enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import free, stored
from tidegrid.llm.components import star_components

WORDS = 5
SHARE = (3, 4)  # similarity as a fraction
COMMON = 1 << 24  # so many n-grams are put last at most
MAX_BITS, BITS_EACH = 1 << 27, 16  # of the bitmap that tells them: 16 MB at most, less while each can have so many bits
PAGE_BITS = 1 << 16
COMMON_STEPS = 1000  # counts above are one step
FLUSH = 2_000_000  # n-grams counted together in a task
LEAVES = 64  # sets of a block that are compared together
BROADCAST_IDS = 1_000_000  # ids of 16 bytes that may be sent to every task
PIECE = 1 << 17  # bytes of a text handled at once, so that what is computed of them stays in the processor's cache
LONG_RUN = 200_000  # rows of a run handled at once
STEP = 256  # n-grams of a path between two looks at the bound
BITS = 1024  # of a set's signature
EARLY = 4  # n-grams of a set by which pairs are told that meet under several
NO_GRAM = (1 << 63) - 1  # stands behind the last of fewer
SPARE = 4  # the prefix is longer by one n-gram for so many
ROUNDS = 4  # of comparing; all but the last take one set of a run against the others
U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=1)
def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """A random number for each byte, the same for A-Z and a-z, and whether it is white space."""
    values = np.random.default_rng(1).integers(0, 1 << 64, 256, dtype=np.uint64)
    values[65:91] = values[97:123]
    space = np.zeros(256, dtype=bool)
    space[[32, *range(9, 14)]] = True
    return values, space


@lru_cache(maxsize=4)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a fixed odd number and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    up, down = (np.full(size, x, dtype=np.uint64) for x in (base, inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every word of the text's bytes."""
    if len(data) == 0:
        return np.empty(0, np.uint64)
    values, space = byte_tables()
    data = data.astype(np.intp)
    gap = space[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.append(0, edge)
    if not gap[-1]:
        edge = np.append(edge, len(data))
    starts, ends = edge[::2], edge[1::2]
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    up, down = powers(max(PIECE, 1 << len(data).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.multiply(values[data], up[: len(data)], out=sums[1:])
    np.add.accumulate(sums, out=sums)
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(data) <= PIECE:
        return word_hashes(data)
    space, cuts, at = byte_tables()[1], [0], 0
    while len(data) - at > PIECE:
        gaps = np.flatnonzero(space[data[at + 1 : at + PIECE]])
        if len(gaps) == 0:  # a word longer than a piece: up to its end
            gaps = np.flatnonzero(space[data[at + 1 :]])[:1]
            if len(gaps) == 0:
                break
        at += 1 + int(gaps[-1])
        cuts.append(at)
    cuts.append(len(data))
    return np.concatenate([word_hashes(data[a:b]) for a, b in zip(cuts, cuts[1:])])


def distinct_counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, ascending, and how often each occurs."""
    values = np.sort(values)
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, np.int64)
    return values[starts], np.diff(starts, append=len(values))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The hashes of the text's distinct n-grams of words, ascending."""
    found = text_words(text) if text else np.empty(0, np.uint64)
    if len(found) == 0:
        return found
    size = min(words, len(found))
    total = np.full(len(found) - size + 1, size, dtype=np.uint64)
    for place in range(size):
        total *= U64(0xD6E8FEB86659FD93)
        total += found[place : place + len(total)]
    return distinct_counts(mixed(total))[0]


def fingerprint(grams: np.ndarray) -> int:
    """A hash of a set, from a sum over its members, which are well mixed themselves."""
    total = np.add.reduce(grams, keepdims=True)
    total += U64(len(grams))
    return int(mixed(total).view(np.int64)[0])


def signature(grams: np.ndarray) -> bytes:
    """For each of BITS places, whether an odd number of n-grams falls there. Two sets differ at least in as many n-grams
    as their signatures differ in bits."""
    return np.packbits(np.bincount((grams >> U64(20)) % U64(BITS), minlength=BITS).astype(np.uint8) & 1).tobytes()


def could_be(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Whether sets of sizes ``n`` and ``m`` with these signatures (rows of 64-bit numbers) can be similar enough."""
    over, under = share
    apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    both = n.astype(np.int64) + m
    return (both - apart) // 2 >= -(-both * over // (over + under))


def signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, BITS // 64)


def prefix_length(size: int, share: tuple[int, int]) -> int:
    """So many first n-grams, that a set with none of them cannot be similar enough."""
    over, under = share
    return size - -(-size * over // under) + 1


def spare(size: int, share: tuple[int, int]) -> int:
    """So many n-grams behind the prefix are dealt out as well, fewer than two similar sets share. Both sets of a similar pair
    have one more shared n-gram than the smaller's number in what is dealt out of them."""
    prefix = prefix_length(size, share)
    return min(prefix // SPARE, size - prefix)


def least_shared(n: str, share: tuple[int, int]) -> Column:
    """How many n-grams a set of size ``n`` shares at least with a similar one in what is dealt out of both: one more than
    :func:`spare` of the smallest size that fits."""
    over, under = (F.lit(x).cast("bigint") for x in share)
    least = F.floor((F.col(n) * over + under - 1) / under)
    prefix = least - F.floor((least * over + under - 1) / under) + 1
    return F.least(F.floor(prefix / SPARE), least - prefix) + 1


def describe(docs: DataFrame, words: int) -> DataFrame:
    """A row ``doc_id, text_key, n, fp, bits`` per document, and rows ``gram, times`` of n-grams met often in a task."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0

        def often() -> pa.RecordBatch:
            grams, times = distinct_counts(np.concatenate(kept))
            grams, times = grams[times > 1].view(np.int64), times[times > 1]
            none = pa.nulls(len(grams), pa.int64())
            no_bits = pa.nulls(len(grams), pa.binary())
            return pa.RecordBatch.from_arrays([none, none, none, none, no_bits, pa.array(grams), pa.array(times)], names)

        names = ["doc_id", "text_key", "n", "fp", "bits", "gram", "times"]
        for batch in batches:
            sizes, fps, bits = [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingle_set(text, words)
                sizes.append(len(grams))
                fps.append(fingerprint(grams))
                bits.append(signature(grams))
                kept.append(grams)
                held += len(grams)
                if held > FLUSH:
                    yield often()
                    kept, held = [], 0
            none = pa.nulls(len(sizes), pa.int64())
            own = [batch.column("doc_id"), batch.column("text_key")]
            own += [pa.array(sizes, pa.int64()), pa.array(fps, pa.int64()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([*own, none, none], names)
        if kept:
            yield often()

    schema = "doc_id bigint, text_key bigint, n bigint, fp bigint, bits binary, gram bigint, times bigint"
    return docs.mapInArrow(described, schema)


def common_grams(about: DataFrame) -> np.ndarray:
    """A bitmap of at most MAX_BITS bits in which the n-grams met most often have theirs set, at most COMMON of them unless more
    are met COMMON_STEPS times: as many whole steps of the count as fit, and always the highest.

    An n-gram's bit is given by its hash alone. So all sets are put in the same order by it, whichever bits are set, and one
    that an uncommon n-gram shares with a common one does no harm.
    """
    often = about.filter("gram is not null").groupBy("gram").agg(F.sum("times").alias("times"))
    often = stored(often, "jaccard-common")
    count, least = 0, COMMON_STEPS + 1
    steps = often.groupBy(F.least("times", F.lit(COMMON_STEPS)).alias("step")).agg(F.count(F.lit(1)).alias("grams"))
    for times, grams in steps.sort(F.desc("step")).collect():
        if count and count + grams > COMMON:
            break
        count, least = count + grams, times
    bits = min(MAX_BITS, max(PAGE_BITS, 1 << (BITS_EACH * count).bit_length()))
    shift = 64 - bits.bit_length() + 1

    def page(rows: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(PAGE_BITS, np.uint8)
        marks[rows["place"].to_numpy()] = 1
        return pd.DataFrame({"page": rows["page"].iloc[:1], "bits": [np.packbits(marks, bitorder="little").tobytes()]})

    place = F.shiftrightunsigned("gram", shift)
    chosen = often.filter(F.col("times") >= least)
    placed = chosen.select(F.floor(place / PAGE_BITS).alias("page"), (place % PAGE_BITS).alias("place")).distinct()
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in placed.groupBy("page").applyInPandas(page, "page bigint, bits binary").toLocalIterator():
        bitmap[row.page * PAGE_BITS // 8 : (row.page + 1) * PAGE_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return bitmap


def is_common(grams: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    place = grams >> U64(64 - (8 * len(bitmap)).bit_length() + 1)
    return (bitmap[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1


def prefixes(docs: DataFrame, common: np.ndarray, words: int, share: tuple[int, int]) -> DataFrame:
    """``gram, n, fp`` for the first n-grams of every set. A task writes sets it meets again only once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            grams, sizes, fps, held = [], [], [], 0
            for text in batch.column("text").to_pylist():
                own = shingle_set(text, words)
                if len(own) == 0:
                    continue
                fp = fingerprint(own)
                if fp in seen:
                    continue
                seen.add(fp)
                take = prefix_length(len(own), share) + spare(len(own), share)
                last = is_common(own, common)
                own_prefix = np.concatenate((own[~last], own[last]))[:take]
                grams.append(own_prefix)
                sizes.append(len(own))
                fps.append(fp)
                held += take
                if held > FLUSH:
                    yield rows(grams, sizes, fps)
                    grams, sizes, fps, held = [], [], [], 0
            if grams:
                yield rows(grams, sizes, fps)

    def rows(grams, sizes, fps):
        times = [len(g) for g in grams]
        columns = [np.concatenate(grams).view(np.int64), np.repeat(np.array(sizes, np.int32), times), np.repeat(np.array(fps, np.int64), times)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "n", "fp"])

    return docs.mapInArrow(found, "gram bigint, n int, fp bigint")


def fits(small: np.ndarray, large: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Whether sets of these sizes can be similar enough; ``small`` is not the larger."""
    return small.astype(np.int64) * share[1] >= large.astype(np.int64) * share[0]


def hubs(n: np.ndarray, start: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """For rows of runs that ascend in size, the row each is compared with: the first of its run, or the first after
    that whose size the former does not fit, and so on. ``start`` is the first row of a row's run."""
    hub = start.copy()
    while True:
        off = np.flatnonzero(~fits(n[hub], n, share))
        if len(off) == 0:
            return hub
        group = hub[off]
        first = np.concatenate(([True], group[1:] != group[:-1]))
        hub[off] = off[first][np.cumsum(first) - 1]


def runs_of(index: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``gram, n, fp, hub`` for the runs of at least two different sets that share a prefix n-gram.

    Sets that fit no other of their run in size are left out: they can be similar to none of it. ``index`` is dealt out by n-gram
    and sorted in the partitions, so a run is read in pieces, not gathered.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, went_on = [np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)], False
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "n", "fp")]
            gram, n, fp = (np.concatenate(x) for x in zip(carry, new))
            same = (gram[1:] == gram[:-1]) & (fp[1:] == fp[:-1])
            fresh = np.concatenate(([True], ~same)) if len(gram) else np.empty(0, bool)
            gram, n, fp = gram[fresh], n[fresh], fp[fresh]
            if len(gram) == 0:
                continue
            last = int(np.searchsorted(gram, gram[-1]))
            whole = last if len(gram) - last <= LONG_RUN else len(gram)
            out, seed = runs(gram[:whole], n[:whole], fp[:whole], went_on, whole != last)
            if out is not None:
                yield out
            went_on = whole != last or went_on and last == 0
            # Of a very long run that was handled, the hub goes on to stand for it.
            carry = [gram[last:], n[last:], fp[last:]] if whole == last else [x[seed : seed + 1] for x in (gram, n, fp)]
        out, _ = runs(*carry, went_on, False)
        if out is not None:
            yield out

    def runs(gram, n, fp, went_on, goes_on):
        """``went_on`` and ``goes_on`` tell that the first and the last run are pieces, whose sets may fit those of another piece."""
        if len(gram) == 0:
            return None, 0
        first = np.concatenate(([True], gram[1:] != gram[:-1]))
        start = np.flatnonzero(first)[np.cumsum(first) - 1]
        hub = hubs(n, start, share)
        # In a run that ascends in size, a set that fits any fits the one before or after it.
        next_fits = ~first[1:] & fits(n[:-1], n[1:], share)
        many = np.append(next_fits, False) | np.append(False, next_fits)
        if went_on:
            many |= start == 0
        if goes_on:
            many |= start == start[-1]
        seed = int(hub[-1])
        if not many.any():
            return None, seed
        columns = [gram[many], n[many], fp[many], fp[hub][many]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "n", "fp", "hub"]), seed

    dealt = index.repartition("gram").sortWithinPartitions("gram", "n", "fp")
    return dealt.mapInArrow(found, "gram bigint, n int, fp bigint, hub bigint")


def path_overlaps(one: np.ndarray, others: list[np.ndarray], share: tuple[int, int]) -> list[int]:
    """The overlap of ``one`` with each of ``others``, or -1 where it is too small to be similar enough.

    The sets are sorted as paths of a prefix tree. Of a path, the part shared with the path before is not
    compared again: its overlap is known. A path is left where what is counted and what could still come is too
    little.
    """
    out = [-1] * len(others)
    order = sorted(range(len(others)), key=lambda i: others[i].astype(">u8").tobytes())
    before, counted = np.empty(0, np.uint64), np.zeros(1, np.int64)
    for i in order:
        path = others[i]
        over, under = share
        need = -(-(len(one) + len(path)) * over // (over + under))
        shared = min(len(before), len(path), len(counted) - 1)
        differ = np.flatnonzero(path[:shared] != before[:shared])
        at = int(differ[0]) if len(differ) else shared
        parts, done, hopeless = [counted[: at + 1]], int(counted[at]), False
        while True:
            rest = len(one) - int(np.searchsorted(one, path[at])) if at < len(path) else 0
            if done + min(rest, len(path) - at) < need:
                hopeless = True
            if hopeless or at >= len(path):
                break
            piece = path[at : at + STEP]
            hit = one[np.minimum(np.searchsorted(one, piece), len(one) - 1)] == piece
            sums = done + np.cumsum(hit)
            parts.append(sums)
            done, at = int(sums[-1]), at + len(piece)
        before, counted = path[:at], np.concatenate(parts)
        if not hopeless and done >= need:
            out[i] = done
    return out


def possible(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (``hub, fp``) whose sizes and signatures allow that they are similar enough."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = signatures(batch.column("a")), signatures(batch.column("b"))
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            yield batch.select(["hub", "fp"]).filter(pa.array(could_be(a, b, n, m, share)))

    one = sets.select(F.col("fp").alias("hub"), F.col("bits").alias("a"), F.col("n").alias("m"))
    other = sets.select("fp", F.col("bits").alias("b"), "n")
    return pairs.join(one, "hub").join(other, "fp").mapInArrow(kept, "hub bigint, fp bigint")


def blocks(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Which texts are needed in which block to compare ``pairs``: ``hub, part, fp`` and a document of the set ``fp``."""
    many = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / LEAVES).alias("parts"))
    pairs = pairs.join(many, "hub").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    leaves = pairs.select("hub", "part", "fp")
    heads = many.select("hub", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.col("hub").alias("fp"))
    return stored(leaves.unionByName(heads).join(sets.select("fp", "doc_id", "text_key"), "fp"), "jaccard-needed")


def similar(docs: DataFrame, needed: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """``hub, fp, overlap`` for the pairs in ``blocks`` that are similar enough.

    Texts are sent to the blocks they are needed in, LEAVES sets or so against one in each, so that no block grows with the
    number of copies.
    """
    ids = needed.select("doc_id", "text_key").distinct()
    texts = docs.select("doc_id", "text_key", "text")
    same = texts["text_key"].eqNullSafe(ids["text_key"]) & texts["doc_id"].eqNullSafe(ids["doc_id"])
    if ids.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(ids), same, "left_semi")
    else:
        texts = texts.join(ids, same, "left_semi")
    # Rows that repeat an id and its text are one.
    same = texts["text_key"].eqNullSafe(needed["text_key"]) & texts["doc_id"].eqNullSafe(needed["doc_id"])
    placed = texts.join(needed, same).select("hub", "part", "fp", (F.col("hub") != F.col("fp")).alias("leaf"), "text")
    placed = placed.repartition("hub", "part").sortWithinPartitions("hub", "part", "leaf", "fp")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, one, held, size = None, None, {}, 0

        def flushed() -> pd.DataFrame:
            overlaps = path_overlaps(one, list(held.values()), share)
            rows = [(block[0], fp, o) for fp, o in zip(held, overlaps) if o >= 0]
            held.clear()
            return pd.DataFrame(rows, columns=["hub", "fp", "overlap"])

        for batch in batches:
            for hub, part, fp, leaf, text in zip(*(batch[c] for c in ("hub", "part", "fp", "leaf", "text"))):
                if block != (hub, part):
                    if held:
                        yield flushed()
                    block, one, size = (hub, part), None, 0
                if not leaf:
                    one = shingle_set(text, words) if one is None else one
                elif fp not in held:
                    held[fp] = shingle_set(text, words)
                    size += len(held[fp])
                    if size > FLUSH:
                        yield flushed()
                        size = 0
        if held:
            yield flushed()

    return placed.mapInPandas(compared, "hub bigint, fp bigint, overlap bigint")


def enough(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The ``rows`` (``n, fp`` and others, one for each n-gram that a set shares) of sets that have as many as a similar set would share."""
    shared = F.count(F.lit(1)).over(Window.partitionBy("fp"))
    return rows.withColumn("shared", shared).filter(F.col("shared") >= least_shared("n", share)).drop("shared")


def open_runs(runs: DataFrame, classes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The rows ``gram, n, fp`` of ``runs`` in which sets of different classes meet, of sets that meet there often enough.

    Classes only grow, so what is left out here needs no comparing later.
    """
    rows = with_root(runs, classes)
    several = rows.groupBy("gram").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("gram")
    return enough(rows.join(several, "gram"), share).select("gram", "n", "fp")


def with_root(runs: DataFrame, classes: DataFrame) -> DataFrame:
    rows = runs.select("gram", "n", "fp").join(classes, F.col("fp") == F.col("node"), "left")
    return rows.select("gram", "n", "fp", F.coalesce("root", "fp").alias("root"))


def early_grams(runs: DataFrame) -> DataFrame:
    """``fp, early``: the first EARLY n-grams, by their numbers, that a set shares with others in ``runs``."""
    place = F.row_number().over(Window.partitionBy("fp").orderBy("gram"))
    first = runs.select("fp", "gram").withColumn("place", place).filter(F.col("place") <= EARLY)
    return first.groupBy("fp").agg(F.sort_array(F.collect_set("gram")).alias("early"))


def met_before(gram: int, one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether each of ``others`` (rows of early n-grams) shares an early n-gram with ``one`` that comes before ``gram``."""
    return (others[:, :, None] == one[one < gram]).any(axis=(1, 2))


def cross_pairs(
    runs: DataFrame, classes: DataFrame, sets: DataFrame, share: tuple[int, int], one_each: int | None
) -> DataFrame:
    """Pairs ``hub, fp`` of sets in one run, of fitting sizes and different classes.

    With ``one_each``, a run's sets are only paired with one of them, drawn by a hash with that seed, another in every run; else all.
    Of all pairs, only those are written whose signatures allow it. Two sets that share many n-grams meet in many runs, and are
    not written under one if an earlier one is known that both have: the first one they share always writes them.
    """
    rows = with_root(runs, classes)
    if one_each is not None:
        draw = F.min(F.struct(F.xxhash64("fp", "gram", F.lit(one_each)).alias("draw"), "fp", "n", "root")).alias("one")
        ones = rows.groupBy("gram").agg(draw).select("gram", F.col("one.fp").alias("hub"), F.col("one.n").alias("m"), F.col("one.root").alias("other"))
        over, under = share
        size = (F.least("n", "m") * under) >= (F.greatest("n", "m") * over)
        found = rows.join(ones, "gram").filter((F.col("root") != F.col("other")) & size)
        return found.select(F.least("hub", "fp").alias("hub"), F.greatest("hub", "fp").alias("fp")).distinct()

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "n", "fp", "root")]
            new.append(signatures(batch.column("bits")))
            new.append(np.full((batch.num_rows, EARLY), NO_GRAM))
            lists = batch.column("early")
            own = lists.value_lengths().to_numpy(zero_copy_only=False)
            new[-1][np.arange(EARLY) < own[:, None]] = lists.flatten().to_numpy()
            parts = new if carry is None else [np.concatenate(x) for x in zip(carry, new)]
            last = int(np.searchsorted(parts[0], parts[0][-1])) if len(parts[0]) else 0
            yield from pairs(*[x[:last] for x in parts])
            carry = [x[last:] for x in parts]
        if carry is not None:
            yield from pairs(*carry)

    def pairs(gram, n, fp, root, bits, early):
        first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1]))) if len(gram) else []
        ends = np.append(first[1:], len(gram)) if len(gram) else []
        got, held = [], 0
        for start, end in zip(first, ends):
            for row in range(start, end):
                stop = row + 1 + int(np.searchsorted(n[row + 1 : end].astype(np.int64) * share[0], int(n[row]) * share[1], side="right"))
                other = np.flatnonzero(root[row + 1 : stop] != root[row]) + row + 1
                other = other[could_be(bits[other], bits[row], n[other], n[row], share)] if len(other) else other
                other = other[~met_before(gram[row], early[row], early[other])] if len(other) else other
                if len(other):
                    got.append((np.full(len(other), fp[row]), fp[other]))
                    held += len(other)
                if held > FLUSH:
                    yield batch_of(got)
                    got, held = [], 0
        if got:
            yield batch_of(got)

    def batch_of(got):
        a, b = (np.concatenate(x) for x in zip(*got))
        both = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["hub", "fp"])

    known = sets.select("fp", "bits").join(early_grams(runs), "fp")
    rows = rows.join(known, "fp").select("gram", "n", "fp", "root", "bits", "early")
    dealt = rows.repartition("gram").sortWithinPartitions("gram", "n", "fp")
    return dealt.mapInArrow(paired, "hub bigint, fp bigint").distinct()


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, share: tuple[int, int] = SHARE
) -> tuple[DataFrame, DataFrame]:
    """Documents with their sets and classes, and the links found between sets.

    The first result has a row ``doc_id, n_shingles, component_id, set_key, n_links`` per row of ``docs``: equal sets have
    one key, ``component_id`` is the smallest id that links lead to, and ``n_links`` the number of other sets
    it was found to link with while classes were formed. The second has ``hub, fp, overlap``: pairs of set keys.

    A text that is null or has no word has an empty set, is linked with nothing and is its own class. One with
    fewer words than ``words`` has one n-gram, of all its words. Repeated rows are equal documents. A null id counts
    in no class; a class of null ids only has none. Other columns are ignored.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    about = stored(describe(rows, words), "jaccard-sets")
    per_doc = about.filter("fp is not null").select("doc_id", "text_key", "n", "fp", "bits")
    common = common_grams(about)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    sets = per_doc.filter("n > 0").groupBy("fp").agg(first, F.min("n").alias("n"), F.min("bits").alias("bits"))
    sets = stored(sets.select("fp", "first.doc_id", "first.text_key", "n", "bits"), "jaccard-firsts")

    met = stored(runs_of(prefixes(rows.select("text"), common, words, share), share), "jaccard-met")
    runs = stored(runs_of(enough(met, share).select("gram", "n", "fp"), share), "jaccard-runs")
    free(met)
    tried = links = classes = None
    for step in range(ROUNDS):
        if step == 0:
            # Large sets that meet their hub only once met it by chance; if not, a later round finds them.
            found = runs.filter("hub <> fp").select(F.least("hub", "fp").alias("hub"), F.greatest("hub", "fp").alias("fp"), least_shared("n", share).alias("least"))
            times = found.groupBy("hub", "fp").agg(F.count(F.lit(1)).alias("times"), F.min("least").alias("least"))
            pairs = times.filter("times > 1 or least = 1").select("hub", "fp")
        else:
            still = stored(open_runs(runs, classes, share), "jaccard-runs")
            free(runs)
            runs = still
            pairs = cross_pairs(runs, classes, sets, share, step if step < ROUNDS - 1 else None)
            pairs = pairs.join(tried, ["hub", "fp"], "left_anti")
        pairs = stored(pairs if step == ROUNDS - 1 else possible(pairs, sets, share), "jaccard-pairs")
        tried = pairs if tried is None else tried.unionAll(pairs)
        needed = blocks(sets, pairs)
        new = stored(similar(rows, needed, words, share), "jaccard-links")
        free(needed)
        links = new if links is None else links.unionAll(new)
        joined = new.select("hub", "fp")
        classes = star_components(joined if classes is None else joined.unionAll(classes.select("root", "node")), "hub", "fp")

    free(runs)
    degree = links.select(F.col("hub").alias("fp")).unionAll(links.select("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    named = sets.join(classes, F.col("fp") == F.col("node"), "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "root").join(degree, "fp", "left").select("fp", "component_id", "n_links")
    found = per_doc.join(named, "fp", "left")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("fp")).alias("set_key"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    ), links
