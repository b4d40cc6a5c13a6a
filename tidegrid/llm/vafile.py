"""Clustering around centroids (k-means in whole numbers) over a vector-approximation file.

Each vector is kept twice: whole, in a file of fixed-size records, and as an approximation, a row of a table: the number
of a cell, a few bits, for each component, and the squared length. A round reads approximations only. For a cell
and a centroid a table has the least and the greatest that the component can add to the distance; their sums over the
components are an interval for each centroid. A vector whose best interval lies below all others is assigned. Where
intervals overlap, the vector is fetched from its file and measured.

Sums over clusters are kept from round to round: a vector is fetched as well when it changes its cluster, to be taken
off one sum and added to another. What cluster it was in follows from the centroids of the round before, so no state
has to be stored, and a task that is run again does the same.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import stored
from tidegrid.llm.warc import open_path
from tidegrid.session import scratch_path

SCALE = 1024
BITS = 8  # of a cell: up to so many, one byte each
SAMPLE = 4096  # vectors, those with the smallest hashes, whose quantiles bound the cells; no bearing on results
PER_TASK = 64  # of them from one task, at most; not below the number of centroids
LONGEST = 1 << 28  # length of a vector in whole numbers, up to which all arithmetic is exact in 64 bits
AT_ONCE = 4096
GAP = 64  # vectors between two that are fetched which are read along rather than skipped


def kept_vectors(table: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` (array<double>): rows with ``dims`` components, all of them finite, not longer than LONGEST."""
    largest = F.lit(LONGEST / SCALE)
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    # NaN is greater than any number, so neither it nor infinity passes.
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) <= largest))
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (F.floor(x * SCALE) * F.floor(x * SCALE)).cast("double"))
    fits = F.when((F.size("vector") == dims) & finite, squared <= float(LONGEST) ** 2)
    return rows.filter(F.coalesce(fits, F.lit(False)))


def whole_numbers(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a batch as floor(1024 * x), a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(values.reshape(-1, dims) * SCALE).astype(np.int64)


def survey(vectors: DataFrame, dims: int, seed: int, per_task: int) -> DataFrame:
    """From each task its smallest and largest components and ``per_task`` vectors with the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, best = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            values = whole_numbers(batch.column(1), dims)
            ends = values.min(0), values.max(0)
            low, high = (ends if low is None else (np.minimum(low, ends[0]), np.maximum(high, ends[1])))
            hashes = batch.column(0).to_pylist()
            limit = best[-1][0] if len(best) == per_task else "g"
            near = [(h, values[i].tolist()) for i, h in enumerate(hashes) if h <= limit]
            best = heapq.nsmallest(per_task, best + near)
        rows = [("sample", h, v) for h, v in best]
        rows += [("low", "", low.tolist()), ("high", "", high.tolist())] if low is not None else []
        yield pa.RecordBatch.from_pylist(
            [{"kind": k, "hash": h, "vector": v} for k, h, v in rows],
            schema=pa.schema([("kind", pa.string()), ("hash", pa.string()), ("vector", pa.list_(pa.int64()))]),
        )

    name = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    hashed = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("hash"), "vector")
    return stored(hashed.mapInArrow(run, "kind string, hash string, vector array<bigint>"), "vectors-survey")


def cell_edges(sample: np.ndarray, bits: int) -> np.ndarray:
    """For each component the inner bounds of its cells (cells x dims): quantiles of the sample."""
    shares = np.linspace(0, 1, (1 << bits) + 1)[1:-1]
    return np.ceil(np.quantile(sample, shares, axis=0)).astype(np.int64)


def cells_of(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The cell of every component: how many edges lie at or below it."""
    out = np.empty(values.shape, np.uint8)
    for d in range(values.shape[1]):
        out[:, d] = np.searchsorted(edges[:, d], values[:, d], side="right")
    return out


class Approximations:
    """Cells and the file of whole vectors behind them; all that tasks share of it is bounds of cells."""

    def __init__(self, folder: str, dims: int, edges: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.folder, self.dims, self.edges = folder, dims, edges
        # The least and greatest value in each cell; a cell between equal edges is empty.
        self.least = np.concatenate((np.minimum(low, edges[0])[None], edges))
        self.greatest = np.concatenate((edges - 1, np.maximum(high, edges[-1])[None]))
        self.greatest = np.maximum(self.greatest, self.least)

    def build(self, vectors: DataFrame) -> DataFrame:
        """Write whole vectors to files, one a task, and return ``vec_id, file, place, squared, cells``."""
        folder, dims, edges = self.folder, self.dims, self.edges

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, root = open_path(folder)
            files.create_dir(root, recursive=True)
            name = f"vectors-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
            place = 0
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                for batch in batches:
                    values = whole_numbers(batch.column(1), dims)
                    out.write(values.astype("<i4").tobytes())
                    rows = len(values)
                    cells = pa.FixedSizeBinaryArray.from_buffers(pa.binary(dims), rows, [None, pa.py_buffer(cells_of(values, edges).tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0),
                            pa.array([name] * rows, pa.string()),
                            pa.array(np.arange(place, place + rows)),
                            pa.array((values * values).sum(1)),
                            cells.cast(pa.binary()),
                        ],
                        ["vec_id", "file", "place", "squared", "cells"],
                    )
                    place += rows

        schema = "vec_id bigint, file string, place bigint, squared bigint, cells binary"
        return stored(vectors.mapInArrow(run, schema), "vectors-cells")


class Intervals:
    """Look-up tables of one set of centroids: what a cell adds at least and at most to the distance from each."""

    def __init__(self, space: Approximations, centroids: np.ndarray):
        self.centroids, self.squared = centroids, (centroids * centroids).sum(1)
        # (v - c)^2 = v^2 - 2 c v + c^2, of which the approximation has v^2 whole.
        one = -2 * space.least[:, :, None] * centroids.T[None]
        other = -2 * space.greatest[:, :, None] * centroids.T[None]
        both = np.concatenate((np.minimum(one, other), np.maximum(one, other)), axis=2)
        self.tables = np.ascontiguousarray(both.transpose(1, 0, 2))

    def candidates(self, cells: np.ndarray, squared: np.ndarray) -> np.ndarray:
        """Which centroids may be nearest: their interval begins at or below where the lowest one ends."""
        count = len(self.centroids)
        total = np.zeros((len(cells), 2 * count), np.int64)
        for d, table in enumerate(self.tables):
            total += table.take(cells[:, d], axis=0)
        low = total[:, :count] + (squared[:, None] + self.squared)
        high = total[:, count:] + (squared[:, None] + self.squared)
        return low <= high.min(1)[:, None]

    def distances(self, values: np.ndarray) -> np.ndarray:
        return (values * values).sum(1)[:, None] + self.squared - 2 * (values @ self.centroids.T)

    def settle(self, may: np.ndarray, open_rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row, the first of equals; ``values`` are the vectors of ``open_rows``."""
        nearest = may.argmax(1)
        far = np.iinfo(np.int64).max
        nearest[open_rows] = np.where(may[open_rows], self.distances(values), far).argmin(1)
        return nearest


class Fetcher:
    """Whole vectors by file and place; vectors close to one another are read together."""

    def __init__(self, folder: str, dims: int):
        self.folder, self.dims, self.name, self.file = folder, dims, None, None

    def open(self, name: str) -> None:
        if name != self.name:
            self.close()
            files, root = open_path(self.folder)
            self.name, self.file = name, files.open_input_file(f"{root}/{name}")

    def close(self) -> None:
        if self.file is not None:
            self.file.close()

    def __call__(self, names: np.ndarray, places: np.ndarray) -> np.ndarray:
        out = np.empty((len(places), self.dims), np.int64)
        size = 4 * self.dims
        breaks = np.flatnonzero((names[1:] != names[:-1]) | (np.diff(places) > GAP) | (np.diff(places) < 0)) + 1
        for run in np.split(np.arange(len(places)), breaks):
            if len(run):
                self.open(names[run[0]])
                first, last = int(places[run[0]]), int(places[run[-1]])
                raw = self.file.read_at((last + 1 - first) * size, first * size)
                found = np.frombuffer(raw, "<i4").reshape(-1, self.dims)
                out[run] = found[places[run] - first]
        return out


def _batches(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``file, place, squared, cells`` of a batch, some thousand rows at a time."""
    for start in range(0, batch.num_rows, AT_ONCE):
        part = batch.slice(start, AT_ONCE)
        cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, dims)
        names = part.column("file").to_numpy(zero_copy_only=False)
        yield names, part.column("place").to_numpy(), part.column("squared").to_numpy(), cells


def changes(approximated: DataFrame, space: Approximations, before: np.ndarray | None, now: np.ndarray) -> tuple[np.ndarray, list[list[int]], int]:
    """What the sums over clusters change by from the centroids ``before`` to ``now``: counts, sums, vectors fetched.

    Without ``before`` they are the sums themselves. Sums are formed in each task and added up by Spark, one number for each
    centroid and component.
    """
    dims, count = space.dims, len(now)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = Fetcher(space.folder, dims)
        new = Intervals(space, now)
        old = None if before is None else Intervals(space, before)
        sums, members, fetched = np.zeros((count, dims), np.int64), np.zeros(count, np.int64), 0
        for batch in batches:
            for names, places, squared, cells in _batches(batch, dims):
                may = new.candidates(cells, squared)
                if old is None:
                    wanted = np.ones(len(cells), bool)
                else:
                    might = old.candidates(cells, squared)
                    wanted = (may.sum(1) > 1) | (might.sum(1) > 1) | (may.argmax(1) != might.argmax(1))
                rows = np.flatnonzero(wanted)
                if not len(rows):
                    continue
                values = fetch(names[rows], places[rows])
                fetched += len(rows)
                nearest = new.settle(may[rows], np.arange(len(rows)), values)
                moved = np.ones(len(rows), bool)
                if old is not None:
                    was = old.settle(might[rows], np.arange(len(rows)), values)
                    moved = was != nearest
                    np.subtract.at(sums, was[moved], values[moved])
                    members -= np.bincount(was[moved], minlength=count)
                np.add.at(sums, nearest[moved], values[moved])
                members += np.bincount(nearest[moved], minlength=count)
        fetch.close()
        rows = [{"place": -1, "sums": [fetched]}, {"place": -2, "sums": members.tolist()}]
        rows += [{"place": i, "sums": s} for i, s in enumerate(sums.tolist())]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("place", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    parts = approximated.select("file", "place", "squared", "cells").mapInArrow(run, "place bigint, sums array<bigint>")
    numbers = parts.select("place", F.posexplode("sums").alias("at", "number"))
    total = numbers.groupBy("place", "at").agg(F.sum(F.col("number").cast("decimal(38,0)")).alias("number"))
    found = {(row.place, row.at): int(row.number) for row in total.collect()}  # centroids times components
    members = np.array([found.get((-2, k), 0) for k in range(count)], object)
    sums = [[found.get((k, d), 0) for d in range(dims)] for k in range(count)]
    return members, sums, found.get((-1, 0), 0)


def assigned(approximated: DataFrame, space: Approximations, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector; each is fetched once, for its distance."""
    dims = space.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch, intervals = Fetcher(space.folder, dims), Intervals(space, centroids)
        for batch in batches:
            clusters, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for names, places, squared, cells in _batches(batch, dims):
                may = intervals.candidates(cells, squared)
                values = fetch(names, places)
                open_rows = np.flatnonzero(may.sum(1) > 1)
                nearest = intervals.settle(may, open_rows, values[open_rows])
                clusters.append(nearest)
                distances.append(((values - centroids[nearest]) ** 2).sum(1))
            columns = [batch.column("vec_id"), pa.array(np.concatenate(clusters).astype(np.int32)), pa.array(np.concatenate(distances))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])
        fetch.close()

    return approximated.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster_vectors(
    table: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    seed: int = 3,
    bits: int = BITS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector, and the centroids.

    Vectors are kept that have ``dims`` components, none of them null or not finite, and a length up to 262,144, where
    64-bit arithmetic is exact; each component becomes floor(1024 * x). The first centroids are the ``k`` vectors with the
    smallest SHA-256 of seed and id, fewer if there are fewer vectors; those with one hash come in the order of their
    components. A round moves each vector to the nearest centroid, the first of equals, and each centroid that has
    vectors to the floor of their mean. Rounds end early only when nothing can change any more.

    A null id hashes as an empty one; repeated ids and rows are vectors each. Without a kept vector the result is empty. Inertias
    are sums of squared distances, null if beyond 64 bits. Other columns are ignored.
    """
    spark = table.sparkSession
    vectors = kept_vectors(table, dims, id_col, vector_col)
    seen = survey(vectors, dims, seed, max(k, PER_TASK))
    at = seen.filter("kind <> 'sample'").select("kind", F.posexplode("vector").alias("at", "x")).groupBy("at")
    ends = at.agg(F.min(F.when(F.col("kind") == "low", F.col("x"))).alias("low"), F.max(F.when(F.col("kind") == "high", F.col("x"))).alias("high"))
    ends = ends.orderBy("at").collect()  # two numbers for each component
    sample = seen.filter("kind = 'sample'").orderBy("hash", "vector").limit(SAMPLE).select("vector").collect()
    shape = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not sample:
        return spark.createDataFrame([], shape), []
    drawn = np.array([row.vector for row in sample], np.int64)
    low, high = (np.array([row[i] for row in ends], np.int64) for i in (1, 2))
    space = Approximations(scratch_path(spark, "vectors"), dims, cell_edges(drawn, bits), low, high)
    approximated = space.build(vectors)
    centroids, before = drawn[:k].copy(), None
    members, sums = [0] * len(centroids), [[0] * dims for _ in centroids]
    for _ in range(rounds):
        more, by, _ = changes(approximated, space, before, centroids)
        members = [a + b for a, b in zip(members, more)]
        sums = [[a + b for a, b in zip(s, t)] for s, t in zip(sums, by)]
        means = [[x // n for x in s] if n else c for s, n, c in zip(sums, members, centroids.tolist())]
        before, centroids = centroids, np.array(means, np.int64)
        if (before == centroids).all():
            break
    found = stored(assigned(approximated, space, centroids), "vectors-assigned")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_inertia")).collect()  # k rows
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = sum(int(row._inertia) for row in inertia)
    fit = [(row.cluster, int(row._inertia), digest[row.cluster]) for row in inertia]
    largest = (1 << 63) - 1
    known = [(c, i if i <= largest else None, d) for c, i, d in fit]
    each = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    out = found.join(F.broadcast(each), "cluster").withColumn("inertia", F.lit(total if total <= largest else None).cast("bigint"))
    return out.select(*[c.split()[0] for c in shape.split(", ")]), centroids.tolist()
