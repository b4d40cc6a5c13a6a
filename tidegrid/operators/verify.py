"""Checking stored fingerprints, and the verifier lists of cells."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.fingerprint import add_fingerprints, cell_fingerprint
from tidegrid.functions.missing import as_column
from tidegrid.model import HASHED, KEY, MAX_VERIFIERS
from tidegrid.session import broadcast_if_small, settle
from tidegrid.sources.store import read_store, replace_partitions, touched


def verify_fingerprints(store: DataFrame, algorithm: str = "blake3", name: str = "spatial_hash") -> DataFrame:
    """Cells whose stored fingerprint is not that of their values; one scan, no shuffle."""
    checked = store.withColumn("expected", cell_fingerprint(HASHED, algorithm))
    return checked.filter(~F.col(name).eqNullSafe(F.col("expected")))


TILE = (72, 144)  # positions along latitude and longitude that one digest covers


def tile_digests(df: DataFrame, name: str = "fingerprint", tile: tuple[int, int] = TILE) -> DataFrame:
    """``day, tile_i, tile_j, cells, h0, h1``: what a fingerprinted grid has in each tile of each day.

    A digest is the number of cells and two sums of 64-bit hashes over key and fingerprint. Sums combine: before the
    shuffle, and over tiles to the digest of a day. Unlike XOR they also tell repeated cells apart.
    """
    hashes = [F.sum(F.xxhash64(*KEY, name, F.lit(i)).cast("decimal(38,0)")).alias(f"h{i}") for i in range(2)]
    tiled = df.select(F.to_date("time").alias("day"), *[F.floor(F.col(c) / size).cast("int").alias(t) for c, size, t in zip(("lat_idx", "lon_idx"), tile, ("tile_i", "tile_j"))], *KEY, name)
    return tiled.groupBy("day", "tile_i", "tile_j").agg(F.count("*").alias("cells"), *hashes)


def day_digests(tiles: DataFrame) -> DataFrame:
    """The digests of whole days from those of their tiles."""
    return tiles.groupBy("day").agg(*[F.sum(c).alias(c) for c in ("cells", "h0", "h1")])


def _differing(first: DataFrame, second: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys under which two tables of digests differ, or which only one of them has."""
    marked = [df.select(*on, F.struct(F.col("cells").cast("bigint"), "h0", "h1").alias(d)) for df, d in ((first, "_a"), (second, "_b"))]
    both = first.select(*on).unionByName(second.select(*on)).distinct()
    for df in marked:
        same = [both[c].eqNullSafe(df[c]) for c in on]
        both = both.join(df, functools.reduce(operator.and_, same), "left").select(*[both[c] for c in on], *[c for c in both.columns if c not in on], df[df.columns[-1]])
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*on)


def differing_tiles(first: DataFrame, second: DataFrame) -> DataFrame:
    """``day, tile_i, tile_j`` in which two grids differ, from their tile digests; equal days are left out first."""
    days = broadcast_if_small(_differing(day_digests(first), day_digests(second), ["day"]))
    kept = [df.join(days, df["day"].eqNullSafe(days["day"]), "left_semi") for df in (first, second)]
    return _differing(*kept, ["day", "tile_i", "tile_j"])


def compare_by_tiles(
    store: DataFrame,
    source: DataFrame,
    digests: DataFrame | None = None,
    algorithm: str = "blake3",
    name: str = "spatial_hash",
    tile: tuple[int, int] = TILE,
) -> DataFrame:
    """As :func:`compare_fingerprints`, looking at cells only in the tiles whose digests differ.

    ``digests`` are the ``tile_digests`` of the store if they are kept somewhere; then of the store only the days and rows
    are read that differ. Digests that are not given are computed once, so either side is read twice: whole for its digests, and
    where it differs. A difference goes unseen only if two 64-bit sums collide at once.
    """
    kept = store.select(*[c for c in ("day",) if c in store.columns], *KEY, F.col(name).alias("fingerprint"))
    fresh = add_fingerprints(source, algorithm, "fingerprint")
    stored = settle(tile_digests(kept, tile=tile)) if digests is None else digests
    found = settle(differing_tiles(stored, settle(tile_digests(fresh, tile=tile))))

    def inside(df: DataFrame) -> DataFrame:
        if "day" in df.columns:
            df = touched(df, found)
        ends = found.agg(*[f(t).alias(f"{f.__name__}_{t}") for t in ("tile_i", "tile_j") for f in (F.min, F.max)]).first()
        for c, t, size in zip(("lat_idx", "lon_idx"), ("tile_i", "tile_j"), tile):
            low, high = ends[f"min_{t}"], ends[f"max_{t}"]
            if low is not None:
                df = df.filter(F.col(c).isNull() | F.col(c).between(low * size, high * size + size - 1))
        tiles = broadcast_if_small(found)
        same = F.to_date(df["time"]).eqNullSafe(tiles["day"])
        for c, t, size in zip(("lat_idx", "lon_idx"), ("tile_i", "tile_j"), tile):
            same = same & F.floor(df[c] / size).cast("int").eqNullSafe(tiles[t])
        return df.join(tiles, same, "left_semi")

    return _compared(inside(kept).select(*KEY, "fingerprint"), inside(fresh).select(*KEY, "fingerprint"))


def equal_days(first: DataFrame, second: DataFrame) -> DataFrame:
    """Days on which two fingerprinted grids have the same cells, judged by a digest of each day."""
    a, b = day_digests(tile_digests(first)), day_digests(tile_digests(second))
    return a.join(b, ["day", "cells", "h0", "h1"], "left_semi").select("day")


def compare_fingerprints(
    store: DataFrame,
    source: DataFrame,
    algorithm: str = "blake3",
    name: str = "spatial_hash",
    skip_equal_days: bool = False,
) -> DataFrame:
    """Cells in which a store and a source differ: ``changed``, ``missing`` or ``extra`` in the store.

    Both sides are joined on the whole cell key, which spreads any dominating day. With
    ``skip_equal_days`` days with equal roll-ups are left out first, so that a mostly equal pair is
    read twice but hardly shuffled; two different days pass as equal only if both sums of hashes collide.
    """
    kept = store.select(*KEY, F.col(name).alias("fingerprint"))
    fresh = add_fingerprints(source, algorithm, "fingerprint").select(*KEY, "fingerprint")
    if skip_equal_days:
        same = broadcast_if_small(equal_days(kept, fresh))
        kept, fresh = (df.join(same, F.to_date("time") == same["day"], "left_anti") for df in (kept, fresh))
    return _compared(kept, fresh)


def _compared(kept: DataFrame, fresh: DataFrame) -> DataFrame:
    """The cells in which two grids ``KEY, fingerprint`` differ, with a ``status``."""
    kept = kept.withColumnRenamed("fingerprint", "stored").withColumn("_stored", F.lit(True))
    fresh = fresh.withColumnRenamed("fingerprint", "expected").withColumn("_source", F.lit(True))
    joined = kept.join(fresh, KEY, "full_outer")
    status = (
        F.when(F.col("_stored").isNull(), "missing")
        .when(F.col("_source").isNull(), "extra")
        .when(~F.col("stored").eqNullSafe(F.col("expected")), "changed")
    )
    return joined.withColumn("status", status).filter(F.col("status").isNotNull()).drop("_stored", "_source")


def empty_verifiers(slots: int = MAX_VERIFIERS) -> Column:
    """The list of a cell nobody has verified: ``slots`` empty strings."""
    return F.array_repeat(F.lit(""), slots)


def add_verifiers(df: DataFrame, slots: int = MAX_VERIFIERS, name: str = "verifier_pubkeys") -> DataFrame:
    return df.withColumn(name, empty_verifiers(slots))


def _filled(verifiers: Column | str) -> Column:
    return F.filter(as_column(verifiers), lambda v: v != "")


def _accepted(
    df: DataFrame, keys: DataFrame, order_by: str, on: Sequence[str], slots: int, name: str
) -> DataFrame:
    """The keys that get a slot: the earliest ones of a cell that fit and are not in its list yet.

    A list holds at most ``slots`` keys, so the first ``2 * slots`` different keys of a cell always
    contain every key that can still be added; later ones need not be looked at. Duplicates collapse
    first, spread by cell and key, and the ranking limits each map task to that many keys per cell
    before they meet, so a cell with very many keys never gathers them in one place.
    """
    different = keys.groupBy(*on, "pubkey").agg(F.min(order_by).alias("_order"))
    in_order = Window.partitionBy(*on).orderBy("_order", "pubkey")
    first = different.withColumn("_place", F.row_number().over(in_order)).filter(F.col("_place") <= 2 * slots)
    lists = df.select(*on, F.col(name).alias("_list"))
    fresh = first.join(lists, list(on)).filter(~F.array_contains("_list", F.col("pubkey")))
    ranked = fresh.withColumn("_rank", F.row_number().over(in_order))
    return ranked.filter(F.col("_rank") <= slots - F.size(_filled("_list")))


def append_verifier(
    df: DataFrame,
    keys: DataFrame,
    order_by: str = "seq",
    on: Sequence[str] = KEY,
    slots: int = MAX_VERIFIERS,
    name: str = "verifier_pubkeys",
) -> DataFrame:
    """Put the keys of ``keys(<cell key>, pubkey, <order_by>)`` into the first empty slots of their cells.

    A key already in the list is not added again, so a repeated delivery changes nothing. Keys that
    find no slot are reported by :func:`verifier_status`.
    """
    accepted = _accepted(df, keys, order_by, on, slots, name)
    in_order = F.array_sort(F.collect_list(F.struct("_rank", "pubkey")))
    added = accepted.groupBy(*on).agg(F.transform(in_order, lambda x: x["pubkey"]).alias("_added"))
    filled = F.concat(_filled(name), F.coalesce(F.col("_added"), F.array().cast("array<string>")))
    # A list that is longer already is not shortened.
    length = F.greatest(F.lit(slots), F.size(_filled(name)), F.size(name))
    padded = F.slice(F.concat(filled, empty_verifiers(slots), F.array_repeat(F.lit(""), F.size(name))), F.lit(1), length)
    return df.join(added, list(on), "left").withColumn(name, padded).drop("_added")


def append_verifier_to_store(keys: DataFrame, path: str, order_by: str = "seq", slots: int = MAX_VERIFIERS) -> None:
    """:func:`append_verifier` on the store at ``path``: only the days that have keys are read and written.

    The days are literals in the plan, so the cost follows them and not the size of the store. Safe to run again.
    """
    keys = settle(keys)
    store = read_store(keys.sparkSession, path)
    days = touched(store, keys.select(F.to_date("time").alias("day")))
    replace_partitions(append_verifier(days, keys, order_by, slots=slots).select(store.columns), path)


def verifier_status(
    df: DataFrame,
    keys: DataFrame,
    order_by: str = "seq",
    on: Sequence[str] = KEY,
    slots: int = MAX_VERIFIERS,
    name: str = "verifier_pubkeys",
) -> DataFrame:
    """What becomes of each key: ``stored``, ``present`` already, list ``full``, or ``no_cell``."""
    accepted = _accepted(df, keys, order_by, on, slots, name)
    got = accepted.select(*on, "pubkey", F.lit(True).alias("_got"))
    lists = df.select(*on, F.col(name).alias("_list"))
    joined = keys.join(lists, list(on), "left").join(got, [*on, "pubkey"], "left")
    status = (
        F.when(F.col("_list").isNull(), "no_cell")
        .when(F.array_contains("_list", F.col("pubkey")), "present")
        .when(F.col("_got"), "stored")
        .otherwise("full")
    )
    return joined.withColumn("status", status).select(*keys.columns, "status")
