"""Content fingerprint of a cell.

``blake3`` hashes the 24 bytes of six little-endian 32-bit floats (lat, lon, sst, err, ice, anom)
with missing variables as the sentinel. Time and level are not part of it: the same place with the
same values has the same fingerprint on any day. ``sha256`` hashes the same six values as whole
ten-thousandths and stays entirely inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.blake3 import digest_words, hex_bytes
from tidegrid.functions.missing import as_column, sentinel_if_missing
from tidegrid.model import HASHED, SENTINEL

SCALE = 10000


def _float32(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype("<f4", copy=False)


def _blake3_of_batch(
    lat: pa.Array, lon: pa.Array, sst: pa.Array, err: pa.Array, ice: pa.Array, anom: pa.Array
) -> pa.Array:
    floats = np.stack([_float32(c) for c in (lat, lon, sst, err, ice, anom)])
    missing = np.isnan(floats)
    missing[:2] = False
    floats[missing] = SENTINEL
    rows = floats.shape[1]
    text = hex_bytes(digest_words(floats.view("<u4"), 24))
    offsets = np.arange(0, 64 * (rows + 1), 64, dtype=np.int32)
    return pa.StringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(text))


_blake3 = F.arrow_udf(_blake3_of_batch, T.StringType())


def _half_up(value: Column) -> Column:
    """``F.round`` of a double to whole numbers, halves away from zero, without a decimal number for each.

    ``rint`` puts halves to the even neighbour; the difference to it is exact and tells the halves that go the other way.
    """
    even = F.rint(value)
    half = value - even
    return even + F.when((half == 0.5) & (value > 0), 1.0).when((half == -0.5) & (value < 0), -1.0).otherwise(0.0)


def _scaled(value: Column) -> Column:
    return _half_up(value.cast("double") * SCALE).cast("bigint").cast("string")


def _sha256(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat_ws("|", *[_scaled(c) for c in columns]), 256)


def cell_fingerprint(
    columns: Sequence[Column | str] = HASHED, algorithm: str = "blake3"
) -> Column:
    """Fingerprint of (lat, lon, sst, err, ice, anom) as 64 hex digits."""
    lat, lon, *values = [as_column(c) for c in columns]
    if algorithm == "blake3":
        return _blake3(lat.cast("float"), lon.cast("float"), *[v.cast("float") for v in values])
    if algorithm == "sha256":
        return _sha256([lat, lon, *[sentinel_if_missing(v.cast("double")) for v in values]])
    raise ValueError(f"unknown algorithm {algorithm!r}")


def fingerprint_fallback(
    columns: Sequence[Column | str] = HASHED, algorithm: str = "blake3"
) -> Column:
    """Fingerprint of raw, possibly unreadable values.

    One value that is not a number (NULL or unreadable text) makes all four variables the sentinel;
    NaN, which is a number, makes only its own variable the sentinel.
    """
    lat, lon, *values = [as_column(c) for c in columns]
    numbers = [v.try_cast("double") for v in values]
    readable = F.lit(True)
    for number in numbers:
        readable = readable & number.isNotNull()
    safe = [F.when(readable, n).otherwise(F.lit(SENTINEL)) for n in numbers]
    return cell_fingerprint([lat.try_cast("double"), lon.try_cast("double"), *safe], algorithm)


def add_fingerprints(df: DataFrame, algorithm: str = "blake3", name: str = "spatial_hash") -> DataFrame:
    """Attach the fingerprint of every cell; a projection, so no rows move."""
    return df.withColumn(name, cell_fingerprint(HASHED, algorithm))
