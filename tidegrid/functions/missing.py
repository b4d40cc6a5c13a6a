"""Missing values: NaN or NULL on the way in, NULL inside, a sentinel where bytes are hashed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_missing(value: Column | str) -> Column:
    value = as_column(value)
    return value.isNull() | F.isnan(value)


def null_if_missing(value: Column | str) -> Column:
    """NaN becomes NULL, which Spark's aggregates skip; NaN itself would win ``max`` and stick in ``avg``."""
    value = as_column(value)
    return F.when(~F.isnan(value), value)


def sentinel_if_missing(value: Column | str, sentinel: float = -999.0) -> Column:
    value = as_column(value)
    return F.when(is_missing(value), F.lit(sentinel)).otherwise(value)


def mask_missing(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """NaN of the named variables becomes NULL."""
    return df.withColumns({v: null_if_missing(v) for v in variables})


def fill_sentinel(df: DataFrame, variables: Sequence[str], sentinel: float = -999.0) -> DataFrame:
    """Missing of the named variables becomes ``sentinel``; a true value equal to it cannot be told apart."""
    types = dict(df.dtypes)
    return df.withColumns({v: sentinel_if_missing(v, sentinel).cast(types[v]) for v in variables})
