"""A caller's function over the cells of a grid."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_cellwise(
    df: DataFrame, function: Callable, columns: Sequence[str], name: str, return_type: str = "double"
) -> DataFrame:
    """Add ``name = function(*columns)``; the function gets pandas Series of a whole Arrow batch."""

    def batches(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in parts:
            yield function(*part) if isinstance(part, tuple) else function(part)

    return df.withColumn(name, F.pandas_udf(batches, return_type)(*columns))
