"""Text for reports and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.missing import as_column, is_missing
from tidegrid.functions.times import iso_text


def two_decimals(value: Column | str) -> Column:
    """Half-up to two decimals as text, built from whole hundredths so engines agree; missing is ``nan``.

    Infinity is ``inf`` or ``-inf``. What rounds to zero has no sign.
    """
    value = as_column(value).cast("double")
    infinite = F.abs(value) == float("inf")
    hundredths = F.round(F.abs(F.when(~infinite, value)) * 100).cast("bigint")
    sign = F.when((value < 0) & (hundredths > 0), F.lit("-")).otherwise(F.lit(""))
    whole = F.floor(hundredths / 100).cast("string")
    part = F.lpad((hundredths % 100).cast("string"), 2, "0")
    text = F.when(is_missing(value), F.lit("nan")).when(infinite, F.when(value > 0, "inf").otherwise("-inf"))
    return text.otherwise(F.concat(sign, whole, F.lit("."), part))


def format_stat(value: Column | str, width: int = 10, unit: str = "") -> Column:
    """Two decimals, right-aligned in ``width``; longer text is kept whole."""
    text = F.concat(two_decimals(value), F.lit(unit))
    return F.when(F.length(text) < width, F.lpad(text, width, " ")).otherwise(text)


def json_text(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON document, instants as ISO text."""
    fields = [
        (iso_text(c) if t.startswith("timestamp") else F.col(c)).alias(c) for c, t in df.dtypes
    ]
    return df.select(F.to_json(F.struct(*fields)).alias(name))
