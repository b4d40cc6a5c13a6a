"""Dates in file names and object addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.functions.missing import as_column


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(as_column(path), "/"), -1)


def strip_suffix(name: Column | str, suffix: str = "") -> Column:
    """Remove a marker such as ``_preliminary`` wherever it occurs in the name."""
    name = as_column(name)
    return F.replace(name, F.lit(suffix), F.lit("")) if suffix else name


def noon_of(date: Column | str) -> Column:
    """12:00:00 of a date."""
    return as_column(date).cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")


def file_date(path: Column | str, suffix: str = "", on_error: str = "null") -> Column:
    """The date in the first ``.YYYYMMDD.`` of the file name, as midnight.

    A name without one, or with an impossible date, gives NULL, or with ``on_error='raise'`` fails
    the job.
    """
    path = as_column(path)
    name = strip_suffix(base_name(path), suffix)
    digits = F.regexp_extract(name, r"\.(\d{8})\.", 1)
    date = F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd").cast("timestamp_ntz")
    if on_error == "raise":
        message = F.concat(F.lit("no valid date in the form .YYYYMMDD. in file name: "), name)
        date = F.coalesce(date, F.when(path.isNotNull(), F.raise_error(message)).cast("timestamp_ntz"))
    return date


def dotted_date(name: Column | str) -> Column:
    """The second-last dot-separated part of a name; NULL when there is no dot."""
    return F.try_element_at(F.split(as_column(name), "[.]"), F.lit(-2))


def object_uri(bucket: Column | str, key: Column | str) -> Column:
    """``s3://bucket/key``; the key is used as it comes, without URL decoding."""
    return F.concat(F.lit("s3://"), as_column(bucket), F.lit("/"), as_column(key))


def strip_scheme(uri: Column | str) -> Column:
    return F.replace(as_column(uri), F.lit("s3://"), F.lit(""))


def split_uri(uri: Column | str) -> Column:
    """``struct(bucket, key)`` of an address; inverse of :func:`object_uri`."""
    rest = strip_scheme(uri)
    slash = F.instr(rest, "/")
    bucket = F.when(slash > 0, F.substr(rest, F.lit(1), slash - 1)).otherwise(rest)
    key = F.when(slash > 0, F.substr(rest, slash + 1))
    return F.struct(bucket.alias("bucket"), key.alias("key"))
