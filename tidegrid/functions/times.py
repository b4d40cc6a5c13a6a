"""Instants as UTC ``timestamp_ntz`` and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.functions.missing import as_column

EPOCH = "1970-01-01 00:00:00"


def instant_to_utc(instant: Column | str) -> Column:
    """A zoned ``timestamp`` as its UTC wall clock, whatever the session zone is."""
    epoch = F.lit(EPOCH).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_column(instant)), epoch)


def to_utc(text: Column | str) -> Column:
    """ISO-8601 text to a UTC instant; text without an offset is UTC. Unreadable text gives NULL."""
    text = F.trim(as_column(text))
    zoned = text.rlike(r"[T ].*(Z|[+-]\d{2}(:?\d{2})?)$")
    timed = text.rlike(r"[T ]")
    explicit = (
        F.when(zoned, text)
        .when(timed, F.concat(text, F.lit("+00:00")))
        .otherwise(F.concat(text, F.lit("T00:00:00+00:00")))
    )
    return instant_to_utc(F.try_to_timestamp(explicit))


def iso_text(instant: Column | str) -> Column:
    """ISO-8601 text with offset of a UTC instant, microseconds only when there are any."""
    instant = as_column(instant)
    seconds = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(instant, "SSSSSS")
    return F.concat(seconds, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))


def date_part(instant: Column | str) -> Column:
    return F.to_date(as_column(instant))


def format_day(instant: Column | str) -> Column:
    """``YYYYMMDD`` text."""
    return F.date_format(as_column(instant), "yyyyMMdd")
