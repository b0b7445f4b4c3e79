"""Date and year expressions; input that does not parse gives null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_date(c: Column) -> Column:
    """``2019-04-01T18:22:01.123Z`` as a date."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).cast("date")


def epoch_date(c: Column) -> Column:
    return F.timestamp_seconds(c)


def first_year(c: Column) -> Column:
    """Year prefix of ``yyyy-MM-dd``."""
    return F.substring(c, 1, 4).try_cast("int")


def last_year(c: Column) -> Column:
    """Last whitespace token when it is a four-digit year (``Oct 21, 2008``)."""
    return F.regexp_extract(F.trim(c), r"(?:^|\s)([0-9]{4})$", 1).try_cast("int")
