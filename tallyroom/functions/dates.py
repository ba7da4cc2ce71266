"""Dates and times from text. Malformed text gives null, whatever the session's ANSI setting."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the date and time columns in the input files.
SLASHED_DAY = "MM/dd/yyyy"
CLOCK_12H = "MM/dd/yyyy hh:mm:ss a"
COMPACT_DAY = "yyyyMMdd"
MONTH_DAY_TIME = "MMddHHmm"

TIME_LETTERS = set("aHhKkmsS")


def parse_timestamp(text: Column, pattern: str) -> Column:
    """Timestamp in the session time zone. A time that the zone skips, when its clocks go forward,
    comes out an hour later."""
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_local_timestamp(text: Column, pattern: str) -> Column:
    """Timestamp without a time zone, which keeps every time as written. A pattern with a time of
    day is parsed twice: once to see whether it can be, once for its value."""
    if not TIME_LETTERS & set(pattern):
        return parse_date(text, pattern).cast("timestamp_ntz")
    valid = parse_timestamp(text, pattern).isNotNull()
    return F.when(valid, F.to_timestamp_ntz(text, F.lit(pattern)))


def parse_date(text: Column, pattern: str) -> Column:
    """Date. Pattern parts that are absent take 1970-01-01, so a year-less 29 February is null."""
    return F.try_to_date(text, pattern)


def leap_safe_date(text: Column, pattern: str = MONTH_DAY_TIME) -> Column:
    """Date of year-less text placed in the leap year 2000, so that 29 February survives."""
    return F.try_to_date(F.concat(F.lit("2000"), text), f"yyyy{pattern}")


def in_year(moment: Column, year: int | str) -> Column:
    """`year(moment) == year` as a range, which Parquet can use to skip row groups."""
    first = datetime.date(int(year), 1, 1)
    following = datetime.date(int(year) + 1, 1, 1)
    return (moment >= F.lit(first)) & (moment < F.lit(following))
