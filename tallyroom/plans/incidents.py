"""Fire-department calls: kinds, busy times and places, response times, storage round trips.

The text dates are turned into timestamps by `with_times`. Run that once and store the result as
Parquet; the questions below then read the two or three columns each of them needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import (
    CLOCK_12H,
    SLASHED_DAY,
    in_year,
    parse_local_timestamp,
    parse_timestamp,
)
from tallyroom.operators import count_by, mean_by, swap_columns, top_n
from tallyroom.sinks import replace_table, write_parquet
from tallyroom.sources import read_parquet

# Columns of the fire-call file, in file order.
FIRE_COLUMNS = (
    "CallNumber INT, UnitID STRING, IncidentNumber INT, CallType STRING, CallDate STRING, "
    "WatchDate STRING, CallFinalDisposition STRING, AvailableDtTm STRING, Address STRING, "
    "City STRING, Zipcode INT, Battalion STRING, StationArea STRING, Box STRING, "
    "OriginalPriority STRING, Priority STRING, FinalPriority INT, ALSUnit BOOLEAN, "
    "CallTypeGroup STRING, NumAlarms INT, UnitType STRING, UnitSequenceInCallDispatch INT, "
    "FirePreventionDistrict STRING, SupervisorDistrict STRING, Neighborhood STRING, "
    "Location STRING, RowID STRING, Delay FLOAT"
)


def with_times(calls: DataFrame, local: bool = False) -> DataFrame:
    """Timestamps IncidentDate, OnWatchDate and AvailableDtTS in place of their text columns.

    They are in the session time zone or, with `local`, without one.
    """
    parse = parse_local_timestamp if local else parse_timestamp
    return swap_columns(
        calls,
        {
            "IncidentDate": parse(F.col("CallDate"), SLASHED_DAY),
            "OnWatchDate": parse(F.col("WatchDate"), SLASHED_DAY),
            "AvailableDtTS": parse(F.col("AvailableDtTm"), CLOCK_12H),
        },
        drop=["CallDate", "WatchDate", "AvailableDtTm"],
    )


def _of_kind(kind: str, year: int | None = None) -> Column:
    chosen = F.col("CallType").contains(kind)
    return chosen if year is None else chosen & in_year(F.col("IncidentDate"), year)


def call_types(calls: DataFrame, year: int = 2018) -> DataFrame:
    """Frequency of every kind of call in a year; reads the date as text, before `with_times`."""
    known = F.col("CallType").isNotNull() & F.col("CallDate").contains(str(year))
    counts = count_by(calls, ["CallType"], where=known)
    return counts.orderBy(F.desc("count"), "CallType")


def busiest_month(calls: DataFrame, year: int = 2018, kind: str = "Fire", n: int = 1) -> DataFrame:
    month = F.month("IncidentDate").alias("month")
    counts = count_by(calls, [month], where=_of_kind(kind, year))
    return top_n(counts, n, [F.desc("count")], tiebreak=["month"])


def top_areas(
    calls: DataFrame, kind: str = "Fire", city: str = "SF", year: int | None = None, n: int = 3
) -> DataFrame:
    """Neighbourhoods with most calls, of all years unless one is named."""
    chosen = _of_kind(kind, year) & F.col("City").contains(city)
    counts = count_by(calls, ["Neighborhood"], where=chosen)
    return top_n(counts, n, [F.desc("count")], tiebreak=["Neighborhood"])


def slowest_areas(calls: DataFrame, year: int = 2018, kind: str = "Fire", n: int = 10) -> DataFrame:
    """Neighbourhoods with the longest mean delay."""
    means = mean_by(calls, ["Neighborhood"], {"avg_delay": "Delay"}, where=_of_kind(kind, year))
    return top_n(means, n, [F.desc("avg_delay")], tiebreak=["Neighborhood"])


def busiest_week(calls: DataFrame, year: int = 2018, kind: str = "Fire", n: int = 1) -> DataFrame:
    """ISO week with most calls; the last days of December can belong to week 1."""
    week = F.weekofyear("IncidentDate").alias("Week")
    counts = count_by(calls, [week], where=_of_kind(kind, year))
    return top_n(counts, n, [F.desc("count")], tiebreak=["Week"])


def area_zip_counts(calls: DataFrame, kind: str = "Fire") -> DataFrame:
    """Calls per neighbourhood and zip code, unknown ones included."""
    return count_by(calls, ["Neighborhood", "Zipcode"], where=_of_kind(kind))


def roundtrip_parquet(df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path, mode="overwrite")
    return read_parquet(df.sparkSession, path)


def roundtrip_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Replace a table by the frame, which may read that table, and read it back by name."""
    return replace_table(df, table, path)
