"""Candy counts and bike trips: counts per group, and one file read under three schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyroom.operators import count_by, frame_report, in_order
from tallyroom.sources import read_csv

# Columns of the bike-trip file, in file order.
TRIP_COLUMNS = (
    "trip_id INT, starttime STRING, stoptime STRING, bikeid INT, tripduration INT, "
    "from_station_id INT, from_station_name STRING, to_station_id INT, to_station_name STRING, "
    "usertype STRING, gender STRING, birthyear INT"
)


# Columns of the candy file, in file order.
CANDY_COLUMNS = "State STRING, Color STRING, Count INT"


def trip_struct() -> StructType:
    """`TRIP_COLUMNS` as a `StructType`."""
    return StructType.fromDDL(TRIP_COLUMNS)


def candy_counts(
    candy: DataFrame, state: str | None = None, how: str = "values", n: int | None = None
) -> DataFrame:
    """Entries per state and colour, most frequent first; `how="sum"` adds the counts up."""
    where = None if state is None else F.col("State") == state
    totals = count_by(candy, ["State", "Color"], "Count", how, name="Total", where=where)
    return in_order(totals, n, [F.desc("Total")], tiebreak=["State", "Color"])


def schema_trio(
    spark: SparkSession,
    path: str,
    struct: StructType | None = None,
    ddl: str = TRIP_COLUMNS,
) -> DataFrame:
    """The reports of one CSV file read with inferred types, a `StructType` and a DDL string."""
    schemas = {"inferred": None, "struct": struct or trip_struct(), "ddl": ddl}
    reports = [
        frame_report(read_csv(spark, path, schema), mode) for mode, schema in schemas.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def count_for(
    df: DataFrame,
    column: str = "gender",
    value: str = "Female",
    key: str | Column = "to_station_name",
    n: int | None = 10,
) -> DataFrame:
    """Rows per `key` among those with one value, most frequent first."""
    counts = count_by(df, [key], where=F.col(column) == value)
    return in_order(counts, n, [F.desc("count")], tiebreak=[counts.columns[0]])
