"""Weather records: fixed-width lines to typed columns, monthly means and spreads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import Field
from tallyroom.operators import in_order, mean_by, parse_fixed_width, stddev_by
from tallyroom.sinks import write_csv, write_joined_csv, write_parquet, write_single_csv, write_together
from tallyroom.sources import read_parquet

# Name, start, length, type and divisor of the columns of a weather line.
WEATHER_FIELDS = (
    Field("WeatherStation", 5, 6),
    Field("WBAN", 11, 5),
    Field("ObservationDate", 16, 8, "date"),
    Field("ObservationHour", 24, 4, "int"),
    Field("Latitude", 29, 6, "float", 1000),
    Field("Longitude", 35, 7, "float", 1000),
    Field("Elevation", 47, 5, "int"),
    Field("WindDirection", 61, 3, "int"),
    Field("WDQualityCode", 64, 1, "int"),
    Field("SkyCeilingHeight", 71, 5, "int"),
    Field("SCQualityCode", 76, 1, "int"),
    Field("VisibilityDistance", 79, 6, "int"),
    Field("VDQualityCode", 86, 1, "int"),
    Field("AirTemperature", 88, 5, "float", 10),
    Field("ATQualityCode", 93, 1, "int"),
    Field("DewPoint", 94, 5, "float"),
    Field("DPQualityCode", 99, 1, "int"),
    Field("AtmosphericPressure", 100, 5, "float", 10),
    Field("APQualityCode", 105, 1, "int"),
)

# Range of air temperatures that can have been measured, in degrees; 999.9 marks a missing one.
PLAUSIBLE_CELSIUS = (-93.2, 61.8)


def scaled_dew_point(fields: Sequence[Field] = WEATHER_FIELDS) -> list[Field]:
    """The fields with the dew point in degrees too, which by default stays in tenths."""
    return [f._replace(scale=10) if f.name == "DewPoint" else f for f in fields]


def parse_weather(lines: DataFrame, fields: Sequence[Field] = WEATHER_FIELDS) -> DataFrame:
    return parse_fixed_width(lines, fields)


def export_weather(
    lines: DataFrame,
    base: str,
    fields: Sequence[Field] = WEATHER_FIELDS,
    single_file: bool = False,
    mode: str = "errorifexists",
) -> DataFrame:
    """Typed copies: Parquet, CSV, CSV with lz4 and a last CSV. Returns the Parquet copy.

    The lines are parsed once, into Parquet; the CSVs are made from there. With `single_file` the
    last CSV is one file, which many tasks write (see `write_joined_csv`), at any number of rows;
    without, it has many.
    """
    spark = lines.sparkSession
    write_parquet(parse_weather(lines, fields), f"{base}.parquet", mode)
    stored = read_parquet(spark, f"{base}.parquet")
    write_together(
        spark,
        lambda: (write_joined_csv if single_file else write_csv)(stored, f"{base}.csv", mode),
        lambda: write_csv(stored, f"{base}-uncompressed.csv", mode),
        lambda: write_csv(stored, f"{base}-compressed.csv", mode, compression="lz4"),
    )
    return stored


def _within(column: str, valid_range: tuple[float, float] | None) -> Column | None:
    return None if valid_range is None else F.col(column).between(*valid_range)


def monthly_mean(
    weather: DataFrame,
    valid_range: tuple[float, float] | None = None,
    date: str = "ObservationDate",
    measure: str = "AirTemperature",
    name: str = "AvgAirTemp",
) -> DataFrame:
    """Mean per year and month, over all values or those in a range (both ends included)."""
    keys = [F.year(date).alias("year"), F.month(date).alias("month")]
    return mean_by(weather, keys, {name: measure}, where=_within(measure, valid_range))


def monthly_stddev(
    weather: DataFrame,
    valid_range: tuple[float, float] | None = None,
    date: str = "ObservationDate",
    measure: str = "AirTemperature",
    name: str = "StdDevAirTemp",
) -> DataFrame:
    """Sample standard deviation per month over all years."""
    month = F.month(date).alias("month")
    return stddev_by(weather, [month], measure, name, where=_within(measure, valid_range))


def first_year(monthly: DataFrame, n: int | None = 12) -> DataFrame:
    """The rows of the first year in order of the months, the first `n` of them or all.

    The year is found first, by a subquery of its own: pass a frame that is cheap to read twice, such
    as a monthly copy written before.
    """
    rows = monthly.where(F.col("year") == monthly.agg(F.min("year")).scalar())
    others = [c for c in monthly.columns if c not in ("year", "month")]
    return in_order(rows, n, ["month"], tiebreak=others)


def export_monthly(
    weather: DataFrame,
    base: str,
    valid_range: tuple[float, float] | None = None,
    spread: bool = False,
    mode: str = "errorifexists",
) -> DataFrame:
    """Monthly means as Parquet and their first year as CSV. With `spread` the main files hold the
    standard deviation per month over all years, and the means lie in `{base}-means.parquet`.
    Returns the main Parquet copy."""
    spark = weather.sparkSession
    means_path = f"{base}-means.parquet" if spread else f"{base}.parquet"
    write_parquet(monthly_mean(weather, valid_range), means_path, mode)
    if not spread:
        stored = read_parquet(spark, means_path)
        write_single_csv(first_year(stored), f"{base}.csv", mode)
        return stored
    write_parquet(monthly_stddev(weather, valid_range), f"{base}.parquet", mode)
    stored = read_parquet(spark, f"{base}.parquet")
    dated = stored.where(F.col("month").isNotNull())
    write_single_csv(dated.orderBy("month"), f"{base}.csv", mode)
    return stored
