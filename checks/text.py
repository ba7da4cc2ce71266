"""Fixed-width lines and date patterns, written out by Spark from the shared tables."""

from pyspark.sql import functions as F

from checks.registry import check, table
from tallyroom.functions import (
    CLOCK_12H,
    COMPACT_DAY,
    MONTH_DAY_TIME,
    SLASHED_DAY,
    leap_safe_date,
    parse_date,
    parse_local_timestamp,
    parse_timestamp,
)
from tallyroom.plans import weather
from tallyroom.sources import read_csv, read_lines
from tallyroom.staging import scratch_path


LINE_WIDTH = 114


def weather_lines(spark, folder):
    """Orders as weather lines: stations from the customer's and the order's number, as far as the
    fields hold them, measures from price and date, an impossible date for status P, a letter for
    its wind quality and a missing temperature above 450,000. A comma and a quote follow the
    fields."""
    price, day = F.floor("o_totalprice"), F.col("o_orderdate")
    digit = F.substring("o_orderpriority", 1, 1)
    status = F.col("o_orderstatus")

    def padded(number, width):
        return F.lpad(number.cast("string"), width, "0")

    warm = F.when(F.month(day) <= 3, "-").otherwise("+")
    pieces = [
        F.lit("0088"),
        padded(F.col("o_custkey") % 1_000_000, 6),
        padded(F.col("o_orderkey") % 100_000, 5),
        F.when(status == "P", "19991345").otherwise(F.date_format(day, "yyyyMMdd")),
        F.concat(F.lit("0"), digit, F.lit("00")),
        F.lit("5+"),
        padded(F.floor(F.col("o_totalprice") / 10), 5),
        F.lit("-"),
        padded(price, 6),
        F.lit("SAO  +"),
        padded(F.month(day) * 100, 4),
        F.lit("99999V020"),
        padded(F.dayofyear(day), 3),
        F.when(status == "P", "A").otherwise("5"),
        F.lit("N00885"),
        padded(F.floor(F.col("o_totalprice") / 10), 5),
        F.lit("49N"),
        padded(price, 6),
        F.lit("5"),
        digit,
        F.lit("9"),
        F.when(price > 450_000, "+9999").otherwise(
            F.concat(warm, padded(F.floor(F.col("o_totalprice") / 1000), 4))
        ),
        F.lit("1-"),
        padded(F.dayofmonth(day), 4),
        F.lit("5"),
        padded(F.floor(F.col("o_totalprice") / 100), 5),
        digit,
        F.lit(' EQD,"N01'),
    ]
    path = scratch_path(spark, "weather-lines")
    line = F.concat(*pieces)
    whole = F.when(F.length(line) == LINE_WIDTH, line).otherwise(
        F.raise_error(F.concat(F.lit("a field does not fit: "), line))
    )
    table(spark, folder, "orders").select(whole.alias("value")).write.text(path)
    return read_lines(spark, path)


WEATHER_SQL = """
    WITH weather AS (
        SELECT lpad(cast(o_custkey % 1000000 AS varchar), 6, '0') AS "WeatherStation",
               lpad(cast(o_orderkey % 100000 AS varchar), 5, '0') AS "WBAN",
               CASE WHEN o_orderstatus <> 'P' THEN cast(o_orderdate AS date) END
                   AS "ObservationDate",
               cast(o_orderpriority[1] AS integer) * 100 AS "ObservationHour",
               floor(o_totalprice / 10) / 1000 AS "Latitude",
               floor(o_totalprice) / -1000 AS "Longitude",
               cast(month(o_orderdate) * 100 AS integer) AS "Elevation",
               cast(dayofyear(o_orderdate) AS integer) AS "WindDirection",
               CASE WHEN o_orderstatus <> 'P' THEN 5 END AS "WDQualityCode",
               cast(floor(o_totalprice / 10) AS integer) AS "SkyCeilingHeight",
               4 AS "SCQualityCode",
               cast(floor(o_totalprice) AS integer) AS "VisibilityDistance",
               cast(o_orderpriority[1] AS integer) AS "VDQualityCode",
               CASE WHEN floor(o_totalprice) > 450000 THEN 999.9
                    ELSE CASE WHEN month(o_orderdate) <= 3 THEN -1 ELSE 1 END
                         * floor(o_totalprice / 1000) / 10 END AS "AirTemperature",
               1 AS "ATQualityCode",
               cast(-day(o_orderdate) AS float) AS "DewPoint",
               5 AS "DPQualityCode",
               floor(o_totalprice / 100) / 10 AS "AtmosphericPressure",
               cast(o_orderpriority[1] AS integer) AS "APQualityCode"
        FROM orders
    )
"""


@check(WEATHER_SQL + "SELECT * FROM weather")
def fixed_width(spark, folder):
    return weather.parse_weather(weather_lines(spark, folder))


def exported_weather(spark, folder, ending, single_file=False):
    """One of the four copies, read back; the CSVs under the declared types."""
    base = scratch_path(spark, "weather")
    stored = weather.export_weather(
        weather_lines(spark, folder), base, single_file=single_file
    )
    return stored if ending == ".parquet" else read_csv(spark, f"{base}{ending}", stored.schema)


@check(WEATHER_SQL + "SELECT * FROM weather")
def weather_export(spark, folder):
    return exported_weather(spark, folder, ".csv")


@check(WEATHER_SQL + "SELECT * FROM weather")
def weather_export_single(spark, folder):
    return exported_weather(spark, folder, ".csv", single_file=True)


@check(WEATHER_SQL + "SELECT * FROM weather")
def weather_export_parquet(spark, folder):
    return exported_weather(spark, folder, ".parquet")


@check(WEATHER_SQL + "SELECT * FROM weather")
def weather_export_plain(spark, folder):
    return exported_weather(spark, folder, "-uncompressed.csv")


@check(WEATHER_SQL + "SELECT * FROM weather")
def weather_export_lz4(spark, folder):
    return exported_weather(spark, folder, "-compressed.csv")


@check(
    WEATHER_SQL
    + """
    SELECT cast(year("ObservationDate") AS integer) AS year,
           cast(month("ObservationDate") AS integer) AS month,
           round(avg("AirTemperature"), 4) AS "AvgAirTemp"
    FROM weather GROUP BY 1, 2
    """
)
def weather_monthly(spark, folder):
    means = weather.monthly_mean(weather.parse_weather(weather_lines(spark, folder)))
    return means.select("year", "month", F.round("AvgAirTemp", 4).alias("AvgAirTemp"))


@check(
    WEATHER_SQL
    + """
    SELECT cast(year("ObservationDate") AS integer) AS year,
           cast(month("ObservationDate") AS integer) AS month,
           round(avg("AirTemperature"), 4) AS "AvgAirTemp"
    FROM weather WHERE "AirTemperature" BETWEEN -93.2 AND 61.8 GROUP BY 1, 2
    """
)
def weather_monthly_valid(spark, folder):
    """Through the Parquet copy that the monthly job leaves behind."""
    base = scratch_path(spark, "weather-monthly")
    parsed = weather.parse_weather(weather_lines(spark, folder))
    means = weather.export_monthly(parsed, base, weather.PLAUSIBLE_CELSIUS)
    return means.select("year", "month", F.round("AvgAirTemp", 4).alias("AvgAirTemp"))


@check(
    WEATHER_SQL
    + """
    SELECT cast(month("ObservationDate") AS integer) AS month,
           round(stddev_samp("AirTemperature"), 4) AS "StdDevAirTemp"
    FROM weather WHERE "AirTemperature" BETWEEN -93.2 AND 61.8 GROUP BY 1
    """
)
def weather_stddev_valid(spark, folder):
    parsed = weather.parse_weather(weather_lines(spark, folder))
    spread = weather.monthly_stddev(parsed, weather.PLAUSIBLE_CELSIUS)
    return spread.select("month", F.round("StdDevAirTemp", 4).alias("StdDevAirTemp"))


@check(
    WEATHER_SQL
    + """
    SELECT cast(year("ObservationDate") AS integer) AS year,
           cast(month("ObservationDate") AS integer) AS month,
           round(avg("AirTemperature"), 4) AS "AvgAirTemp"
    FROM weather WHERE "AirTemperature" BETWEEN -93.2 AND 61.8
        AND year("ObservationDate") = (
            SELECT min(year("ObservationDate")) FROM weather
            WHERE "AirTemperature" BETWEEN -93.2 AND 61.8)
    GROUP BY 1, 2
    """
)
def weather_first_year_csv(spark, folder):
    """The CSV beside the monthly means: the first year's months."""
    base = scratch_path(spark, "weather-monthly")
    parsed = weather.parse_weather(weather_lines(spark, folder))
    stored = weather.export_monthly(parsed, base, weather.PLAUSIBLE_CELSIUS)
    means = read_csv(spark, f"{base}.csv", stored.schema)
    return means.select("year", "month", F.round("AvgAirTemp", 4).alias("AvgAirTemp"))


@check(
    WEATHER_SQL
    + """
    SELECT cast(month("ObservationDate") AS integer) AS month,
           round(stddev_samp("AirTemperature"), 4) AS "StdDevAirTemp"
    FROM weather WHERE "AirTemperature" BETWEEN -93.2 AND 61.8 AND "ObservationDate" IS NOT NULL
    GROUP BY 1
    """
)
def weather_spread_csv(spark, folder):
    """The CSV of the same job with the standard deviation as its main result."""
    base = scratch_path(spark, "weather-monthly")
    parsed = weather.parse_weather(weather_lines(spark, folder))
    stored = weather.export_monthly(parsed, base, weather.PLAUSIBLE_CELSIUS, spread=True)
    spread = read_csv(spark, f"{base}.csv", stored.schema)
    return spread.select("month", F.round("StdDevAirTemp", 4).alias("StdDevAirTemp"))


@check(
    """
    SELECT event_id, date_trunc('day', ts) AS day_ts, date_trunc('second', ts) AS clock_ts,
           cast(ts AS date) AS compact_day
    FROM events
    """
)
def timestamp_patterns(spark, folder):
    def text(pattern):
        return F.date_format("ts", pattern)

    return table(spark, folder, "events").select(
        "event_id",
        parse_local_timestamp(text(SLASHED_DAY), SLASHED_DAY).alias("day_ts"),
        parse_timestamp(text(CLOCK_12H), CLOCK_12H).cast("timestamp_ntz").alias("clock_ts"),
        parse_date(text(COMPACT_DAY), COMPACT_DAY).alias("compact_day"),
    )


@check(
    """
    SELECT o_orderkey,
           CASE WHEN month(o_orderdate) <> 2 OR day(o_orderdate) <> 29
                THEN make_date(1970, month(o_orderdate), day(o_orderdate)) END AS day_1970,
           make_date(2000, month(o_orderdate), day(o_orderdate)) AS day_2000
    FROM orders
    """
)
def yearless_dates(spark, folder):
    text = F.date_format("o_orderdate", MONTH_DAY_TIME)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        parse_date(text, MONTH_DAY_TIME).alias("day_1970"),
        leap_safe_date(text).alias("day_2000"),
    )
