"""Readings of internet-connected devices: weak batteries, high CO2, value ranges, means."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyroom.operators import in_order, mean_by, min_max, row_count, top_n

# The record of the device file.
DEVICE_COLUMNS = (
    "battery_level BIGINT, c02_level BIGINT, cca2 STRING, cca3 STRING, cn STRING, "
    "device_id BIGINT, device_name STRING, humidity BIGINT, ip STRING, latitude DOUBLE, "
    "lcd STRING, longitude DOUBLE, scale STRING, temp BIGINT, timestamp BIGINT"
)

# Measures and the endings of their column names.
MEASURES = {
    "temp": "temperature",
    "battery_level": "battery_level",
    "c02_level": "c02_level",
    "humidity": "humidity",
}


def device_record() -> StructType:
    """The declared record, for `conform`."""
    return StructType.fromDDL(DEVICE_COLUMNS)


def low_battery_count(devices: DataFrame, threshold: int = 8) -> DataFrame:
    return row_count(devices.where(F.col("battery_level") < threshold))


def low_battery(devices: DataFrame, threshold: int = 8, n: int = 5) -> DataFrame:
    """Among the devices with a weak battery, those with the least CO2."""
    weak = devices.where(F.col("battery_level") < threshold)
    chosen = weak.select("battery_level", "c02_level", "device_name")
    return top_n(chosen, n, ["c02_level"], tiebreak=["device_name", "battery_level"])


def high_co2_by_country(devices: DataFrame, threshold: int = 1400, n: int | None = 5) -> DataFrame:
    """Mean CO2 per country over the readings above the threshold, highest first."""
    means = mean_by(
        devices, ["cn"], {"avg_c02": "c02_level"}, where=F.col("c02_level") > threshold
    )
    return in_order(means, n, [F.desc("avg_c02")], tiebreak=["cn"])


def measure_ranges(devices: DataFrame, measures: Mapping[str, str] = MEASURES) -> DataFrame:
    return min_max(devices, measures)


def country_means(devices: DataFrame, n: int | None = 5) -> DataFrame:
    """Mean temperature, CO2 and humidity per country, warmest first."""
    names = {
        "avg_temperature": "temp",
        "avg_c02_level": "c02_level",
        "avg_humidity": "humidity",
    }
    means = mean_by(devices, ["cca2", "cn"], names)
    return in_order(means, n, [F.desc(name) for name in names], tiebreak=["cca2", "cn"])
