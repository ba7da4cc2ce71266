"""Grouped and global aggregates.

All of them combine within each input task first, so that what is shuffled is one small row per
group and task, and a group that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str | Column]


def count_by(
    df: DataFrame,
    keys: Keys,
    metric: str | None = None,
    how: str = "rows",
    name: str = "count",
    where: Column | None = None,
) -> DataFrame:
    """Rows per group (`rows`), non-null values of `metric` (`values`) or their sum (`sum`).

    A null key is a group of its own.
    """
    if (metric is None) != (how == "rows"):
        raise ValueError("name a metric for 'values' and 'sum', none for 'rows'")
    measures = {
        "rows": lambda: F.count(F.lit(1)),
        "values": lambda: F.count(metric),
        "sum": lambda: F.sum(metric),
    }
    if how not in measures:
        raise ValueError(f"how must be one of {sorted(measures)}, not {how!r}")
    kept = df if where is None else df.where(where)
    return kept.groupBy(*keys).agg(measures[how]().alias(name))


def mean_by(
    df: DataFrame, keys: Keys, measures: Mapping[str, str], where: Column | None = None
) -> DataFrame:
    """Averages per group in one pass; `measures` maps each output name to its input column."""
    kept = df if where is None else df.where(where)
    return kept.groupBy(*keys).agg(*[F.avg(col).alias(name) for name, col in measures.items()])


def stddev_by(
    df: DataFrame, keys: Keys, column: str, name: str, where: Column | None = None
) -> DataFrame:
    """Sample standard deviation per group; null for a group of one value."""
    kept = df if where is None else df.where(where)
    return kept.groupBy(*keys).agg(F.stddev_samp(column).alias(name))


def min_max(df: DataFrame, columns: Iterable[str] | Mapping[str, str]) -> DataFrame:
    """One row with the minimum and maximum of every column, in one pass.

    A mapping gives the ending of the output names: `{"temp": "temperature"}` makes
    `min_temperature` and `max_temperature`.
    """
    names = columns if isinstance(columns, Mapping) else {column: column for column in columns}
    return df.agg(
        *[
            measure(column).alias(f"{prefix}_{ending}")
            for column, ending in names.items()
            for prefix, measure in (("min", F.min), ("max", F.max))
        ]
    )


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row with the number of rows; over Parquet Spark reads no column for it."""
    return df.agg(F.count(F.lit(1)).alias(name))


def frame_report(df: DataFrame, mode: str | None = None) -> DataFrame:
    """A row per column: name, type and nullability, with the row count of the frame."""
    described = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("name"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.lit(field.nullable).alias("nullable"),
            )
            for field in df.schema
        ]
    )
    report = row_count(df).select(F.inline(described), "rows")
    return report if mode is None else report.select(F.lit(mode).alias("mode"), "*")
