"""Text labels from numbers and dates."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(value: str) -> str:
    """A string as a literal of Spark SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Band:
    """A label for the numbers above one bound and below another, or equal to one value.

    Bounds are strict; `closed` takes the upper bound in.
    """

    label: str
    above: int | None = None
    below: int | None = None
    equals: int | None = None
    closed: bool = False

    def __post_init__(self) -> None:
        if not self._tests():
            raise ValueError(f"band {self.label!r} has no bound")

    def _tests(self) -> list[tuple[str, int]]:
        upper = "<=" if self.closed else "<"
        tests = [(">", self.above), (upper, self.below), ("=", self.equals)]
        return [(sign, bound) for sign, bound in tests if bound is not None]

    def holds(self, value: Column) -> Column:
        compare = {
            ">": lambda bound: value > bound,
            "<": lambda bound: value < bound,
            "<=": lambda bound: value <= bound,
            "=": lambda bound: value == bound,
        }
        return reduce(Column.__and__, [compare[sign](bound) for sign, bound in self._tests()])

    def holds_sql(self, name: str) -> str:
        return " AND ".join(f"{name} {sign} {bound}" for sign, bound in self._tests())


def close_bands(bands: Sequence[Band]) -> list[Band]:
    """The same bands with their upper bounds taken in, so that no number falls between two."""
    return [replace(band, closed=True) if band.below is not None else band for band in bands]


def label_bands(
    value: Column, bands: Sequence[Band], default: str, missing: str | None = None
) -> Column:
    """Label of the first band that holds; `missing` names nulls, which else take the default."""
    branches = [] if missing is None else [(value.isNull(), missing)]
    branches += [(band.holds(value), band.label) for band in bands]
    (test, label), *others = branches
    chain = F.when(test, label)
    for test, label in others:
        chain = chain.when(test, label)
    return chain.otherwise(default)


def bands_sql(
    name: str, bands: Sequence[Band], default: str, missing: str | None = None
) -> str:
    """`label_bands` as SQL text over the column `name`."""
    branches = [] if missing is None else [(f"{name} IS NULL", missing)]
    branches += [(band.holds_sql(name), band.label) for band in bands]
    lines = [f"WHEN {test} THEN {sql_text(label)}" for test, label in branches]
    return "\n".join(["CASE", *lines, f"ELSE {sql_text(default)}", "END"])


def tenure_status(
    end: Column, sentinel: str = "9999-01-01", as_of: str | datetime.date | None = None
) -> Column:
    """`current` at the open-ended sentinel date, `left` before `as_of` (today), else `NA`."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return (
        F.when(end == F.lit(sentinel).cast("date"), "current")
        .when(end < today, "left")
        .otherwise("NA")
    )
