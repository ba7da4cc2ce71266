"""Column expressions, all made of built-in Spark functions."""

from tallyroom.functions.dates import (
    CLOCK_12H,
    COMPACT_DAY,
    MONTH_DAY_TIME,
    SLASHED_DAY,
    in_year,
    leap_safe_date,
    parse_date,
    parse_local_timestamp,
    parse_timestamp,
)
from tallyroom.functions.fields import Field, cut_field
from tallyroom.functions.labels import (
    Band,
    bands_sql,
    close_bands,
    label_bands,
    sql_text,
    tenure_status,
)

__all__ = [
    "Band",
    "CLOCK_12H",
    "COMPACT_DAY",
    "Field",
    "MONTH_DAY_TIME",
    "SLASHED_DAY",
    "bands_sql",
    "close_bands",
    "cut_field",
    "in_year",
    "label_bands",
    "leap_safe_date",
    "parse_date",
    "parse_local_timestamp",
    "parse_timestamp",
    "sql_text",
    "tenure_status",
]
