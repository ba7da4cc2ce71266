"""Operators that change the columns of a frame; each is one projection, without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    AtomicType,
    BinaryType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegerType,
    IntegralType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tallyroom.functions.fields import Field, cut_field


def quoted(name: str) -> str:
    """A column name that may hold dots or blanks, for use in a column reference."""
    return "`" + name.replace("`", "``") + "`"


def widens(have: DataType, want: DataType) -> bool:
    """Whether every value of one type has its place in the other, as Spark's store assignment
    sees it: the same type, a number in a wider one, a date as a timestamp, anything as text."""
    if have == want or isinstance(have, NullType):
        return True
    if isinstance(want, StringType):
        return isinstance(have, AtomicType) and not isinstance(have, BinaryType)
    order = [ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType]
    if type(have) in order and type(want) in order:
        return order.index(type(have)) <= order.index(type(want))
    if isinstance(have, DecimalType) and isinstance(want, DecimalType):
        return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    return isinstance(have, DateType) and isinstance(want, (TimestampType, TimestampNTZType))


def conform(df: DataFrame, record: StructType, lossy: bool = False) -> DataFrame:
    """The record's columns, in its order and with its types.

    Names match without regard to case, as in Spark. A field that the frame lacks, or whose type
    does not widen to the record's, is an error: text is no number. With `lossy` such a field is
    cast, and a single value that does not fit becomes null; fractions are never cut off.
    Columns outside the record are left out.
    """
    present = {field.name.lower(): field for field in df.schema}
    absent = [field.name for field in record if field.name.lower() not in present]
    if absent:
        raise ValueError(f"fields missing from the input: {', '.join(absent)}")
    cut_off = [
        field.name
        for field in record
        if isinstance(field.dataType, IntegralType)
        and isinstance(present[field.name.lower()].dataType, FractionalType)
    ]
    if cut_off:
        raise ValueError(f"fractions would be cut off in: {', '.join(cut_off)}")
    narrowed = [
        f"{field.name} ({present[field.name.lower()].dataType.simpleString()} to {field.dataType.simpleString()})"
        for field in record
        if not lossy and not widens(present[field.name.lower()].dataType, field.dataType)
    ]
    if narrowed:
        raise ValueError(f"types that do not fit the record: {', '.join(narrowed)}")
    return df.select(
        [
            df[quoted(present[field.name.lower()].name)].try_cast(field.dataType).alias(field.name)
            for field in record
        ]
    )


def swap_columns(df: DataFrame, new: Mapping[str, Column], drop: Sequence[str]) -> DataFrame:
    """Add or replace columns and drop the ones they came from, in a single projection."""
    return df.withColumns(dict(new)).drop(*drop)


def parse_fixed_width(
    lines: DataFrame, fields: Sequence[Field], column: str = "value"
) -> DataFrame:
    """One typed column per field of each text line."""
    return lines.select([cut_field(F.col(column), field) for field in fields])
