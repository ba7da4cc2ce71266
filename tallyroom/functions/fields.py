"""Typed columns out of fixed-width text lines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroom.functions.dates import COMPACT_DAY, parse_date


class Field(NamedTuple):
    """One column of a fixed-width line; `start` counts from 1.

    `kind` is a Spark type name. A date is read with `pattern`, a number is divided by `scale`.
    """

    name: str
    start: int
    length: int
    kind: str = "string"
    scale: int | None = None
    pattern: str = COMPACT_DAY


def _cut_text(line: Column, field: Field) -> Column:
    """The field's characters. In a line of ASCII alone they are bytes, and Spark finds a range of
    bytes directly, where it would count through the characters before each field. The bytes are
    the same expression for all fields of a line, so they are made once."""
    ascii_bytes = F.when(F.octet_length(line) == F.length(line), line.cast("binary"))
    by_bytes = F.substring(ascii_bytes, field.start, field.length).cast("string")
    return F.coalesce(by_bytes, line.substr(field.start, field.length))


def _may_be_number(text: Column, field: Field) -> Column:
    """False for texts that plainly are none, as a failing cast costs many times a comparison:
    blank ones and, for whole numbers, those that start with a letter."""
    filled = (text != "") & (text != " " * field.length)
    # ":" follows the digits in ASCII. Casts trim control characters, of which DEL is the last.
    return filled & ((text < ":") | (text >= "\x7f")) if field.kind == "int" else filled


def cut_field(line: Column, field: Field) -> Column:
    """The field's typed value, null where the text does not fit the type."""
    text = _cut_text(line, field)
    if field.kind == "string":
        value = text
    elif field.kind == "date":
        value = parse_date(text, field.pattern)
    else:
        value = F.when(_may_be_number(text, field), text.try_cast(field.kind))
        if field.scale is not None:
            value = value / F.lit(field.scale)
    return value.alias(field.name)
