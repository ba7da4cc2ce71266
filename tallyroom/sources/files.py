"""File readers."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Paths = str | list[str]


def read_csv(
    spark: SparkSession,
    path: Paths,
    schema: StructType | str | None = None,
    header: bool = True,
    **options: Any,
) -> DataFrame:
    """CSV under a `StructType`, a DDL string or, without either, inferred types.

    Inference reads the whole input once more, so name the schema for anything large. A named
    schema binds by position and the heading is only skipped.
    """
    reader = spark.read.format("csv").option("header", header).options(**options)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    if isinstance(path, str):
        return reader.option("path", path).load()
    return reader.load(path)


def read_json(
    spark: SparkSession, path: Paths, schema: StructType | str | None = None, **options: Any
) -> DataFrame:
    """JSON lines. Follow an inferred read with `conform` to insist on declared fields; a named
    schema saves the inference pass but turns an absent field into nulls."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.options(**options).json(path)


def read_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """Text lines whole, in the column `value`; empty lines and those of white space alone are
    skipped. Commas and quotes have no meaning here, unlike in a CSV read without a heading."""
    return spark.read.text(path).where(F.col("value").rlike(r"\S"))


def read_parquet(spark: SparkSession, path: Paths) -> DataFrame:
    reader = spark.read
    return reader.parquet(path) if isinstance(path, str) else reader.parquet(*path)
