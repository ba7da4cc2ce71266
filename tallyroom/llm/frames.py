"""Frames written once to the shared folder, and ranks that no single task has to count."""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.staging import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Jobs begun inside remove their shuffle files as they end; what they wrote is read instead."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def settle(df: DataFrame, label: str) -> DataFrame:
    """`df`, computed once and written below `spark.checkpoint.dir`; lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.scratch_path = path
    return written


def discard(*frames: DataFrame | None) -> None:
    """Remove settled frames that nothing will read again."""
    for df in frames:
        path = getattr(df, "scratch_path", None)
        if path:
            context = df.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def one_row(df: DataFrame):
    with shuffles_removed(df.sparkSession):
        return df.first()


def all_rows(df: DataFrame) -> list:
    """The rows of a frame whose number has a bound that the caller states."""
    with shuffles_removed(df.sparkSession):
        return df.collect()


def bucket_bits(rows: int) -> int:
    """Bits of a uniform 64-bit key so that a bucket holds about max(1000, sqrt(rows)) rows."""
    return max(0, math.ceil(math.log2(max(1, rows) / max(1000.0, math.sqrt(max(1, rows))))))


def bucket_of(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def permuted_rank(df: DataFrame, groups: list[str], key: str, ties: list[str], rows: int, name: str) -> DataFrame:
    """`df` with its rank from 0 within `groups` by the uniform 64-bit `key`, then by `ties`.

    Ranks are counted within buckets of the key and shifted by the sizes of the buckets before, so a
    group that holds most of all rows spreads over as many tasks as it has buckets.
    """
    bits = bucket_bits(rows)
    if any(c.startswith("_rank_") for c in df.columns):
        raise ValueError("column names that begin with _rank_ are taken")
    placed = df.withColumn("_rank_b", bucket_of(F.col(key), bits))
    sizes = placed.groupBy(*groups, "_rank_b").agg(F.count(F.lit(1)).alias("_rank_n"))
    before = Window.partitionBy(*groups).orderBy("_rank_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *[F.col(g).alias(f"_rank_g{i}") for i, g in enumerate(groups)],
        F.col("_rank_b").alias("_rank_b2"),
        F.coalesce(F.sum("_rank_n").over(before), F.lit(0)).alias("_rank_before"),
    )
    within = Window.partitionBy(*groups, "_rank_b").orderBy(F.col(key), *ties)
    ranked = placed.withColumn("_rank_r", F.row_number().over(within) - 1)
    on = ranked["_rank_b"] == sizes["_rank_b2"]
    for i, g in enumerate(groups):
        on &= ranked[g].eqNullSafe(sizes[f"_rank_g{i}"])
    return ranked.join(sizes, on).select(*df.columns, (F.col("_rank_before") + F.col("_rank_r")).cast("long").alias(name))
