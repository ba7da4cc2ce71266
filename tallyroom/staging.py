"""Results that several outputs share are written once to shared storage and read from there.

A written copy survives the loss of executors and is read column by column, which a cached plan
over text files or a remote database does not offer at scale.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_job: ContextVar[str | None] = ContextVar("_job", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named by `spark.checkpoint.dir`.

    Only a local session may fall back on a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.gettempdir()
    job = _job.get()
    folder = f"{base.rstrip('/')}/tallyroom" + (f"/job-{job}" if job else "")
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch copy, on whatever file system it lies."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_job(spark: SparkSession) -> Iterator[None]:
    """Scratch copies made inside lie below one folder, which goes when the block ends: nothing
    that reads them may be used afterwards."""
    token = _job.set(uuid.uuid4().hex)
    try:
        yield
    finally:
        root = scratch_path(spark, "").rsplit("/", 1)[0]
        _job.reset(token)
        discard(spark, root)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Compute `df` once, write it to shared storage and return a frame that reads that copy."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
