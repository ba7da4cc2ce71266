"""Several independent outputs at once."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def write_together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run writes side by side, so that the tasks of one fill the cores that another leaves idle,
    such as one that makes a single file. All of them finish before an error of one is raised."""
    with ThreadPoolExecutor(max_workers=len(writes)) as threads:
        started = [threads.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in started:
        write.result()
