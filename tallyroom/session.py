"""Session start for the command line; library functions take whatever session they are given."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def start_session(
    app: str, hive_catalog: bool = False, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Start or join a session.

    `hive_catalog` keeps tables between runs. It is a static setting, so it only takes effect when
    this call starts the session; everything in the library also works with the in-memory catalog.
    """
    builder = SparkSession.builder.appName(app)
    if hive_catalog:
        builder = builder.config("spark.sql.catalogImplementation", "hive")
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
