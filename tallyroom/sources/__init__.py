"""Readers. Paths may be any Hadoop URI, among them `s3a://`."""

from tallyroom.sources.files import read_csv, read_json, read_lines, read_parquet
from tallyroom.sources.objectstore import object_store_conf
from tallyroom.sources.remote import (
    Remote,
    Split,
    attach_catalog,
    even_predicates,
    quantile_predicates,
    read_jdbc,
    split_over,
)

__all__ = [
    "Remote",
    "Split",
    "attach_catalog",
    "even_predicates",
    "object_store_conf",
    "quantile_predicates",
    "read_csv",
    "read_jdbc",
    "read_json",
    "read_lines",
    "read_parquet",
    "split_over",
]
