"""Writers. As in Spark, they refuse to replace earlier output unless `mode="overwrite"` says so."""

from tallyroom.sinks.files import write_csv, write_joined_csv, write_json, write_parquet, write_single_csv
from tallyroom.sinks.remote import publish_jdbc, write_jdbc
from tallyroom.sinks.tables import forget_versions, replace_table, save_table
from tallyroom.sinks.together import write_together

__all__ = [
    "forget_versions",
    "publish_jdbc",
    "replace_table",
    "save_table",
    "write_csv",
    "write_jdbc",
    "write_joined_csv",
    "write_json",
    "write_parquet",
    "write_single_csv",
    "write_together",
]
