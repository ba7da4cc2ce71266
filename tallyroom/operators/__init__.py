"""Frame-to-frame operators: shaping, aggregation, order, catalog."""

from tallyroom.operators.aggregate import (
    count_by,
    frame_report,
    mean_by,
    min_max,
    row_count,
    stddev_by,
)
from tallyroom.operators.catalog import (
    catalog_columns,
    create_database,
    drop_table,
    drop_view,
    external_table,
    quote_name,
    register_view,
    sql_view,
    use_database,
)
from tallyroom.operators.shape import conform, parse_fixed_width, swap_columns
from tallyroom.operators.topk import in_order, sort_all, top_n, with_position

__all__ = [
    "catalog_columns",
    "conform",
    "count_by",
    "create_database",
    "drop_table",
    "drop_view",
    "external_table",
    "frame_report",
    "in_order",
    "mean_by",
    "min_max",
    "parse_fixed_width",
    "quote_name",
    "register_view",
    "row_count",
    "sort_all",
    "sql_view",
    "stddev_by",
    "swap_columns",
    "top_n",
    "with_position",
    "use_database",
]
