"""Order: deterministic top-n, and sorts of whole frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.staging import settle

Order = Sequence[Column | str]


def top_n(df: DataFrame, n: int, order: Order, tiebreak: Order = ()) -> DataFrame:
    """The first `n` rows in `order`, equal rows told apart by `tiebreak`.

    Spark keeps a bounded heap per task and merges the heaps; the input is not shuffled.
    """
    return df.orderBy(*order, *tiebreak).limit(n)


def unused_name(df: DataFrame, name: str) -> str:
    """`name`, or the first of name_1, name_2, ... that no column has, whatever its case."""
    taken = {column.lower() for column in df.columns}
    tries = (name if n == 0 else f"{name}_{n}" for n in range(len(taken) + 1))
    return next(found for found in tries if found.lower() not in taken)


def sort_all(df: DataFrame, order: Order, tiebreak: Order = ()) -> DataFrame:
    """All rows in order, over many partitions.

    Spark sorts by ranges of the sort key, and rows with the same key cannot be parted. A row
    number as the last key parts them, so that one value held by a third of the rows does not end
    up in one task.
    """
    number = unused_name(df, "sort_all_row")
    numbered = df.withColumn(number, F.monotonically_increasing_id())
    return numbered.orderBy(*order, *tiebreak, number).drop(number)


def with_position(
    df: DataFrame, order: Order, tiebreak: Order = (), name: str = "position", first: int = 1
) -> DataFrame:
    """The rows with their place in the whole order, counted from `first` on, as a column.

    A window over all rows would count in one task. Here the rows are dealt out by ranges of the
    order and sorted inside them; a row's place is that inside its range and the sizes of the ranges before,
    of which there are as many as tasks. Rows that `order` and `tiebreak` leave equal
    get different places, in an order that may differ between runs. The dealt rows are written once
    (see `settle`), since ranges that are drawn anew need not be the same. An empty frame stays empty;
    a column that is called `name` already is refused.
    """
    if name.lower() in {column.lower() for column in df.columns}:
        raise ValueError(f"there is a column {name} already")
    number = unused_name(df, "row_number_in")
    keyed = df.withColumn(number, F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order, *tiebreak, number).sortWithinPartitions(*order, *tiebreak, number)
    placed = settle(dealt.withColumn(number, F.monotonically_increasing_id()), "positions")
    # The upper bits of that number are the partition, the lower 33 count inside it.
    part = unused_name(placed, "part_of_row")
    parts = placed.select(F.shiftright(number, 33).alias(part)).groupBy(part).count()
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    shift = unused_name(placed, "rows_before")
    parts = parts.select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(shift))
    within = F.col(number).bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.withColumn(part, F.shiftright(number, 33)).join(F.broadcast(parts), part)
    return joined.select(*[F.col(quoted(c)) for c in df.columns], (F.col(shift) + within + F.lit(first)).cast("long").alias(name))


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def in_order(df: DataFrame, n: int | None, order: Order, tiebreak: Order = ()) -> DataFrame:
    """`top_n`, or `sort_all` where no `n` is given."""
    return sort_all(df, order, tiebreak) if n is None else top_n(df, n, order, tiebreak)
