"""Flight delays: SQL and DataFrame forms, catalog objects, copies in several formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.functions import (
    MONTH_DAY_TIME,
    Band,
    bands_sql,
    label_bands,
    leap_safe_date,
    parse_date,
    sql_text,
)
from tallyroom.operators import (
    drop_view,
    in_order,
    quote_name,
    register_view,
    sql_view,
    swap_columns,
)
from tallyroom.sinks import write_json, write_parquet, write_together
from tallyroom.sources import read_parquet

# Columns of the flight file, in file order.
FLIGHT_COLUMNS = "date STRING, delay INT, distance INT, origin STRING, destination STRING"

# Delay labels. Their bounds are strict, so 60, 120 and 360 get no label of their
# own and fall to the default, as nulls do; `close_bands` closes the gaps.
DELAY_BANDS = (
    Band("Very Long Delays", above=360),
    Band("Long Delays", above=120, below=360),
    Band("Short Delays", above=60, below=120),
    Band("Tolerable Delays", above=0, below=60),
    Band("No Delays", equals=0),
)
EARLY = "Early"


def typed_flights(flights: DataFrame, leap_safe: bool = False) -> DataFrame:
    """The text date as a Date, of the year 1970 (no 29 February) or, leap-safe, 2000."""
    day = F.col("date")
    parsed = leap_safe_date(day) if leap_safe else parse_date(day, MONTH_DAY_TIME)
    return swap_columns(flights, {"date": parsed}, drop=[])


def route_delays(
    flights: DataFrame,
    origin: str = "SFO",
    destination: str = "ORD",
    over: int = 120,
    n: int | None = None,
) -> DataFrame:
    """Flights of one route that are later than `over` minutes, latest first."""
    late = flights.where(
        (F.col("delay") > over)
        & (F.col("origin") == origin)
        & (F.col("destination") == destination)
    )
    chosen = late.select("date", "delay", "origin", "destination")
    return in_order(chosen, n, [F.desc("delay")], tiebreak=["date"])


def _ending(n: int | None) -> str:
    """What follows ORDER BY: a limit or, for all rows, a row number that parts equal ones (see
    `sort_all`)."""
    return ", monotonically_increasing_id()" if n is None else f" LIMIT {int(n)}"


def route_delays_sql(
    spark: SparkSession,
    view: str,
    origin: str = "SFO",
    destination: str = "ORD",
    over: int = 120,
    n: int | None = None,
) -> DataFrame:
    """`route_delays` as SQL over a registered view; upper-case names match all the same."""
    return spark.sql(
        f"""
        SELECT date, delay, origin, destination
        FROM {quote_name(view)}
        WHERE delay > :over AND ORIGIN = :origin AND DESTINATION = :destination
        ORDER BY delay DESC, date{_ending(n)}
        """,
        args={"over": over, "origin": origin, "destination": destination},
    )


def delay_labels(
    flights: DataFrame,
    bands: Sequence[Band] = DELAY_BANDS,
    default: str = EARLY,
    missing: str | None = None,
    n: int | None = None,
) -> DataFrame:
    """Every flight with a label for its delay, by origin and latest first."""
    label = label_bands(F.col("delay"), bands, default, missing)
    labelled = flights.select("delay", "origin", "destination", label.alias("Flight_Delays"))
    return in_order(labelled, n, ["origin", F.desc("delay")], tiebreak=["destination"])


def delay_labels_sql(
    spark: SparkSession,
    view: str,
    bands: Sequence[Band] = DELAY_BANDS,
    default: str = EARLY,
    missing: str | None = None,
    n: int | None = None,
) -> DataFrame:
    """`delay_labels` as SQL over a registered view."""
    return spark.sql(
        f"""
        SELECT delay, origin, destination,
               {bands_sql("delay", bands, default, missing)} AS Flight_Delays
        FROM {quote_name(view)}
        ORDER BY origin, delay DESC, destination{_ending(n)}
        """
    )


def period_view(
    spark: SparkSession,
    source: str,
    view: str,
    origin: str = "ORD",
    month: int = 3,
    days: tuple[int, int] = (1, 15),
) -> DataFrame:
    """A view of one origin's flights in some days of a month, with month and day columns.

    `source` is best a qualified table name, since a view of the same name would be read first.
    """
    drop_view(spark, view)
    first, last = days
    # The month's digits lead the text: a prefix test, unlike a parsed date, reaches the scan.
    prefix = f"{int(month):02d}"
    return sql_view(
        spark,
        view,
        f"""
        SELECT delay, origin, destination, date,
               month(flown) AS month_of_date, day(flown) AS day_of_date
        FROM (SELECT *, try_to_date(date, {sql_text(MONTH_DAY_TIME)}) AS flown
              FROM {quote_name(source)}
              WHERE origin = {sql_text(origin)} AND startswith(date, {sql_text(prefix)}))
        WHERE month(flown) = {int(month)} AND day(flown) BETWEEN {int(first)} AND {int(last)}
        """,
    )


def period_frame(
    flights: DataFrame, origin: str = "ORD", month: int = 3, days: tuple[int, int] = (1, 15)
) -> DataFrame:
    """`period_view` as DataFrame calls."""
    flown = parse_date(F.col("date"), MONTH_DAY_TIME)
    in_month = F.col("date").startswith(f"{int(month):02d}")
    dated = flights.where((F.col("origin") == origin) & in_month).withColumns(
        {"month_of_date": F.month(flown), "day_of_date": F.dayofmonth(flown)}
    )
    kept = dated.where((F.col("month_of_date") == month) & F.col("day_of_date").between(*days))
    return kept.select(
        "delay", "origin", "destination", "date", "month_of_date", "day_of_date"
    )


def export_copies(
    flights: DataFrame, base: str, mode: str = "errorifexists"
) -> dict[str, str]:
    """JSON, JSON with lz4 and Parquet copies next to each other; returns their paths.

    Parquet comes first and the text copies are made from it, so that a costly input is read once.
    """
    paths = {
        "parquet": f"{base}.parquet",
        "json": f"{base}.json",
        "json_lz4": f"{base}.json.lz4",
    }
    write_parquet(flights, paths["parquet"], mode)
    stored = read_parquet(flights.sparkSession, paths["parquet"])
    write_together(
        flights.sparkSession,
        lambda: write_json(stored, paths["json"], mode),
        lambda: write_json(stored, paths["json_lz4"], mode, compression="lz4"),
    )
    return paths


def filter_rewrite(
    spark: SparkSession,
    source: str,
    target: str,
    origin: str = "ORD",
    mode: str = "errorifexists",
) -> DataFrame:
    """One origin's rows of a Parquet copy as a Parquet copy of their own."""
    kept = (
        read_parquet(spark, source)
        .where(F.col("origin") == origin)
        .select("date", "delay", "origin", "destination", "distance")
    )
    write_parquet(kept, target, mode, compact=True)
    return read_parquet(spark, target)


def register_flights(flights: DataFrame, view: str = "us_delay_flights") -> str:
    """Register the frame for the SQL forms and return the view's name."""
    register_view(flights, view)
    return view
