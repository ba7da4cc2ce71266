"""The flight analyses, as DataFrame and as SQL, over a frame shaped from `lineitem`."""

from pyspark.sql import functions as F

from checks.files import checks_table
from checks.registry import check, table
from tallyroom.functions import Band, close_bands, label_bands
from tallyroom.operators import catalog_columns, external_table
from tallyroom.plans import flights
from tallyroom.sinks import write_csv, write_parquet
from tallyroom.sources import read_csv, read_json, read_parquet
from tallyroom.staging import scratch_path

FLIGHTS_SQL = """
    WITH flights AS (
        SELECT strftime(l_shipdate, '%m%d') || lpad(cast(l_linenumber AS varchar), 2, '0')
                   || lpad(cast(cast(l_quantity AS integer) AS varchar), 2, '0') AS date,
               CASE WHEN l_linenumber < 7
                    THEN cast(floor(l_extendedprice / 200) AS integer) - 30 END AS delay,
               cast(l_partkey % 1000000000 AS integer) AS distance,
               CASE l_returnflag WHEN 'A' THEN 'ORD' WHEN 'N' THEN 'SFO' ELSE 'JFK' END AS origin,
               CASE l_linestatus WHEN 'O' THEN 'ORD' ELSE 'SFO' END AS destination,
               l_shipdate
        FROM lineitem
    )
"""

ROUTE_SQL = (
    FLIGHTS_SQL
    + """
    SELECT date, delay, origin, destination FROM flights
    WHERE delay > 120 AND origin = 'SFO' AND destination = 'ORD'
    """
)

LABELS_SQL = (
    FLIGHTS_SQL
    + """
    SELECT delay, origin, destination,
           CASE WHEN delay = 0 THEN 'No Delays'
                WHEN delay > 0 AND delay NOT IN (60, 120, 360) THEN
                    list_extract(['Tolerable Delays', 'Short Delays', 'Long Delays',
                                  'Very Long Delays'],
                                 1 + (delay > 60)::int + (delay > 120)::int + (delay > 360)::int)
                ELSE 'Early' END AS "Flight_Delays"
    FROM flights
    """
)

PERIOD_SQL = (
    FLIGHTS_SQL
    + """
    SELECT delay, origin, destination, date, cast(month(l_shipdate) AS integer) AS month_of_date,
           cast(day(l_shipdate) AS integer) AS day_of_date
    FROM flights
    WHERE origin = 'ORD' AND month(l_shipdate) = 3 AND day(l_shipdate) BETWEEN 1 AND 15
    """
)


def delays(spark, folder):
    """Line items in the shape of the flight file, some delays unknown."""
    minute = F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")
    hour = F.lpad(F.col("l_linenumber").cast("string"), 2, "0")
    late = F.floor(F.col("l_extendedprice") / 200).cast("int") - 30
    origin = (
        F.when(F.col("l_returnflag") == "A", "ORD")
        .when(F.col("l_returnflag") == "N", "SFO")
        .otherwise("JFK")
    )
    return table(spark, folder, "lineitem").select(
        F.concat(F.date_format("l_shipdate", "MMdd"), hour, minute).alias("date"),
        F.when(F.col("l_linenumber") < 7, late).alias("delay"),
        (F.col("l_partkey") % 1_000_000_000).cast("int").alias("distance"),
        origin.alias("origin"),
        F.when(F.col("l_linestatus") == "O", "ORD").otherwise("SFO").alias("destination"),
    )


@check(
    """
    SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem
    WHERE l_quantity > 25 AND l_returnflag = 'A' AND l_linestatus = 'F'
    """
)
def route_filter_df(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    return lineitem.where(
        (F.col("l_quantity") > 25)
        & (F.col("l_returnflag") == "A")
        & (F.col("l_linestatus") == "F")
    ).select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@check(ROUTE_SQL)
def flight_route(spark, folder):
    return flights.route_delays(delays(spark, folder))


@check(ROUTE_SQL)
def route_filter_sql(spark, folder):
    view = flights.register_flights(delays(spark, folder), "tallyroom_route_flights")
    return flights.route_delays_sql(spark, view)


@check(
    """
    SELECT l_orderkey, l_linenumber, l_quantity,
           CASE WHEN l_quantity > 40 THEN 'huge'
                WHEN l_quantity > 20 AND l_quantity < 40 THEN 'large'
                WHEN l_quantity > 10 AND l_quantity < 20 THEN 'middling'
                WHEN l_quantity = 10 THEN 'ten' ELSE 'other' END AS label,
           CASE WHEN l_quantity > 40 THEN 'huge' WHEN l_quantity > 20 THEN 'large'
                WHEN l_quantity > 10 THEN 'middling'
                WHEN l_quantity = 10 THEN 'ten' ELSE 'other' END AS closed_label
    FROM lineitem
    """
)
def label_df(spark, folder):
    quantity = F.col("l_quantity")
    bands = [
        Band("huge", above=40),
        Band("large", above=20, below=40),
        Band("middling", above=10, below=20),
        Band("ten", equals=10),
    ]
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        label_bands(quantity, bands, "other").alias("label"),
        label_bands(quantity, close_bands(bands), "other").alias("closed_label"),
    )


@check(LABELS_SQL)
def flight_labels(spark, folder):
    return flights.delay_labels(delays(spark, folder))


@check(LABELS_SQL)
def flight_labels_sql(spark, folder):
    view = flights.register_flights(delays(spark, folder), "tallyroom_label_flights")
    return flights.delay_labels_sql(spark, view)


@check(PERIOD_SQL)
def flight_period_view(spark, folder):
    path = scratch_path(spark, "flights-csv")
    write_csv(delays(spark, folder), path)
    flights_table = checks_table(spark, "flights_csv")
    external_table(spark, flights_table, flights.FLIGHT_COLUMNS, path)
    return flights.period_view(spark, flights_table, "tallyroom_ord_march")


@check(PERIOD_SQL)
def flight_period_frame(spark, folder):
    return flights.period_frame(delays(spark, folder))


@check(
    """
    SELECT name, type, true AS nullable, false AS is_partition, false AS is_bucket,
           (SELECT count(*) FROM lineitem) AS rows
    FROM (VALUES ('date', 'string'), ('delay', 'int'), ('distance', 'int'), ('origin', 'string'),
                 ('destination', 'string')) AS f(name, type)
    """
)
def flight_table_columns(spark, folder):
    path = scratch_path(spark, "flights-csv")
    write_csv(delays(spark, folder), path)
    flights_table = checks_table(spark, "flights_listed")
    external_table(spark, flights_table, flights.FLIGHT_COLUMNS, path)
    return catalog_columns(spark, flights_table)


COPY_SQL = FLIGHTS_SQL + "SELECT date, delay, distance, origin, destination FROM flights"


@check(COPY_SQL)
def flight_copy_json(spark, folder):
    paths = flights.export_copies(delays(spark, folder), scratch_path(spark, "departuredelays"))
    return read_json(spark, paths["json"], flights.FLIGHT_COLUMNS)


@check(COPY_SQL)
def flight_copy_json_lz4(spark, folder):
    paths = flights.export_copies(delays(spark, folder), scratch_path(spark, "departuredelays"))
    return read_json(spark, paths["json_lz4"], flights.FLIGHT_COLUMNS)


@check(COPY_SQL)
def flight_copy_parquet(spark, folder):
    paths = flights.export_copies(delays(spark, folder), scratch_path(spark, "departuredelays"))
    return read_parquet(spark, paths["parquet"])


@check(
    FLIGHTS_SQL
    + """
    SELECT date, delay, origin, destination, distance FROM flights WHERE origin = 'ORD'
    """
)
def flight_origin_rewrite(spark, folder):
    base = scratch_path(spark, "departuredelays")
    write_parquet(delays(spark, folder), f"{base}.parquet")
    return flights.filter_rewrite(spark, f"{base}.parquet", f"{base}-ord.parquet")


@check(
    FLIGHTS_SQL
    + """
    SELECT date, delay, origin, destination, distance FROM flights WHERE origin = 'ORD'
    """
)
def flight_clustered_rewrite(spark, folder):
    """The same from a copy laid out by origin, of which the filter reads the row groups that hold it."""
    base = scratch_path(spark, "departuredelays-clustered")
    write_parquet(delays(spark, folder), f"{base}.parquet", cluster_by=["origin", "date"], bloom_for=["distance"])
    return flights.filter_rewrite(spark, f"{base}.parquet", f"{base}-ord.parquet")


@check(
    FLIGHTS_SQL
    + """
    SELECT cast(make_date(2000, month(l_shipdate), day(l_shipdate)) AS date) AS date, delay,
           distance, origin, destination
    FROM flights
    """
)
def flight_typed_dates(spark, folder):
    return flights.typed_flights(delays(spark, folder), leap_safe=True)


@check(COPY_SQL)
def flight_csv_to_parquet(spark, folder):
    """The text date keeps its leading zero only under a named schema."""
    path = scratch_path(spark, "flights-csv")
    write_csv(delays(spark, folder), path)
    base = scratch_path(spark, "flights")
    write_parquet(read_csv(spark, path, flights.FLIGHT_COLUMNS), base)
    return read_parquet(spark, base)
