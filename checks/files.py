"""Round trips through files, tables and the catalog: written with a sink, read with a source."""

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from checks.registry import check, table
from tallyroom.functions import Band, bands_sql, sql_text
from tallyroom.operators import (
    catalog_columns,
    conform,
    count_by,
    create_database,
    drop_table,
    drop_view,
    external_table,
    register_view,
    sql_view,
    use_database,
)
from tallyroom.plans import counts, incidents
from tallyroom.sinks import save_table, write_csv, write_json, write_parquet, write_single_csv
from tallyroom.sources import read_csv, read_json, read_parquet
from tallyroom.staging import scratch_path, settle

DATABASE = "tallyroom_checks"

EVENT_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
EVENT_STRUCT = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)
EVENT_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def checks_table(spark, name):
    """A name in this module's own database, free for a new table over a new path."""
    create_database(spark, DATABASE, scratch_path(spark, "database"))
    drop_table(spark, f"{DATABASE}.{name}")
    return f"{DATABASE}.{name}"


@check(EVENT_SQL)
def json_roundtrip_typed(spark, folder):
    path = scratch_path(spark, "events-json")
    write_json(table(spark, folder, "events"), path)
    return conform(read_json(spark, path), EVENT_STRUCT, lossy=True)  # JSON has no timestamps


@check(EVENT_SQL)
def json_lz4_roundtrip(spark, folder):
    path = scratch_path(spark, "events-json-lz4")
    write_json(table(spark, folder, "events"), path, compression="lz4")
    return read_json(spark, path, EVENT_DDL)


@check(EVENT_SQL)
def csv_lz4_roundtrip(spark, folder):
    path = scratch_path(spark, "events-csv-lz4")
    write_csv(table(spark, folder, "events"), path, compression="lz4")
    return read_csv(spark, path, EVENT_DDL)


@check(EVENT_SQL)
def csv_snappy_roundtrip(spark, folder):
    path = scratch_path(spark, "events-csv-snappy")
    write_csv(table(spark, folder, "events"), path, header=False, compression="snappy")
    return read_csv(spark, path, EVENT_DDL, header=False)


@check(
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    """
)
def csv_inferred(spark, folder):
    """Guessed types depend on the largest number; `schema_trio` compares them."""
    path = scratch_path(spark, "events-csv")
    write_csv(table(spark, folder, "events"), path)
    events = read_csv(spark, path)
    kinds = {"ts": "timestamp_ntz", "event_id": "bigint", "user_id": "bigint"}
    return events.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})


@check(EVENT_SQL)
def csv_struct_schema(spark, folder):
    path = scratch_path(spark, "events-csv")
    write_csv(table(spark, folder, "events"), path)
    return read_csv(spark, path, EVENT_STRUCT)


@check(
    """
    WITH kinds AS (
        SELECT * FROM (VALUES
            ('event_id', (SELECT CASE WHEN max(event_id) < 2147483648 THEN 'int' ELSE 'bigint' END
                          FROM events), 'bigint'),
            ('ts', 'timestamp', 'timestamp_ntz'),
            ('user_id', (SELECT CASE WHEN max(user_id) < 2147483648 THEN 'int' ELSE 'bigint' END
                         FROM events), 'bigint'),
            ('event_type', 'string', 'string'),
            ('value', 'double', 'double'), ('props', 'string', 'string')
        ) AS k(name, guessed, declared)
    )
    SELECT mode, name, CASE mode WHEN 'inferred' THEN guessed ELSE declared END AS type,
           true AS nullable, (SELECT count(*) FROM events) AS rows
    FROM kinds, (VALUES ('inferred'), ('struct'), ('ddl')) AS m(mode)
    """
)
def schema_trio(spark, folder):
    path = scratch_path(spark, "events-csv")
    write_csv(table(spark, folder, "events"), path)
    return counts.schema_trio(spark, path, EVENT_STRUCT, EVENT_DDL)


PADDED_SQL = """
    SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN '  ' || c_name || ' ' END AS c_name,
           CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE c_mktsegment END AS c_mktsegment,
           cast(NULL AS double) AS nothing
    FROM customer
"""


def padded_customers(spark, folder):
    key = F.col("c_custkey")
    name = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))
    return table(spark, folder, "customer").select(
        key,
        F.when(key % 3 > 0, name).alias("c_name"),
        F.when(key % 2 == 0, " ").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.lit(None).cast("double").alias("nothing"),
    )


@check(PADDED_SQL)
def csv_padded_roundtrip(spark, folder):
    """Blanks around strings, and nulls."""
    path = scratch_path(spark, "padded-csv")
    customers = padded_customers(spark, folder)
    write_csv(customers, path)
    return read_csv(spark, path, customers.schema)


@check(PADDED_SQL)
def json_padded_roundtrip(spark, folder):
    """The column of nulls is there although the types are inferred."""
    path = scratch_path(spark, "padded-json")
    customers = padded_customers(spark, folder)
    write_json(customers, path)
    return conform(read_json(spark, path), customers.schema, lossy=True)


@check("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def used_database(spark, folder):
    """A table addressed by its bare name in the database in use."""
    name = checks_table(spark, "events_by_type")
    before = spark.catalog.currentDatabase()
    save_table(
        count_by(table(spark, folder, "events"), ["event_type"]),
        name,
        path=scratch_path(spark, "events-by-type"),
    )
    use_database(spark, DATABASE)
    try:
        return spark.table("events_by_type")
    finally:
        use_database(spark, before)


@check(EVENT_SQL)
def csv_external_table(spark, folder):
    path = scratch_path(spark, "events-csv")
    write_csv(table(spark, folder, "events"), path)
    return external_table(spark, checks_table(spark, "events_csv"), EVENT_DDL, path)


@check(
    """
    SELECT o_orderstatus, cast(year(o_orderdate) AS integer) AS year, count(*) AS count
    FROM orders GROUP BY o_orderstatus, year(o_orderdate)
    """
)
def single_file_csv(spark, folder):
    yearly = count_by(
        table(spark, folder, "orders"), ["o_orderstatus", F.year("o_orderdate").alias("year")]
    )
    path = scratch_path(spark, "yearly-csv")
    write_single_csv(settle(yearly), path)
    return read_csv(spark, path, yearly.schema)


@check("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def parquet_filter_rewrite(spark, folder):
    orders = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    path = scratch_path(spark, "orders-parquet")
    write_parquet(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), path, compact=True)
    return read_parquet(spark, path)


@check("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def parquet_roundtrip(spark, folder):
    return incidents.roundtrip_parquet(
        table(spark, folder, "part"), scratch_path(spark, "part-parquet")
    )


@check("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def table_roundtrip(spark, folder):
    return incidents.roundtrip_table(
        table(spark, folder, "part"),
        checks_table(spark, "part_copy"),
        scratch_path(spark, "part-table"),
    )


@check(
    """
    SELECT column_name AS name,
           CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
                WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type,
           true AS nullable, false AS is_partition, false AS is_bucket,
           (SELECT count(*) FROM orders) AS rows
    FROM (DESCRIBE orders)
    """,
    name="catalog_columns",
)
def listed_columns(spark, folder):
    register_view(table(spark, folder, "orders"), "tallyroom_orders_listed")
    return catalog_columns(spark, "tallyroom_orders_listed")


@check(
    """
    SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'dear'
                            WHEN o_totalprice > 120000 AND o_totalprice < 300000 THEN 'middling'
                            ELSE 'cheap' END AS label
    FROM orders
    """
)
def label_sql(spark, folder):
    register_view(table(spark, folder, "orders"), "tallyroom_orders_labelled")
    bands = [
        Band("dear", above=300_000),
        Band("middling", above=120_000, below=300_000),
    ]
    case = bands_sql("o_totalprice", bands, "cheap")
    return spark.sql(f"SELECT o_orderkey, {case} AS label FROM tallyroom_orders_labelled")


@check(
    """
    SELECT o_orderkey, cast(month(o_orderdate) AS integer) AS month_of_date,
           cast(day(o_orderdate) AS integer) AS day_of_date
    FROM orders
    WHERE o_orderstatus = 'F' AND month(o_orderdate) = 3 AND day(o_orderdate) BETWEEN 1 AND 15
    """
)
def month_day_view(spark, folder):
    register_view(table(spark, folder, "orders"), "tallyroom_orders_dated")
    drop_view(spark, "tallyroom_march")
    return sql_view(
        spark,
        "tallyroom_march",
        f"""
        SELECT o_orderkey, month(o_orderdate) AS month_of_date, day(o_orderdate) AS day_of_date
        FROM tallyroom_orders_dated
        WHERE o_orderstatus = {sql_text("F")} AND month(o_orderdate) = 3
          AND day(o_orderdate) BETWEEN 1 AND 15
        """,
    )
