"""The personnel analyses, and reads and writes of a relational database.

The database is the one that `spark.tallyroom.jdbc.url` (with `.driver`, `.user` and `.password`)
names. Where that is unset, as in tests, it is an embedded in-memory Derby, which comes with Spark,
opens no port and is seen by its own process only: that serves a local session, not a cluster.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks.files import checks_table
from checks.registry import check, table
from tallyroom.operators import frame_report, row_count, top_n
from tallyroom.plans import hr
from tallyroom.sinks import publish_jdbc, write_jdbc
from tallyroom.sources import (
    Remote,
    attach_catalog,
    even_predicates,
    quantile_predicates,
    read_csv,
    read_jdbc,
    split_over,
)
from tallyroom.staging import scratch_path

STATUS_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_shipdate = DATE '1998-06-15' THEN 'current'
                WHEN l_shipdate < DATE '1999-01-01' THEN 'left' ELSE 'NA' END AS status
    FROM lineitem
"""
LEFT_SQL = f"SELECT * FROM ({STATUS_SQL}) WHERE status = 'left'"


def statuses(spark, folder):
    lineitem = hr.with_status(
        table(spark, folder, "lineitem"), "1998-06-15", "1999-01-01", end="l_shipdate"
    )
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "status")


@check(STATUS_SQL)
def status_label(spark, folder):
    return statuses(spark, folder)


@check(f"SELECT status, count(*) AS count FROM ({STATUS_SQL}) GROUP BY status")
def status_counts(spark, folder):
    return hr.status_counts(statuses(spark, folder))


@check(LEFT_SQL)
def leavers_table(spark, folder):
    left = hr.leavers(statuses(spark, folder))
    return hr.keep_as_table(
        left, checks_table(spark, "left_table"), scratch_path(spark, "left-table")
    )


@check(LEFT_SQL)
def leavers_view(spark, folder):
    return hr.keep_as_view(hr.leavers(statuses(spark, folder)), "tallyroom_left_tempview")


@check(LEFT_SQL)
def leavers_frame(spark, folder):
    left = hr.leavers(statuses(spark, folder))
    return hr.keep_as_table(left, checks_table(spark, "left_df"), scratch_path(spark, "left-df"))


def remote_of(spark):
    url = spark.conf.get("spark.tallyroom.jdbc.url", None)
    if url is None:
        master = spark.conf.get("spark.master", "local")
        # local-cluster has executors of their own process too
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.tallyroom.jdbc.url to a database that executors can reach")
        return Remote(f"jdbc:derby:memory:tallyroom{uuid.uuid4().hex};create=true")
    driver, user, password = (
        spark.conf.get(f"spark.tallyroom.jdbc.{key}", None)
        for key in ("driver", "user", "password")
    )
    return Remote(url, driver, user, password)


CUSTOMER_TYPES = "c_name VARCHAR(64), c_mktsegment VARCHAR(32)"
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def fresh(name):
    """A table name of its own, so that nothing in a shared database is replaced."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def parts_of(spark):
    return max(2, spark.sparkContext.defaultParallelism)


def remote_customers(spark, folder):
    """A database and the name of a copy of the customers in it."""
    remote, name = remote_of(spark), fresh("customer_copy")
    customers = table(spark, folder, "customer")
    write_jdbc(
        customers,
        remote,
        name,
        column_types=CUSTOMER_TYPES,
        expect_rows=customers.count(),
    )
    return remote, name


@check(CUSTOMER_SQL)
def jdbc_table(spark, folder):
    remote, name = remote_customers(spark, folder)
    ranges = quantile_predicates(spark, remote, name, "c_custkey", parts_of(spark))
    return read_jdbc(spark, remote, name, predicates=ranges)


@check(CUSTOMER_SQL)
def jdbc_published(spark, folder):
    """A table that is overwritten through a staging table, read by ranges of a text."""
    remote, name = remote_customers(spark, folder)
    customers = table(spark, folder, "customer")
    publish_jdbc(customers, remote, name, "overwrite", column_types=CUSTOMER_TYPES)
    ranges = quantile_predicates(spark, remote, name, "c_name", parts_of(spark))
    return read_jdbc(spark, remote, name, predicates=ranges)


@check(CUSTOMER_SQL + " WHERE c_mktsegment = 'MACHINERY'")
def jdbc_query(spark, folder):
    remote, name = remote_customers(spark, folder)
    segment = remote.quote("c_mktsegment")
    return read_jdbc(
        spark,
        remote,
        query=f"SELECT * FROM {name} WHERE {segment} = {remote.text('MACHINERY')}",
        split=split_over(spark, remote, name, "c_custkey", parts_of(spark)),
    )


@check(CUSTOMER_SQL)
def jdbc_partitioned(spark, folder):
    remote, name = remote_customers(spark, folder)
    split = split_over(spark, remote, name, "c_custkey", parts_of(spark))
    return read_jdbc(spark, remote, name, split=split)


@check(CUSTOMER_SQL)
def jdbc_even_parts(spark, folder):
    remote, name = remote_customers(spark, folder)
    ranges = even_predicates(spark, remote, name, "c_custkey", parts_of(spark))
    return read_jdbc(spark, remote, name, predicates=ranges)


@check(
    """
    SELECT c_custkey, c_name, c_acctbal FROM customer
    ORDER BY c_acctbal DESC, c_custkey LIMIT 100
    """
)
def jdbc_catalog_top_n(spark, folder):
    catalog = f"tallyroom_{uuid.uuid4().hex}"
    remote, copy = remote_customers(spark, folder)
    attach_catalog(spark, catalog, remote)
    # Derby keeps unquoted names in capitals, in the schema APP.
    schema = spark.conf.get("spark.tallyroom.jdbc.schema", "APP")
    name = copy.upper() if schema == "APP" else copy
    customers = spark.table(f"{catalog}.{schema}.{name}")
    chosen = customers.select("c_custkey", "c_name", "c_acctbal")
    return top_n(chosen, 100, [F.desc("c_acctbal")], ["c_custkey"])


@check(
    """
    SELECT o_custkey AS emp_no, o_totalprice AS salary, o_orderkey AS contract FROM orders
    ORDER BY o_totalprice DESC, o_custkey, o_orderkey LIMIT 1000
    """
)
def jdbc_top_salaries(spark, folder):
    """The snappy CSV that goes with the remote table of the highest salaries."""
    path = scratch_path(spark, "top-salaries-csv")
    best = hr.publish_top_salaries(
        salaries_of(spark, folder), remote_of(spark), path, n=1000, table=fresh("aces")
    )
    return read_csv(spark, path, best.schema, header=False)


def salaries_of(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("emp_no"),
        F.col("o_totalprice").alias("salary"),
        F.col("o_orderkey").alias("contract"),
    )


@check(
    """
    SELECT o_custkey AS emp_no, o_totalprice AS salary, o_orderkey AS contract FROM orders
    ORDER BY o_totalprice DESC, o_custkey, o_orderkey LIMIT 1000
    """
)
def jdbc_aces(spark, folder):
    """The remote table of the highest salaries itself."""
    remote, name = remote_of(spark), fresh("aces")
    path = scratch_path(spark, "top-salaries-csv")
    hr.publish_top_salaries(salaries_of(spark, folder), remote, path, n=1000, table=name)
    return read_jdbc(spark, remote, name)


@check(
    """
    SELECT o_custkey AS emp_no, o_orderpriority AS title, cast(o_orderdate AS date) AS to_date,
           'left' AS status
    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate < DATE '1998-01-01'
    """
)
def jdbc_leavers(spark, folder):
    """Titles written to the database, picked there, labelled, published and read back."""
    remote, titles = remote_titles(spark, folder)
    split = split_over(spark, remote, titles, "emp_no", parts_of(spark))
    holders = hr.with_status(
        hr.titles_of(spark, remote, "1-URGENT", titles, split=split), as_of="1998-01-01"
    )
    hyphenated = {kind: fresh(name) for kind, name in hr.HYPHENATED_NAMES.items()}
    names = {
        "table": checks_table(spark, "left_table_remote"),
        "view": "tallyroom_left_remote",
        "frame": checks_table(spark, "left_df_remote"),
    }
    paths = {kind: scratch_path(spark, f"left-{kind}") for kind in ("table", "frame")}
    hr.publish_leavers(
        hr.leavers(holders),
        remote,
        names,
        hyphenated,
        column_types="title VARCHAR(32)",
        paths=paths,
    )
    return read_jdbc(spark, remote, hr.remote_table(remote, hyphenated["frame"]))


def remote_titles(spark, folder):
    """A database and the name of a table of titles in it."""
    remote, name = remote_of(spark), fresh("titles")
    titles = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("emp_no"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").cast("date").alias("to_date"),
    )
    write_jdbc(
        titles, remote, name, column_types="title VARCHAR(32)", expect_rows=titles.count()
    )
    return remote, name


@check(
    """
    SELECT CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'left' ELSE 'NA' END AS status,
           count(*) AS count
    FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1
    """
)
def jdbc_status_counts(spark, folder):
    """People per status, over a remote read of one title."""
    remote, name = remote_titles(spark, folder)
    ranges = even_predicates(spark, remote, name, "emp_no", parts_of(spark))
    holders = hr.titles_of(spark, remote, "1-URGENT", name, predicates=ranges)
    return hr.status_counts(hr.with_status(holders, as_of="1998-01-01"))


@check(
    """
    SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'bigint'
               WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' ELSE 'double' END AS type,
           (SELECT count(*) FROM customer) AS rows
    FROM (DESCRIBE customer)
    """
)
def jdbc_described(spark, folder):
    """Columns and row count of a remote table."""
    remote, name = remote_customers(spark, folder)
    split = split_over(spark, remote, name, "c_custkey", parts_of(spark))
    report = frame_report(read_jdbc(spark, remote, name, split=split))
    return report.select("name", "type", "rows")


@check("SELECT count(*) AS rows, true AS refused FROM customer")
def jdbc_refused(spark, folder):
    """A second write is refused and leaves the table as it was."""
    remote, name = remote_customers(spark, folder)
    try:
        write_jdbc(table(spark, folder, "customer").limit(1), remote, name)
        refused = False
    except AnalysisException:
        refused = True
    split = split_over(spark, remote, name, "c_custkey", parts_of(spark))
    return row_count(read_jdbc(spark, remote, name, split=split)).withColumn(
        "refused", F.lit(refused)
    )


@check(
    """
    SELECT status, count(*) AS count FROM (
        SELECT CASE WHEN o_orderdate < current_date THEN 'left' ELSE 'NA' END AS status FROM orders)
    GROUP BY status
    """
)
def status_today(spark, folder):
    """The status as of the day of the query."""
    orders = table(spark, folder, "orders").withColumn("to_date", F.col("o_orderdate").cast("date"))
    return hr.status_counts(hr.with_status(orders))
