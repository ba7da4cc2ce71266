"""Counts, sums, means, ranges and top-n straight on the shared tables."""

from pyspark.sql import functions as F

from checks.registry import check, table
from tallyroom.functions import in_year
from tallyroom.operators import count_by, frame_report, mean_by, min_max, row_count, top_n, with_position
from tallyroom.plans import counts, weather


@check(
    """
    SELECT o_orderstatus, o_orderpriority, count(o_totalprice) AS "Total"
    FROM orders GROUP BY o_orderstatus, o_orderpriority
    """
)
def count_by_group(spark, folder):
    orders = table(spark, folder, "orders")
    totals = count_by(
        orders, ["o_orderstatus", "o_orderpriority"], "o_totalprice", "values", "Total"
    )
    return totals.orderBy(F.desc("Total"), "o_orderstatus", "o_orderpriority")


@check(
    """
    SELECT o_orderstatus, o_orderpriority, count(o_totalprice) AS "Total"
    FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderstatus, o_orderpriority
    """
)
def count_by_group_filtered(spark, folder):
    orders = table(spark, folder, "orders")
    totals = count_by(
        orders,
        ["o_orderstatus", "o_orderpriority"],
        "o_totalprice",
        "values",
        "Total",
        where=F.col("o_orderstatus") == "F",
    )
    return totals.orderBy(F.desc("Total"), "o_orderpriority")


@check(
    """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def sum_by_group(spark, folder):
    keys = ["l_returnflag", "l_linestatus"]
    totals = count_by(table(spark, folder, "lineitem"), keys, "l_quantity", "sum", "total")
    return totals.select(*keys, F.round("total", 2).alias("sum_qty"))


@check("SELECT count(*) AS rows FROM lineitem")
def count_rows(spark, folder):
    return row_count(table(spark, folder, "lineitem"))


@check(
    """
    SELECT user_id, count(*) AS count FROM events WHERE event_type = 'click' GROUP BY user_id
    """
)
def count_destinations(spark, folder):
    events = table(spark, folder, "events")
    return counts.count_for(events, "event_type", "click", "user_id", n=None)


@check(
    """
    SELECT p_type, count(*) AS count
    FROM part WHERE p_name IS NOT NULL AND contains(p_name, 'ring') GROUP BY p_type
    """
)
def contains_notnull_count(spark, folder):
    named = F.col("p_name").isNotNull() & F.col("p_name").contains("ring")
    counts_ = count_by(table(spark, folder, "part"), ["p_type"], where=named)
    return counts_.orderBy(F.desc("count"), "p_type")


@check(
    """
    SELECT cast(month(o_orderdate) AS integer) AS month, count(*) AS count
    FROM orders WHERE year(o_orderdate) = 1998
    GROUP BY month(o_orderdate) ORDER BY count(*) DESC, month(o_orderdate) LIMIT 1
    """
)
def busiest_month(spark, folder):
    counts_ = count_by(
        table(spark, folder, "orders"),
        [F.month("o_orderdate").alias("month")],
        where=in_year(F.col("o_orderdate"), 1998),
    )
    return top_n(counts_, 1, [F.desc("count")], ["month"])


@check(
    """
    SELECT p_brand, count(*) AS count
    FROM part WHERE contains(p_name, 'ring') AND contains(p_type, 'S')
    GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 3
    """
)
def top_groups_two_filters(spark, folder):
    both = F.col("p_name").contains("ring") & F.col("p_type").contains("S")
    counts_ = count_by(table(spark, folder, "part"), ["p_brand"], where=both)
    return top_n(counts_, 3, [F.desc("count")], ["p_brand"])


@check(
    """
    SELECT o_custkey, round(avg(o_totalprice), 4) AS avg_price
    FROM orders WHERE year(o_orderdate) = 1998
    GROUP BY o_custkey ORDER BY avg(o_totalprice) DESC, o_custkey LIMIT 10
    """
)
def mean_by_group_top10(spark, folder):
    means = mean_by(
        table(spark, folder, "orders"),
        ["o_custkey"],
        {"avg_price": "o_totalprice"},
        where=in_year(F.col("o_orderdate"), 1998),
    )
    best = top_n(means, 10, [F.desc("avg_price")], ["o_custkey"])
    return best.select("o_custkey", F.round("avg_price", 4).alias("avg_price"))


@check(
    """
    SELECT cast(week(o_orderdate) AS integer) AS "Week", count(*) AS count
    FROM orders GROUP BY week(o_orderdate)
    """
)
def iso_week_counts(spark, folder):
    return count_by(table(spark, folder, "orders"), [F.weekofyear("o_orderdate").alias("Week")])


@check(
    """
    SELECT c_nationkey, c_mktsegment, count(*) AS count
    FROM customer GROUP BY c_nationkey, c_mktsegment
    """
)
def cross_tab(spark, folder):
    return count_by(table(spark, folder, "customer"), ["c_nationkey", "c_mktsegment"])


@check("SELECT o_orderstatus FROM orders WHERE year(o_orderdate) = 1998")
def projected_out_filter(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.where(in_year(F.col("o_orderdate"), "1998")).select("o_orderstatus")


@check(
    """
    SELECT c_custkey, c_name, c_acctbal
    FROM customer WHERE c_acctbal < 0 ORDER BY c_acctbal, c_custkey LIMIT 5
    """
)
def low_threshold_top5(spark, folder):
    low = table(spark, folder, "customer").where(F.col("c_acctbal") < 0)
    return top_n(low.select("c_custkey", "c_name", "c_acctbal"), 5, ["c_acctbal"], ["c_custkey"])


@check(
    """
    SELECT c_nationkey, round(avg(c_acctbal), 4) AS avg_balance
    FROM customer WHERE c_acctbal > 1400 GROUP BY c_nationkey
    """
)
def mean_over_threshold(spark, folder):
    means = mean_by(
        table(spark, folder, "customer"),
        ["c_nationkey"],
        {"mean": "c_acctbal"},
        where=F.col("c_acctbal") > 1400,
    )
    return means.select("c_nationkey", F.round("mean", 4).alias("avg_balance"))


@check(
    """
    SELECT min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity,
           min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
    FROM lineitem
    """,
    name="min_max",
)
def min_max_values(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    return min_max(lineitem, {"l_quantity": "l_quantity", "l_extendedprice": "price"})


@check(
    """
    SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 4) AS avg_qty,
           round(avg(l_extendedprice), 4) AS avg_price, round(avg(l_discount), 4) AS avg_disc
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def multi_mean_sorted(spark, folder):
    names = {"avg_qty": "l_quantity", "avg_price": "l_extendedprice", "avg_disc": "l_discount"}
    keys = ["l_returnflag", "l_linestatus"]
    means = mean_by(table(spark, folder, "lineitem"), keys, names)
    ranked = means.orderBy([F.desc(name) for name in names])
    return ranked.select(*keys, *[F.round(name, 4).alias(name) for name in names])


@check(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100
    """,
    name="top_n",
)
def top_n_rows(spark, folder):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lineitem = table(spark, folder, "lineitem").select(*keys, "l_extendedprice")
    return top_n(lineitem, 100, [F.desc("l_extendedprice")], keys)


@check(
    """
    SELECT column_name AS name,
           CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
                WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type,
           true AS nullable, (SELECT count(*) FROM orders) AS rows
    FROM (DESCRIBE orders)
    """
)
def schema_report(spark, folder):
    return frame_report(table(spark, folder, "orders"))


MEAN_SQL = """
    SELECT cast(year(o_orderdate) AS integer) AS year, cast(month(o_orderdate) AS integer) AS month,
           round(avg(o_totalprice), 4) AS avg_price
    FROM orders {where} GROUP BY year(o_orderdate), month(o_orderdate)
"""


def monthly_price(spark, folder, valid_range=None):
    return weather.monthly_mean(
        table(spark, folder, "orders"), valid_range, "o_orderdate", "o_totalprice", "mean"
    )


def rounded_mean(df):
    return df.select("year", "month", F.round("mean", 4).alias("avg_price"))


@check(MEAN_SQL.format(where=""))
def year_month_mean(spark, folder):
    return rounded_mean(monthly_price(spark, folder))


@check(MEAN_SQL.format(where="WHERE o_totalprice BETWEEN 50000 AND 400000"))
def year_month_mean_valid(spark, folder):
    return rounded_mean(monthly_price(spark, folder, (50_000.0, 400_000.0)))


@check(
    f"""
    WITH monthly AS ({MEAN_SQL.format(where="")})
    SELECT * FROM monthly WHERE year = (SELECT min(year) FROM monthly) ORDER BY month LIMIT 12
    """
)
def first_year_12(spark, folder):
    return rounded_mean(weather.first_year(monthly_price(spark, folder)))


STDDEV_SQL = """
    SELECT cast(month(o_orderdate) AS integer) AS month,
           round(stddev_samp(o_totalprice), 4) AS sd_price
    FROM orders {where} GROUP BY month(o_orderdate)
"""


def monthly_spread(spark, folder, valid_range=None):
    spread = weather.monthly_stddev(
        table(spark, folder, "orders"), valid_range, "o_orderdate", "o_totalprice", "sd"
    )
    return spread.select("month", F.round("sd", 4).alias("sd_price"))


@check(STDDEV_SQL.format(where=""))
def month_stddev(spark, folder):
    return monthly_spread(spark, folder)


@check(STDDEV_SQL.format(where="WHERE o_totalprice BETWEEN 50000 AND 400000"))
def month_stddev_valid(spark, folder):
    return monthly_spread(spark, folder, (50_000.0, 400_000.0))


@check(
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice, row_number() OVER (
               ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey) AS position
    FROM orders
    """
)
def sorted_positions(spark, folder):
    """The place of every order by a key with few values, so that ranges must part its ties."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return with_position(orders, [F.desc("o_orderpriority"), "o_totalprice"], ["o_orderkey"])
