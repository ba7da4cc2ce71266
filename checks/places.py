"""The fire-call, device and candy analyses over frames shaped from `orders` and `lineitem`.

Spark derives the frames with column expressions only; the SQL beside them derives the same rows.
"""

from pyspark.sql import functions as F

from checks.registry import check, table
from tallyroom.plans import counts, devices, incidents
from tallyroom.staging import settle

YEAR = 1998

CALLS_SQL = """
    WITH calls AS (
        SELECT o_orderkey AS order_no, cast(o_orderkey % 1000000000 AS integer) AS "CallNumber",
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Structure Fire'
                    WHEN '2-HIGH' THEN 'Outside Fire' WHEN '3-MEDIUM' THEN 'Medical Incident'
                    WHEN '5-LOW' THEN 'Vehicle Fire' END AS "CallType",
               CASE WHEN o_totalprice < 20000 THEN '13/45/1998'
                    ELSE strftime(o_orderdate, '%m/%d/%Y') END AS "CallDate",
               CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_orderdate END AS "IncidentDate",
               CASE o_orderstatus WHEN 'F' THEN 'SF' WHEN 'O' THEN 'San Francisco'
                    ELSE 'SF BAY' END AS "City",
               cast(94100 + floor(o_totalprice / 25000) AS integer) AS "Zipcode",
               CASE WHEN o_totalprice <= 480000
                    THEN 'Area ' || cast(floor(o_totalprice / 10000) AS integer)
                    END AS "Neighborhood",
               cast(o_totalprice / 10000 AS float) AS "Delay"
        FROM orders
    ),
    fires AS (SELECT * FROM calls WHERE contains("CallType", 'Fire')),
    fires_of_year AS (SELECT * FROM fires WHERE year("IncidentDate") = 1998)
"""


def raw_calls(spark, folder):
    """Orders in the shape of the fire-call file: text dates, some of them impossible."""
    price, day = F.col("o_totalprice"), F.col("o_orderdate")
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Structure Fire")
        .when(F.col("o_orderpriority") == "2-HIGH", "Outside Fire")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Medical Incident")
        .when(F.col("o_orderpriority") == "5-LOW", "Vehicle Fire")
    )
    city = (
        F.when(F.col("o_orderstatus") == "F", "SF")
        .when(F.col("o_orderstatus") == "O", "San Francisco")
        .otherwise("SF BAY")
    )
    area = F.concat(F.lit("Area "), F.floor(price / 10_000).cast("string"))
    written = F.date_format(day, "MM/dd/yyyy")
    return table(spark, folder, "orders").select(
        (F.col("o_orderkey") % 1_000_000_000).cast("int").alias("CallNumber"),
        kind.alias("CallType"),
        F.when(price < 20_000, "13/45/1998").otherwise(written).alias("CallDate"),
        written.alias("WatchDate"),
        F.concat(written, F.lit(" 01:02:03 PM")).alias("AvailableDtTm"),
        city.alias("City"),
        (94_100 + F.floor(price / 25_000)).cast("int").alias("Zipcode"),
        F.when(price <= 480_000, area).alias("Neighborhood"),
        (price / 10_000).cast("float").alias("Delay"),
    )


def calls(spark, folder):
    """Parsed once and stored, so that the questions read a few columns and filter in the scan."""
    return settle(incidents.with_times(raw_calls(spark, folder)), "calls")


@check(
    CALLS_SQL
    + """
    SELECT "CallNumber", "IncidentDate", o_orderdate AS "OnWatchDate",
           o_orderdate + INTERVAL '13 hours 2 minutes 3 seconds' AS "AvailableDtTS"
    FROM calls JOIN orders ON order_no = o_orderkey
    """
)
def fire_times(spark, folder):
    timed = incidents.with_times(raw_calls(spark, folder), local=True)
    return timed.select("CallNumber", "IncidentDate", "OnWatchDate", "AvailableDtTS")


@check(
    CALLS_SQL
    + """
    SELECT "CallType", count(*) AS count FROM calls
    WHERE "CallType" IS NOT NULL AND contains("CallDate", '1998') GROUP BY "CallType"
    """
)
def fire_call_types(spark, folder):
    return incidents.call_types(raw_calls(spark, folder), YEAR)


@check(
    CALLS_SQL
    + """
    SELECT cast(month("IncidentDate") AS integer) AS month, count(*) AS count
    FROM fires_of_year GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1
    """
)
def fire_busiest_month(spark, folder):
    return incidents.busiest_month(calls(spark, folder), YEAR)


@check(
    CALLS_SQL
    + """
    SELECT "Neighborhood", count(*) AS count FROM fires WHERE contains("City", 'SF')
    GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 3
    """
)
def fire_top_areas(spark, folder):
    return incidents.top_areas(calls(spark, folder))


@check(
    CALLS_SQL
    + """
    SELECT "Neighborhood", count(*) AS count FROM fires_of_year WHERE contains("City", 'SF')
    GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 3
    """
)
def fire_top_areas_of_year(spark, folder):
    return incidents.top_areas(calls(spark, folder), year=YEAR)


@check(
    CALLS_SQL
    + """
    SELECT "Neighborhood", round(avg("Delay"), 4) AS avg_delay FROM fires_of_year
    GROUP BY 1 ORDER BY avg("Delay") DESC, 1 NULLS FIRST LIMIT 10
    """
)
def fire_slowest_areas(spark, folder):
    slow = incidents.slowest_areas(calls(spark, folder), YEAR)
    return slow.select("Neighborhood", F.round("avg_delay", 4).alias("avg_delay"))


@check(
    CALLS_SQL
    + """
    SELECT cast(week("IncidentDate") AS integer) AS "Week", count(*) AS count
    FROM fires_of_year GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1
    """
)
def fire_busiest_week(spark, folder):
    return incidents.busiest_week(calls(spark, folder), YEAR)


@check(
    CALLS_SQL
    + """
    SELECT "Neighborhood", "Zipcode", count(*) AS count FROM fires GROUP BY 1, 2
    """
)
def fire_area_zip_counts(spark, folder):
    return incidents.area_zip_counts(calls(spark, folder))


DEVICES_SQL = """
    WITH devices AS (
        SELECT l_linenumber + 3 AS battery_level,
               800 + cast(floor(l_quantity * 16) AS bigint) AS c02_level,
               l_returnflag AS cca2, l_linestatus || '-' || l_suppkey AS cn,
               'device-' || l_orderkey || '-' || l_partkey || '-' || l_suppkey AS device_name,
               25 + cast(round(l_discount * 100) AS bigint) AS humidity,
               10 + 2 * month(l_shipdate) AS temp
        FROM lineitem
    )
"""


def readings(spark, folder):
    """Line items in the shape of the device file."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") + 3).cast("bigint").alias("battery_level"),
        (800 + F.floor(F.col("l_quantity") * 16)).alias("c02_level"),
        F.col("l_returnflag").alias("cca2"),
        F.concat_ws("-", "l_linestatus", "l_suppkey").alias("cn"),
        F.concat_ws("-", F.lit("device"), "l_orderkey", "l_partkey", "l_suppkey").alias(
            "device_name"
        ),
        (25 + F.round(F.col("l_discount") * 100).cast("bigint")).alias("humidity"),
        (10 + 2 * F.month("l_shipdate")).cast("bigint").alias("temp"),
    )


@check(DEVICES_SQL + "SELECT count(*) AS rows FROM devices WHERE battery_level < 8")
def device_low_battery_count(spark, folder):
    return devices.low_battery_count(readings(spark, folder))


@check(
    DEVICES_SQL
    + """
    SELECT cast(battery_level AS bigint) AS battery_level, c02_level, device_name FROM devices
    WHERE battery_level < 8 ORDER BY c02_level, device_name, battery_level LIMIT 5
    """
)
def device_low_battery(spark, folder):
    return devices.low_battery(readings(spark, folder))


@check(
    DEVICES_SQL
    + """
    SELECT cn, round(avg(c02_level), 4) AS avg_c02 FROM devices WHERE c02_level > 1400 GROUP BY cn
    """
)
def device_high_co2(spark, folder):
    means = devices.high_co2_by_country(readings(spark, folder), n=None)
    return means.select("cn", F.round("avg_c02", 4).alias("avg_c02"))


@check(
    DEVICES_SQL
    + """
    SELECT cast(min(temp) AS bigint) AS min_temperature,
           cast(max(temp) AS bigint) AS max_temperature,
           cast(min(battery_level) AS bigint) AS min_battery_level,
           cast(max(battery_level) AS bigint) AS max_battery_level,
           min(c02_level) AS min_c02_level, max(c02_level) AS max_c02_level,
           min(humidity) AS min_humidity, max(humidity) AS max_humidity
    FROM devices
    """
)
def device_ranges(spark, folder):
    return devices.measure_ranges(readings(spark, folder))


@check(
    DEVICES_SQL
    + """
    SELECT cca2, cn, round(avg(temp), 4) AS avg_temperature,
           round(avg(c02_level), 4) AS avg_c02_level, round(avg(humidity), 4) AS avg_humidity
    FROM devices GROUP BY cca2, cn
    ORDER BY avg(temp) DESC, avg(c02_level) DESC, avg(humidity) DESC, cca2, cn LIMIT 5
    """
)
def device_country_means(spark, folder):
    means = devices.country_means(readings(spark, folder))
    names = ["avg_temperature", "avg_c02_level", "avg_humidity"]
    return means.select("cca2", "cn", *[F.round(name, 4).alias(name) for name in names])


CANDY_SQL = """
    WITH candy AS (
        SELECT l_returnflag AS "State", l_linestatus AS "Color",
               CASE WHEN l_linenumber < 7 THEN cast(l_quantity AS integer) END AS "Count"
        FROM lineitem
    )
"""


def candy(spark, folder):
    """Line items as candy counts, some of them unknown."""
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("State"),
        F.col("l_linestatus").alias("Color"),
        F.when(F.col("l_linenumber") < 7, F.col("l_quantity").cast("int")).alias("Count"),
    )


@check(CANDY_SQL + """SELECT "State", "Color", count("Count") AS "Total" FROM candy GROUP BY 1, 2""")
def candy_counts(spark, folder):
    return counts.candy_counts(candy(spark, folder))


@check(
    CANDY_SQL
    + """
    SELECT "State", "Color", cast(sum("Count") AS bigint) AS "Total" FROM candy
    WHERE "State" = 'A' GROUP BY 1, 2
    """
)
def candy_sums_of_state(spark, folder):
    return counts.candy_counts(candy(spark, folder), state="A", how="sum")
