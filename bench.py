"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the threads, `BENCH_RUNS` the timed runs per query
(the fastest counts, after one run to warm up). Every result is computed whole and thrown away.
With `--plain`, the jobs whose design saves work are timed next to the plain way to write them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import QUERIES
from checks.places import raw_calls
from checks.registry import table
from checks.text import weather_lines
from tallyroom.functions import in_year
from tallyroom.plans import hr, incidents, weather
from tallyroom.sinks import write_csv, write_parquet
from tallyroom.sources import read_csv, read_parquet
from tallyroom.staging import scratch_path

HEADLINE = [
    "count_by_group",
    "count_by_group_filtered",
    "sum_by_group",
    "count_destinations",
    "contains_notnull_count",
    "busiest_month",
    "mean_by_group_top10",
    "cross_tab",
    "low_threshold_top5",
    "mean_over_threshold",
    "min_max",
    "multi_mean_sorted",
    "route_filter_df",
    "route_filter_sql",
    "label_df",
    "label_sql",
    "month_day_view",
    "top_n",
    "status_counts",
    "timestamp_patterns",
    "yearless_dates",
    "year_month_mean",
    "first_year_12",
    "month_stddev_valid",
    "fire_slowest_areas",
    "device_country_means",
    "flight_labels",
    "fixed_width",
    "weather_export",
    "json_lz4_roundtrip",
    "csv_lz4_roundtrip",
    "parquet_filter_rewrite",
    "table_roundtrip",
    "jdbc_partitioned",
    "jdbc_leavers",
    "jdbc_top_salaries",
    "single_file_csv",
    "flight_copy_json",
    "fire_busiest_month",
]


def start(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyroom bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.extraJavaOptions", "-Dderby.stream.error.file=/dev/null")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use(df: DataFrame | None) -> None:
    if df is not None:
        df.write.format("noop").mode("overwrite").save()


def fastest(job: Callable[[], DataFrame | None], runs: int) -> float:
    use(job())
    times = []
    for _ in range(runs):
        began = time.perf_counter()
        use(job())
        times.append(time.perf_counter() - began)
    return round(min(times), 4)


def pairs(spark: SparkSession, folder: str) -> dict[str, tuple[Callable, Callable]]:
    """Job name to (this library's way, the plain way); both give the same rows or files."""
    lines = weather_lines(spark, folder)
    statuses = hr.with_status(
        table(spark, folder, "lineitem"), "1998-06-15", "1999-01-01", end="l_shipdate"
    )
    calls_csv = scratch_path(spark, "bench-calls")
    write_csv(
        raw_calls(spark, folder).select("CallType", "CallDate", "City", "Neighborhood", "Delay"),
        calls_csv,
    )
    calls_ddl = "CallType STRING, CallDate STRING, City STRING, Neighborhood STRING, Delay FLOAT"
    orders_csv = scratch_path(spark, "bench-orders")
    write_csv(table(spark, folder, "orders"), orders_csv)
    orders_ddl = (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    )

    def four_parses() -> None:
        base = scratch_path(spark, "bench-weather")
        parsed = weather.parse_weather(lines)
        write_csv(parsed, f"{base}-uncompressed.csv")
        write_csv(parsed, f"{base}-compressed.csv", compression="lz4")
        write_csv(parsed.coalesce(1), f"{base}.csv")
        write_parquet(parsed, f"{base}.parquet")

    def questions(typed: DataFrame) -> DataFrame:
        answers = [
            incidents.busiest_month(typed, 1998).select(F.col("count").cast("double")),
            incidents.top_areas(typed).select(F.col("count").cast("double")),
            incidents.slowest_areas(typed, 1998).select("avg_delay"),
            incidents.busiest_week(typed, 1998).select(F.col("count").cast("double")),
        ]
        for answer in answers:
            use(answer)

    def dated(df: DataFrame) -> DataFrame:
        when = incidents.parse_timestamp(F.col("CallDate"), incidents.SLASHED_DAY)
        return df.withColumn("IncidentDate", when).drop("CallDate")

    def from_copy() -> None:
        path = scratch_path(spark, "bench-typed")
        write_parquet(dated(read_csv(spark, calls_csv, calls_ddl)), path)
        questions(read_parquet(spark, path))

    def two_scans() -> None:
        for status in ("left", "current"):
            use(statuses.where(F.col("status") == status).agg(F.count(F.lit(1))))

    return {
        "weather_four_outputs": (
            lambda: weather.export_weather(lines, scratch_path(spark, "bench-weather")) and None,
            four_parses,
        ),
        "fire_four_questions": (
            from_copy,
            lambda: questions(dated(read_csv(spark, calls_csv, calls_ddl))),
        ),
        "status_of_two_kinds": (lambda: hr.status_counts(statuses), two_scans),
        "csv_declared_types": (
            lambda: read_csv(spark, orders_csv, orders_ddl),
            lambda: read_csv(spark, orders_csv),
        ),
        "year_as_range": (
            lambda: table(spark, folder, "lineitem")
            .where(in_year(F.col("l_shipdate"), 1998)).groupBy("l_suppkey").count(),
            lambda: table(spark, folder, "lineitem")
            .where(F.year("l_shipdate") == 1998).groupBy("l_suppkey").count(),
        ),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = start(cpus)
    if "--plain" in sys.argv:
        report = {
            name: {"ours": fastest(ours, runs), "plain": fastest(plain, runs)}
            for name, (ours, plain) in pairs(spark, folder).items()
        }
        print(json.dumps({"sf_dir": folder, "seconds": report}))
        return
    times = {name: fastest(lambda n=name: QUERIES[n](spark, folder), runs) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
