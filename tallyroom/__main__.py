"""Command line: `python -m tallyroom <job> …`, or the same file under spark-submit."""

from __future__ import annotations

import argparse
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallyroom.operators import (
    catalog_columns,
    create_database,
    external_table,
    frame_report,
    row_count,
)
from tallyroom.plans import counts, devices, flights, hr, incidents, weather
from tallyroom.session import start_session
from tallyroom.sinks import write_jdbc
from tallyroom.sources import (
    Remote,
    even_predicates,
    object_store_conf,
    read_csv,
    read_jdbc,
    read_json,
    read_lines,
    read_parquet,
)
from tallyroom.staging import scratch_job, settle


def show(title: str, df: DataFrame, n: int = 20) -> None:
    print(title)
    df.show(n, truncate=False)


def table_path(args: argparse.Namespace, name: str) -> str | None:
    return None if args.table_folder is None else f"{args.table_folder.rstrip('/')}/{name}"


def candy(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = settle(read_csv(spark, args.path, counts.CANDY_COLUMNS), "candy")
    totals = counts.candy_counts(rows, how=args.how)
    show("Counts per state and colour", totals, 60)
    show("Number of groups", row_count(totals))
    show(f"Counts in {args.state}", counts.candy_counts(rows, args.state, args.how), 10)


def trips(spark: SparkSession, args: argparse.Namespace) -> None:
    show("Columns and rows under three schemas", counts.schema_trio(spark, args.path), 60)
    rides = read_csv(spark, args.path, counts.TRIP_COLUMNS)
    show(f"Destinations of {args.gender} riders", counts.count_for(rides, value=args.gender))


def fire(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = settle(read_csv(spark, args.path, incidents.FIRE_COLUMNS), "calls")
    show(f"Kinds of calls in {args.year}", incidents.call_types(raw, args.year))
    calls = incidents.roundtrip_parquet(incidents.with_times(raw), args.out)
    show("Busiest month", incidents.busiest_month(calls, args.year))
    show("Neighbourhoods with most fire calls", incidents.top_areas(calls, year=args.areas_year))
    show("Slowest responses", incidents.slowest_areas(calls, args.year))
    show("Busiest week", incidents.busiest_week(calls, args.year))
    show("Calls per neighbourhood and zip code", incidents.area_zip_counts(calls))
    table = incidents.roundtrip_table(calls, args.table, table_path(args, args.table))
    show("Read back from the table", table, 5)


def iot(spark: SparkSession, args: argparse.Namespace) -> None:
    # Types named beforehand save a pass over the file; a value of another type is refused.
    readings = read_json(spark, args.path, devices.device_record(), mode="FAILFAST")
    readings = settle(readings, "devices")
    show("Devices with a weak battery", devices.low_battery_count(readings, args.battery))
    show("Those with the least CO2", devices.low_battery(readings, args.battery))
    show("Countries with high CO2", devices.high_co2_by_country(readings, args.co2))
    show("Ranges", devices.measure_ranges(readings))
    show("Means per country", devices.country_means(readings))


def flight(spark: SparkSession, args: argparse.Namespace) -> None:
    delays = read_csv(spark, args.path, flights.FLIGHT_COLUMNS)
    copies = flights.export_copies(delays, f"{args.out}/departuredelays", mode="overwrite")
    stored = read_parquet(spark, copies["parquet"])
    view = flights.register_flights(stored)
    show("Late flights, SQL", flights.route_delays_sql(spark, view, n=10))
    show("Late flights, DataFrame", flights.route_delays(stored, n=10))
    show("Delay labels, SQL", flights.delay_labels_sql(spark, view, n=10))
    show("Delay labels, DataFrame", flights.delay_labels(stored, n=10))
    create_database(spark, args.database)
    table = f"{args.database}.us_delay_flights_tbl"
    # The catalog reads a relative path from the place of the database. Name a full URI for any
    # other file system than this machine's.
    path = args.path if "://" in args.path else os.path.abspath(args.path)
    external_table(spark, table, flights.FLIGHT_COLUMNS, path, replace=True)
    period = flights.period_view(spark, table, f"us_origin_airport_{args.origin}_tmp_view",
                                 args.origin)
    show(f"Flights from {args.origin}, 1 to 15 March", period.orderBy("delay", ascending=False), 5)
    show("Columns of the table", catalog_columns(spark, table))
    kept = flights.filter_rewrite(
        spark, copies["parquet"], f"{args.out}/{args.origin.lower()}departuredelays", args.origin,
        mode="overwrite",
    )
    show(f"Rewritten flights from {args.origin}", kept, 10)


def personnel(spark: SparkSession, args: argparse.Namespace) -> None:
    remote = Remote(
        args.url, args.driver, os.environ.get(args.user_variable),
        os.environ.get(args.password_variable),
    )

    def whole(table: str) -> DataFrame:
        ranges = even_predicates(spark, remote, table, "emp_no", args.parts)
        return read_jdbc(spark, remote, table, predicates=ranges)

    show("Employees", frame_report(whole("employees")))
    best = hr.publish_top_salaries(
        whole("salaries"), remote, args.out, args.top, mode="overwrite"
    )
    show("Highest salaries", best)
    ranges = even_predicates(spark, remote, "titles", "emp_no", args.parts)
    holders = hr.titles_of(spark, remote, args.title, predicates=ranges)
    titles = settle(hr.with_status(holders), "titles")
    show(f"{args.title}: status", hr.status_counts(titles))
    names = hr.LEAVER_NAMES
    places = {kind: table_path(args, names[kind]) for kind in ("table", "frame")}
    published = hr.publish_leavers(
        hr.leavers(titles), remote, names, mode="overwrite", paths=places
    )
    for name in ("aces", *names.values()):
        show(f"Remote table {name}", frame_report(read_jdbc(spark, remote, name)))
    try:
        write_jdbc(published["table"], remote, names["frame"], mode="errorifexists")
    except AnalysisException as error:
        print(f"Refused, as it should be: {error}")


def weather_parse(spark: SparkSession, args: argparse.Namespace) -> None:
    fields = weather.scaled_dew_point() if args.scale_dew_point else weather.WEATHER_FIELDS
    lines = read_lines(spark, args.path)
    stored = weather.export_weather(lines, args.base, fields, args.single_file, mode="overwrite")
    stored.printSchema()
    show("Weather", stored, 5)


def weather_monthly(spark: SparkSession, args: argparse.Namespace) -> None:
    valid = (args.low, args.high) if args.valid_only else None
    stored = weather.export_monthly(
        read_parquet(spark, args.path), args.base, valid, args.spread, mode="overwrite"
    )
    stored.printSchema()
    show("Per month", stored, 12)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallyroom", description=__doc__)
    parser.add_argument(
        "--forget", action="store_true", help="keep tables for this run only, in memory"
    )
    parser.add_argument("--s3-endpoint", help="object store to use for s3a:// paths")
    parser.add_argument(
        "--table-folder",
        help="where tables lie; with --forget a managed one is in the way of the next run",
    )
    jobs = parser.add_subparsers(required=True, metavar="job")

    def job(name: str, run, path: str | None = "path") -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        if path:
            sub.add_argument(path)
        return sub

    sub = job("candy", candy)
    sub.add_argument("--state", default="CA")
    sub.add_argument("--how", choices=["values", "sum"], default="values")
    sub = job("trips", trips)
    sub.add_argument("--gender", default="Female")
    sub = job("fire", fire)
    sub.add_argument("--year", type=int, default=2018)
    sub.add_argument("--areas-year", type=int, help="limit the neighbourhood ranking to a year")
    sub.add_argument("--out", default="./parquet_folder")
    sub.add_argument("--table", default="sf_fire_table")
    sub = job("devices", iot)
    sub.add_argument("--battery", type=int, default=8)
    sub.add_argument("--co2", type=int, default=1400)
    sub = job("flights", flight)
    sub.add_argument("--out", default=".")
    sub.add_argument("--origin", default="ORD")
    sub.add_argument("--database", default="learn_spark_db")
    sub = job("personnel", personnel, path=None)
    sub.add_argument("--url", default="jdbc:mysql://localhost:3306/employees")
    sub.add_argument("--driver", default="com.mysql.cj.jdbc.Driver")
    sub.add_argument("--user-variable", default="DBUSER")
    sub.add_argument("--password-variable", default="DBPASSWORD")
    sub.add_argument("--parts", type=int, default=16)
    sub.add_argument("--top", type=int, default=10_000)
    sub.add_argument("--title", default="Senior Engineer")
    sub.add_argument("--out", default="top_salaries.csv.snappy")
    sub = job("weather-parse", weather_parse)
    sub.add_argument("base", help="output path without its ending, such as s3a://bucket/60")
    sub.add_argument("--scale-dew-point", action="store_true")
    sub.add_argument("--single-file", action="store_true",
                     help="write the last CSV as one file, in one task")
    sub = job("weather-monthly", weather_monthly)
    sub.add_argument("base", help="output path without its ending")
    sub.add_argument("--valid-only", action="store_true", help="leave out other temperatures")
    sub.add_argument("--low", type=float, default=weather.PLAUSIBLE_CELSIUS[0])
    sub.add_argument("--high", type=float, default=weather.PLAUSIBLE_CELSIUS[1])
    sub.add_argument("--spread", action="store_true", help="standard deviation per month")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    conf = object_store_conf(args.s3_endpoint) if args.s3_endpoint else None
    spark = start_session(f"tallyroom {args.run.__name__}", not args.forget, conf)
    with scratch_job(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
