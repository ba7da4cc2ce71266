"""The analyses on small frames in the shape of their input files."""

import datetime
import glob

import pytest
from pyspark.sql import functions as F

from tallyroom import sources
from tallyroom.functions import close_bands
from tallyroom.operators import conform
from tallyroom.plans import counts, devices, flights, incidents, weather


def rows(df):
    return [tuple(row) for row in df.collect()]


# Candy and trips


@pytest.fixture(scope="module")
def candy(spark):
    return spark.createDataFrame(
        [("CA", "Red", 5), ("CA", "Red", None), ("CA", "Red", 1), ("CA", "Blue", 7),
         ("TX", "Red", 1)],
        "State string, Color string, Count int",
    )


def test_candy(candy):
    assert rows(counts.candy_counts(candy)) == [
        ("CA", "Red", 2), ("CA", "Blue", 1), ("TX", "Red", 1)
    ]
    assert rows(counts.candy_counts(candy, "CA", "sum")) == [("CA", "Blue", 7), ("CA", "Red", 6)]
    assert rows(counts.candy_counts(candy, n=1)) == [("CA", "Red", 2)]


@pytest.fixture(scope="module")
def trips_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("trips") / "trips.csv"
    names = [column.split()[0] for column in counts.TRIP_COLUMNS.split(", ")]
    lines = [",".join(names)]
    for i, (place, gender, born) in enumerate(
        [("Clark St", "Female", "1980"), ("Clark St", "Female", ""), ("Canal St", "Female", "1990"),
         ("Lake St", "", "1970"), ("Canal St", "Male", "1960")]
    ):
        lines.append(f"{i},1/1/2015 0:0{i},1/1/2015 0:1{i},7,600,1,From,2,{place},Sub,{gender},{born}")
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_schema_trio(spark, trips_file):
    report = rows(counts.schema_trio(spark, trips_file))
    assert len(report) == 36
    assert {row[-1] for row in report} == {5}
    by_mode = {
        mode: [(name, kind) for m, name, kind, *_ in report if m == mode]
        for mode in ("inferred", "struct", "ddl")
    }
    assert by_mode["struct"] == by_mode["ddl"]
    assert by_mode["inferred"] == by_mode["ddl"]


def test_trips_by_destination(spark, trips_file):
    rides = sources.read_csv(spark, trips_file, counts.TRIP_COLUMNS)
    assert rows(counts.count_for(rides)) == [("Clark St", 2), ("Canal St", 1)]
    assert rows(counts.count_for(rides, value="Male")) == [("Canal St", 1)]


# Fire calls


def call(number, kind, date, city="SF", area="Mission", zipcode=94110, delay=1.0):
    return {
        "CallNumber": number, "CallType": kind, "CallDate": date, "WatchDate": date,
        "AvailableDtTm": f"{date} 01:00:00 PM", "City": city, "Neighborhood": area,
        "Zipcode": zipcode, "Delay": delay,
    }


CALLS = [
    call(1, "Structure Fire", "01/02/2018", delay=2.0),
    call(2, "Structure Fire", "10/05/2018", area="Chinatown", delay=9.0),
    call(3, "Vehicle Fire", "10/06/2018", city="San Francisco", area=None, zipcode=None, delay=None),
    call(4, "Medical Incident", "10/07/2018"),
    call(5, "Medical Incident", "10/08/2018"),
    call(6, "Outside Fire", "12/31/2018", delay=4.0),
    call(7, "Outside Fire", "10/31/2017", area="Tenderloin"),
    call(8, "Outside Fire", "10/31/2017", area="Tenderloin"),
    call(9, "Outside Fire", "10/31/2017", area="Tenderloin"),
    call(10, None, "10/09/2018"),
    call(11, "Vehicle Fire", "13/45/2018"),
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The calls through a CSV file with the columns in their order in the input."""
    path = tmp_path_factory.mktemp("fire") / "calls.csv"
    names = [column.split()[0] for column in incidents.FIRE_COLUMNS.split(", ")]
    lines = [",".join(names)]
    for entry in CALLS:
        lines.append(",".join("" if entry.get(n) is None else str(entry[n]) for n in names))
    path.write_text("\n".join(lines) + "\n")
    return sources.read_csv(spark, str(path), incidents.FIRE_COLUMNS)


@pytest.fixture(scope="module")
def timed(raw):
    return incidents.with_times(raw)


def test_fire_schema_and_times(raw, timed):
    assert len(raw.columns) == 28
    assert {"CallDate", "WatchDate", "AvailableDtTm"}.isdisjoint(timed.columns)
    first, *_, last = timed.orderBy("CallNumber").select(
        *[F.col(c).cast("timestamp_ntz") for c in ("IncidentDate", "OnWatchDate", "AvailableDtTS")]
    ).collect()
    assert first[0] == first[1] == datetime.datetime(2018, 1, 2)
    assert first[2] == datetime.datetime(2018, 1, 2, 13)
    assert tuple(last) == (None, None, None)


def test_call_types_look_at_the_text(raw):
    assert rows(incidents.call_types(raw)) == [
        ("Medical Incident", 2), ("Structure Fire", 2), ("Vehicle Fire", 2), ("Outside Fire", 1)
    ]


def test_busiest_month_and_week(timed):
    assert rows(incidents.busiest_month(timed)) == [(10, 2)]
    assert rows(incidents.busiest_month(timed, kind="Medical")) == [(10, 2)]
    # 2 January and 31 December 2018 both lie in an ISO week 1.
    assert rows(incidents.busiest_week(timed)) == [(1, 2)]


def test_areas(timed):
    assert rows(incidents.top_areas(timed)) == [
        ("Mission", 3), ("Tenderloin", 3), ("Chinatown", 1)
    ]
    assert rows(incidents.top_areas(timed, year=2018, n=1)) == [("Mission", 2)]
    assert rows(incidents.slowest_areas(timed)) == [
        ("Chinatown", 9.0), ("Mission", 3.0), (None, None)
    ]
    assert set(rows(incidents.area_zip_counts(timed))) == {
        ("Mission", 94110, 3), ("Chinatown", 94110, 1), ("Tenderloin", 94110, 3), (None, None, 1)
    }


def test_fire_round_trips(spark, timed, tmp_path):
    wanted = sorted(map(repr, timed.collect()))
    stored = incidents.roundtrip_parquet(timed, str(tmp_path / "calls"))
    assert sorted(map(repr, stored.collect())) == wanted
    for _ in range(2):
        table = incidents.roundtrip_table(timed, "fire_calls_copy", str(tmp_path / "table"))
        assert sorted(map(repr, table.collect())) == wanted
    spark.sql("DROP TABLE fire_calls_copy")


# Devices


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("iot") / "devices.json"
    template = (
        '{{"battery_level": {0}, "c02_level": {1}, "cca2": "{2}", "cca3": "X", "cn": "{3}", '
        '"device_id": {4}, "device_name": "device-{4}", "humidity": {5}, "ip": "1.1.1.1", '
        '"latitude": 1.5, "lcd": "red", "longitude": 2.5, "scale": "Celsius", "temp": {6}, '
        '"timestamp": 1458081226051}}'
    )
    entries = [
        (8, 1400, "US", "United States", 1, 50, 20), (7, 1401, "US", "United States", 2, 60, 22),
        (0, 800, "NO", "Norway", 3, 99, 10), (9, 1599, "NO", "Norway", 4, 25, 34),
        (4, 800, "FR", "France", 5, 40, 22),
    ]
    path.write_text("\n".join(template.format(*entry) for entry in entries))
    return conform(sources.read_json(spark, str(path)), devices.device_record())


def test_device_questions(readings):
    assert readings.schema == devices.device_record()
    assert rows(devices.low_battery_count(readings)) == [(3,)]
    assert rows(devices.low_battery(readings)) == [
        (0, 800, "device-3"), (4, 800, "device-5"), (7, 1401, "device-2")
    ]
    assert rows(devices.high_co2_by_country(readings)) == [
        ("Norway", 1599.0), ("United States", 1401.0)
    ]
    assert devices.measure_ranges(readings).first().asDict() == {
        "min_temperature": 10, "max_temperature": 34, "min_battery_level": 0,
        "max_battery_level": 9, "min_c02_level": 800, "max_c02_level": 1599,
        "min_humidity": 25, "max_humidity": 99,
    }
    assert rows(devices.country_means(readings, n=2)) == [
        ("NO", "Norway", 22.0, 1199.5, 62.0), ("FR", "France", 22.0, 800.0, 40.0)
    ]


# Flights


@pytest.fixture(scope="module")
def delays(spark):
    entries = [("03010005", d, 100, "ORD", "SFO") for d in (-1, 0, 1, 59, 60, 61, 120, 121, 360)]
    entries += [
        ("03152359", 361, 100, "ORD", "SFO"), ("03160000", None, 100, "ORD", "SFO"),
        ("02290600", 5, 100, "ORD", "SFO"), ("date", 5, 100, "ORD", "SFO"),
        ("01010600", 121, 100, "SFO", "ORD"), ("01020600", 333, 100, "SFO", "ORD"),
        ("01030600", 120, 100, "SFO", "ORD"), ("01040600", 500, 100, "SFO", "JFK"),
    ]
    return spark.createDataFrame(entries, flights.FLIGHT_COLUMNS)


def test_routes_both_ways(spark, delays):
    wanted = [("01020600", 333, "SFO", "ORD"), ("01010600", 121, "SFO", "ORD")]
    view = flights.register_flights(delays)
    assert rows(flights.route_delays(delays)) == wanted
    assert rows(flights.route_delays_sql(spark, view)) == wanted
    assert rows(flights.route_delays_sql(spark, view, "SFO", "JFK", over=200, n=1)) == rows(
        flights.route_delays(delays, "SFO", "JFK", over=200, n=1)
    )


@pytest.mark.parametrize("missing", [None, "Unknown"])
@pytest.mark.parametrize("closed", [False, True])
def test_labels_both_ways(spark, delays, closed, missing):
    view = flights.register_flights(delays)
    bands = close_bands(flights.DELAY_BANDS) if closed else flights.DELAY_BANDS
    by_frame = rows(flights.delay_labels(delays, bands, missing=missing))
    assert by_frame == rows(flights.delay_labels_sql(spark, view, bands, missing=missing))
    assert len(by_frame) == delays.count()
    labels = {row[0]: row[3] for row in by_frame}
    assert labels[60] == ("Tolerable Delays" if closed else "Early")
    assert labels[None] == (missing or "Early")


def test_period_both_ways(spark, delays):
    flights.register_flights(delays, "flights_of_march")
    by_sql = rows(flights.period_view(spark, "flights_of_march", "ord_march"))
    assert sorted(by_sql, key=repr) == sorted(rows(flights.period_frame(delays)), key=repr)
    assert len(by_sql) == 10
    assert {row[4:] for row in by_sql} == {(3, 1), (3, 15)}
    february = flights.period_frame(delays, month=2, days=(1, 29))
    assert rows(february) == []


def test_typed_dates(delays):
    days = {row.date for row in flights.typed_flights(delays).collect()}
    assert datetime.date(1970, 3, 15) in days and None in days
    leap = {row.date for row in flights.typed_flights(delays, leap_safe=True).collect()}
    assert datetime.date(2000, 2, 29) in leap


def test_copies_and_rewrite(spark, delays, tmp_path):
    paths = flights.export_copies(delays, str(tmp_path / "departuredelays"))
    wanted = sorted(map(repr, rows(delays)))
    columns = delays.columns
    for kind, frame in {
        "parquet": sources.read_parquet(spark, paths["parquet"]),
        "json": sources.read_json(spark, paths["json"]),
        "json_lz4": sources.read_json(spark, paths["json_lz4"], flights.FLIGHT_COLUMNS),
    }.items():
        got = frame.select(F.col("date"), *[F.col(c).cast(delays.schema[c].dataType) for c in columns[1:]])
        assert sorted(map(repr, rows(got))) == wanted, kind
    kept = flights.filter_rewrite(spark, paths["parquet"], str(tmp_path / "ord"))
    assert kept.columns == ["date", "delay", "origin", "destination", "distance"]
    assert kept.count() == delays.where("origin = 'ORD'").count()


# Weather

# A raw line.
SAMPLE = (
    "0088999999949101950123114005+42550-092400SAO  +026599999V02015859008850609649N012800599"
    "-00504-00785999999EQDN01 00000JPWTH 1QNNG11 1 00200K11 1 00018L11 1 00800N11 1 00000S11 1 "
    "00023W11 1 54017"
)


def test_sample_line(spark):
    parsed = weather.parse_weather(spark.createDataFrame([(SAMPLE,)], "value string"))
    assert parsed.first().asDict() == {
        "WeatherStation": "999999", "WBAN": "94910",
        "ObservationDate": datetime.date(1950, 12, 31), "ObservationHour": 1400,
        "Latitude": 42.55, "Longitude": -92.4, "Elevation": 265, "WindDirection": 158,
        "WDQualityCode": 5, "SkyCeilingHeight": 6096, "SCQualityCode": 4,
        "VisibilityDistance": 12800, "VDQualityCode": 9, "AirTemperature": -5.0,
        "ATQualityCode": 4, "DewPoint": -78.0, "DPQualityCode": 5, "AtmosphericPressure": 9999.9,
        "APQualityCode": 9,
    }
    kinds = {field.name: field.dataType.simpleString() for field in parsed.schema}
    assert kinds["Latitude"] == "double" and kinds["DewPoint"] == "float"
    scaled = weather.parse_weather(
        spark.createDataFrame([(SAMPLE,)], "value string"), weather.scaled_dew_point()
    )
    assert scaled.first().DewPoint == pytest.approx(-7.8)


def test_broken_lines_keep_their_row(spark, tmp_path):
    comma = SAMPLE[:10] + ',"x"' + SAMPLE[14:]
    letters = SAMPLE[:63] + "A" + SAMPLE[64:92] + "P" + SAMPLE[93:]
    path = tmp_path / "60.txt"
    path.write_text("\n".join([SAMPLE[:30], comma, letters, "", SAMPLE]) + "\n")
    short, with_comma, lettered, whole = weather.parse_weather(
        sources.read_lines(spark, str(path))
    ).collect()
    assert (short.WeatherStation, short.ObservationHour) == ("999999", 1400)
    assert (short.Elevation, short.AirTemperature, short.APQualityCode) == (None, None, None)
    assert with_comma.WBAN.startswith(',"x"') and with_comma.AirTemperature == -5.0
    assert (lettered.WDQualityCode, lettered.ATQualityCode, lettered.DewPoint) == (None, None, -78.0)
    assert whole.AirTemperature == -5.0


def test_export_gives_four_equal_copies(spark, tmp_path):
    lines = spark.createDataFrame([(SAMPLE,), (SAMPLE[:60],)], "value string").repartition(2)
    base = str(tmp_path / "60")
    stored = weather.export_weather(lines, base, single_file=True)
    wanted = sorted(map(repr, rows(weather.parse_weather(lines))))
    assert sorted(map(repr, rows(stored))) == wanted
    for name in ("-uncompressed.csv", "-compressed.csv", ".csv"):
        copy = sources.read_csv(spark, base + name, stored.schema)
        assert sorted(map(repr, rows(copy))) == wanted
    assert len(glob.glob(f"{base}.csv/part-*")) == 1
    assert glob.glob(f"{base}-compressed.csv/*.csv.lz4")
    weather.export_weather(lines, base, mode="overwrite")
    assert len(glob.glob(f"{base}.csv/part-*")) == 2


def test_single_export_is_not_left_to_one_task(spark, tmp_path, monkeypatch):
    lines = spark.createDataFrame([(SAMPLE,)] * 500, "value string").repartition(5)

    def refuse(*_):
        raise AssertionError("one task reads and writes all rows")

    monkeypatch.setattr(weather, "write_single_csv", refuse)
    stored = weather.export_weather(lines, str(tmp_path / "60"), single_file=True)
    assert len(glob.glob(f"{tmp_path}/60.csv/part-*")) == 1
    assert sources.read_csv(spark, f"{tmp_path}/60.csv", stored.schema).count() == 500


@pytest.fixture(scope="module")
def observed(spark):
    entries = [
        (f"19{year}-{month:02d}-{day:02d}", float(month + day + year - 60))
        for year in (60, 61) for month in range(1, 13) for day in (1, 2)
        if (year, month) != (60, 1)
    ]
    entries += [("1960-02-03", 999.9), (None, 5.0), ("1961-01-05", None)]
    df = spark.createDataFrame(entries, "d string, AirTemperature double")
    return df.select(F.col("d").cast("date").alias("ObservationDate"), "AirTemperature")


def test_monthly_means(observed):
    means = {row[:2]: row[2] for row in rows(weather.monthly_mean(observed))}
    assert means[(1960, 2)] == pytest.approx((3 + 4 + 999.9) / 3)
    assert means[(1961, 1)] == 3.5
    assert means[(None, None)] == 5.0
    valid = weather.monthly_mean(observed, weather.PLAUSIBLE_CELSIUS)
    assert {row[:2]: row[2] for row in rows(valid)}[(1960, 2)] == 3.5


def test_first_year_is_one_year_even_if_short(observed):
    first = rows(weather.first_year(weather.monthly_mean(observed)))
    assert [(row[0], row[1]) for row in first] == [(1960, m) for m in range(2, 13)]
    assert len(rows(weather.first_year(weather.monthly_mean(observed), n=3))) == 3


def test_monthly_spread(observed):
    spread = dict(rows(weather.monthly_stddev(observed, weather.PLAUSIBLE_CELSIUS)))
    assert spread[1] == pytest.approx(0.5**0.5)
    assert spread[None] is None
    # Values 5, 6, 6, 7 in March of two years.
    assert spread[3] == pytest.approx((2 / 3) ** 0.5)


@pytest.mark.parametrize("spread, lines", [(False, 11), (True, 12)])
def test_monthly_export(spark, observed, tmp_path, spread, lines):
    base = str(tmp_path / "part-three")
    stored = weather.export_monthly(observed, base, weather.PLAUSIBLE_CELSIUS, spread)
    copy = sources.read_csv(spark, f"{base}.csv", stored.schema)
    assert copy.count() == lines
    assert [row.month for row in copy.collect()] == list(range(13 - lines, 13))
    if spread:
        assert sources.read_parquet(spark, f"{base}-means.parquet").count() == 24
