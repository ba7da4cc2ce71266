"""The command-line jobs end to end on small files, in the test session."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from tallyroom import sinks, sources
from tallyroom.__main__ import arguments, main
from tallyroom.plans import counts, flights, incidents
from tests.test_plans import CALLS, SAMPLE


def csv(path, columns, entries):
    names = [column.split()[0] for column in columns.split(", ")]
    lines = [",".join(names)]
    for entry in entries:
        lines.append(",".join("" if entry.get(n) is None else str(entry[n]) for n in names))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_every_job_has_help():
    for job in ("candy", "trips", "fire", "devices", "flights", "personnel", "weather-parse",
                "weather-monthly"):
        with pytest.raises(SystemExit) as stop:
            arguments().parse_args([job, "--help"])
        assert stop.value.code == 0
    with pytest.raises(SystemExit):
        arguments().parse_args([])


def test_candy(spark, tmp_path, capsys):
    entries = [{"State": s, "Color": "Red", "Count": 3} for s in ("CA", "CA", "TX")]
    main(["candy", csv(tmp_path / "m.csv", "State STRING, Color STRING, Count INT", entries)])
    out = capsys.readouterr().out
    assert "|CA   |Red  |2    |" in out and "Counts in CA" in out


def test_trips(spark, tmp_path, capsys):
    entries = [{"trip_id": 1, "gender": "Female", "to_station_name": "Clark St", "birthyear": 1980}]
    main(["trips", csv(tmp_path / "t.csv", counts.TRIP_COLUMNS, entries)])
    out = capsys.readouterr().out
    assert "|Clark St       |1    |" in out and "inferred" in out


def test_fire(spark, tmp_path, capsys):
    source = csv(tmp_path / "f.csv", incidents.FIRE_COLUMNS, CALLS)
    for _ in range(2):
        main(["--table-folder", str(tmp_path / "tables"), "fire", source,
              "--out", str(tmp_path / "typed"), "--table", "cli_fire"])
        spark.sql("DROP TABLE cli_fire")
    main(["fire", source, "--out", str(tmp_path / "typed"), "--table", "cli_fire"])
    out = capsys.readouterr().out
    assert "|10   |2    |" in out and "Chinatown" in out
    assert spark.table("cli_fire").count() == len(CALLS)
    spark.sql("DROP TABLE cli_fire")


def test_devices(spark, tmp_path, capsys):
    path = tmp_path / "d.json"
    path.write_text(
        '{"battery_level": 1, "c02_level": 1500, "cca2": "NO", "cca3": "NOR", "cn": "Norway", '
        '"device_id": 1, "device_name": "d1", "humidity": 50, "ip": "1.1.1.1", "latitude": 1.0, '
        '"lcd": "red", "longitude": 2.0, "scale": "Celsius", "temp": 20, "timestamp": 1}\n'
    )
    main(["devices", str(path)])
    assert "|Norway|1500.0 |" in capsys.readouterr().out


def test_flights(spark, tmp_path, capsys):
    entries = [
        {"date": "03010005", "delay": 130, "distance": 5, "origin": "ORD", "destination": "SFO"},
        {"date": "03160005", "delay": 150, "distance": 5, "origin": "SFO", "destination": "ORD"},
    ]
    source = csv(tmp_path / "f.csv", flights.FLIGHT_COLUMNS, entries)
    main(["flights", source, "--out", str(tmp_path), "--database", "cli_flights"])
    out = capsys.readouterr().out
    assert out.count("|03160005|150  |SFO   |ORD        |") == 2
    assert "Long Delays" in out and "month_of_date" in out
    assert sources.read_parquet(spark, str(tmp_path / "orddeparturedelays")).count() == 1
    for ending in ("parquet", "json", "json.lz4"):
        assert glob.glob(f"{tmp_path}/departuredelays.{ending}/part-*")


def test_weather(spark, tmp_path, capsys):
    (tmp_path / "60.txt").write_text(SAMPLE + "\n")
    base = str(tmp_path / "60")
    main(["weather-parse", f"{base}.txt", base])
    main(["weather-monthly", f"{base}.parquet", str(tmp_path / "three")])
    main(["weather-monthly", f"{base}.parquet", str(tmp_path / "spread"), "--spread",
          "--valid-only"])
    assert "|1950|12   |-5.0      |" in capsys.readouterr().out
    assert sources.read_csv(spark, str(tmp_path / "three.csv")).count() == 1


def test_personnel(spark, tmp_path, capsys):
    url = f"jdbc:derby:memory:cli{uuid.uuid4().hex};create=true"
    remote = sources.Remote(url)
    people = spark.range(20).select(F.col("id").cast("int").alias("emp_no"))
    sinks.write_jdbc(people, remote, "employees")
    sinks.write_jdbc(people.withColumn("salary", F.col("emp_no") * 10), remote, "salaries")
    ends = F.when(F.col("emp_no") < 5, "2001-01-01").otherwise("9999-01-01").cast("date")
    titles = people.withColumns({"title": F.lit("Senior Engineer"), "to_date": ends})
    sinks.write_jdbc(titles, remote, "titles", column_types="title VARCHAR(40)")
    main(["personnel", "--url", url, "--driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver",
          "--parts", "2", "--top", "3", "--out", str(tmp_path / "top.csv")])
    out = capsys.readouterr().out
    assert "|left   |5    |" in out and "|current|15   |" in out
    assert "Refused, as it should be" in out
    assert sorted(r.salary for r in sources.read_jdbc(spark, remote, "aces").collect()) == [
        170, 180, 190
    ]
    for name in ("left_table", "left_df"):
        assert sources.read_jdbc(spark, remote, name).count() == 5
        spark.sql(f"DROP TABLE {name}")
