"""Tables outlive a session started with the persistent catalog. The catalog is a static setting,
so each session runs in a process of its own; its metastore is a file that only they open."""

import subprocess
import sys

from tests.conftest import ROOT

SCRIPT = """
import sys
from tallyroom.operators import create_database, external_table, catalog_columns
from tallyroom.plans import flights
from tallyroom.session import start_session
from tallyroom.sinks import save_table, write_csv

step, folder = sys.argv[1:]
spark = start_session("persistent", hive_catalog=True, conf={
    "spark.master": "local[2]",
    "spark.ui.enabled": "false",
    "spark.sql.warehouse.dir": f"{folder}/warehouse",
    "spark.hadoop.javax.jdo.option.ConnectionURL":
        f"jdbc:derby:;databaseName={folder}/metastore;create=true",
    "spark.driver.extraJavaOptions": f"-Dderby.stream.error.file={folder}/derby.log",
})
if step == "write":
    flight = spark.createDataFrame([("03010005", 1, 2, "ORD", "SFO")], flights.FLIGHT_COLUMNS)
    write_csv(flight, f"{folder}/flights.csv")
    create_database(spark, "kept_db")
    external_table(spark, "kept_db.flights", flights.FLIGHT_COLUMNS, f"{folder}/flights.csv")
    save_table(flight, "kept_db.copy")
else:
    create_database(spark, "kept_db")
    try:
        external_table(spark, "kept_db.flights", flights.FLIGHT_COLUMNS, f"{folder}/elsewhere")
    except ValueError as error:
        print(error)
    again = external_table(spark, "kept_db.flights", flights.FLIGHT_COLUMNS, f"{folder}/flights.csv")
    view = flights.period_view(spark, "kept_db.flights", "ord_march")
    print("rows", again.count(), view.count(), spark.table("kept_db.copy").count(),
          catalog_columns(spark, "kept_db.flights").count())
spark.stop()
"""


def test_tables_outlive_the_session(tmp_path):
    for step in ("write", "read"):
        done = subprocess.run(
            [sys.executable, "-c", SCRIPT, step, str(tmp_path)],
            cwd=ROOT, capture_output=True, text=True, timeout=300, check=False,
        )
        assert done.returncode == 0, done.stderr[-2000:]
    assert "rows 1 1 1 5" in done.stdout and "other columns or files" in done.stdout
