import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tallyroom-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", f"-Dderby.stream.error.file={scratch}/derby.log")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
