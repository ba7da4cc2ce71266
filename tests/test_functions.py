"""Column expressions on small frames: malformed text, bounds, nulls, leap days."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallyroom.functions import (
    CLOCK_12H,
    COMPACT_DAY,
    MONTH_DAY_TIME,
    SLASHED_DAY,
    Band,
    Field,
    bands_sql,
    close_bands,
    cut_field,
    in_year,
    label_bands,
    leap_safe_date,
    parse_date,
    parse_local_timestamp,
    parse_timestamp,
    sql_text,
    tenure_status,
)
from tallyroom.plans.flights import DELAY_BANDS, EARLY


def values(df):
    return [row[0] for row in df.collect()]


@pytest.fixture(params=["true", "false"])
def either_ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


def texts(spark, *items):
    return spark.createDataFrame([(item,) for item in items], "t string").coalesce(1)


def test_timestamps_parse_or_turn_null(spark, either_ansi):
    df = texts(spark, "12/31/2018", "13/45/2018", "", None, "2018-12-31")
    moment = datetime.datetime(2018, 12, 31)
    parsed = df.select(parse_timestamp(F.col("t"), SLASHED_DAY).cast("timestamp_ntz"))
    assert values(parsed) == [moment, None, None, None, None]


def test_local_timestamps_keep_hours_that_a_zone_skips(spark, either_ansi):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = texts(spark, "10/15/1995", "13/45/1995", None)
        local = df.select(parse_local_timestamp(F.col("t"), SLASHED_DAY))
        assert values(local) == [datetime.datetime(1995, 10, 15), None, None]
        zoned = df.select(parse_timestamp(F.col("t"), SLASHED_DAY).cast("timestamp_ntz"))
        assert values(zoned)[0] == datetime.datetime(1995, 10, 15, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_twelve_hour_clock(spark, either_ansi):
    df = texts(spark, "01/02/2018 12:05:06 AM", "01/02/2018 12:05:06 PM", "01/02/2018 13:00:00 PM")
    parsed = df.select(parse_timestamp(F.col("t"), CLOCK_12H).cast("timestamp_ntz"))
    assert values(parsed) == [
        datetime.datetime(2018, 1, 2, 0, 5, 6),
        datetime.datetime(2018, 1, 2, 12, 5, 6),
        None,
    ]


def test_dates(spark, either_ansi):
    df = texts(spark, "19501231", "19991345", "        ", "1950-12-31")
    assert values(df.select(parse_date(F.col("t"), COMPACT_DAY))) == [
        datetime.date(1950, 12, 31), None, None, None
    ]


def test_yearless_dates(spark, either_ansi):
    df = texts(spark, "03010005", "02290600", "02300600", "date")
    parsed = df.select(parse_date(F.col("t"), MONTH_DAY_TIME))
    assert values(parsed) == [datetime.date(1970, 3, 1), None, None, None]
    assert values(df.select(leap_safe_date(F.col("t")))) == [
        datetime.date(2000, 3, 1), datetime.date(2000, 2, 29), None, None
    ]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_in_year_is_year_equality(spark, kind):
    df = spark.createDataFrame(
        [(t,) for t in ("2017-12-31 23:59:59", "2018-01-01 00:00:00", "2018-12-31 23:59:59",
                        "2019-01-01 00:00:00", None)], "t string"
    ).select(F.col("t").cast(kind).alias("t"))
    for year in (2018, "2018"):
        by_range = values(df.where(in_year(F.col("t"), year)).select(F.col("t").cast("string")))
        by_year = values(df.where(F.year("t") == 2018).select(F.col("t").cast("string")))
        assert sorted(by_range) == sorted(by_year) and len(by_year) == 2


DELAYS = [-1, 0, 1, 59, 60, 61, 119, 120, 121, 359, 360, 361, None]


def delay_frame(spark):
    return spark.createDataFrame([(d,) for d in DELAYS], "delay int").coalesce(1)


def test_strict_bands_leave_gaps(spark):
    labels = values(delay_frame(spark).select(label_bands(F.col("delay"), DELAY_BANDS, EARLY)))
    assert labels == [
        "Early", "No Delays", "Tolerable Delays", "Tolerable Delays", "Early", "Short Delays",
        "Short Delays", "Early", "Long Delays", "Long Delays", "Early", "Very Long Delays", "Early",
    ]


def test_closed_bands_leave_none(spark):
    closed = close_bands(DELAY_BANDS)
    labels = values(
        delay_frame(spark).select(label_bands(F.col("delay"), closed, EARLY, missing="Unknown"))
    )
    assert labels == [
        "Early", "No Delays", "Tolerable Delays", "Tolerable Delays", "Tolerable Delays",
        "Short Delays", "Short Delays", "Short Delays", "Long Delays", "Long Delays",
        "Long Delays", "Very Long Delays", "Unknown",
    ]


@pytest.mark.parametrize("bands", [DELAY_BANDS, close_bands(DELAY_BANDS)])
@pytest.mark.parametrize("missing", [None, "Unknown"])
def test_bands_as_sql_give_the_same_labels(spark, bands, missing):
    df = delay_frame(spark)
    by_sql = F.expr(bands_sql("delay", bands, EARLY, missing))
    assert values(df.select(by_sql)) == values(
        df.select(label_bands(F.col("delay"), bands, EARLY, missing))
    )


def test_sql_text_survives_quotes_and_backslashes(spark):
    for text in ["it's", 'a "b"', "back\\slash", "\\'", "plain"]:
        assert values(spark.sql(f"SELECT {sql_text(text)}")) == [text]


def test_tenure_status(spark):
    ends = ["9999-01-01", "2001-05-05", "2030-01-01", None]
    df = spark.createDataFrame([(e,) for e in ends], "e string").coalesce(1)
    df = df.select(F.col("e").cast("date").alias("e"))
    status = df.select(tenure_status(F.col("e"), as_of="2024-01-01"))
    assert values(status) == ["current", "left", "NA", "NA"]
    on_the_day = tenure_status(F.col("e"), as_of=datetime.date(2001, 5, 5))
    assert values(df.select(on_the_day)) == ["current", "NA", "NA", "NA"]
    assert values(df.select(tenure_status(F.col("e"))))[:2] == ["current", "left"]


NUMBERS = ["+0265", "-0050", " 12  ", "     ", "", "A", "1A", "99999", None, "é1234", ":1", "+", "1.5"]


@pytest.mark.parametrize("kind", ["int", "float"])
def test_cut_field_is_a_cast_of_the_substring(spark, kind, either_ansi):
    """The byte range and the guards change nothing but the speed."""
    df = texts(spark, *NUMBERS).select(F.concat(F.lit("ab"), "t", F.lit("zz")).alias("line"), "t")
    df = df.union(texts(spark, "ab", "a", "").select(F.col("t").alias("line"), F.lit(None)))
    for length in (1, 4, 5):
        got = df.select(cut_field(F.col("line"), Field("x", 3, length, kind)))
        wanted = df.select(F.col("line").substr(3, length).try_cast(kind))
        assert values(got) == values(wanted)


@pytest.mark.parametrize("kind", ["int", "float"])
def test_cut_field_on_random_text(spark, kind):
    draw = random.Random(7)
    signs = "0123456789" * 3 + "+-. \t\x00\x7f:AeEfdNnaIity/é日\u00a0"
    lines = ["".join(draw.choices(signs, k=draw.randint(0, 9))) for _ in range(20_000)]
    df = texts(spark, *lines)
    for start, length in ((1, 1), (2, 3), (4, 6)):
        field = Field("got", start, length, kind)
        wanted = F.col("t").substr(start, length).try_cast(kind).alias("wanted")
        both = df.select("t", cut_field(F.col("t"), field), wanted)
        assert both.where(~F.col("got").eqNullSafe(F.col("wanted"))).limit(5).collect() == []
        assert both.where("wanted IS NOT NULL").count() > 500


def test_cut_field_counts_characters(spark):
    df = texts(spark, "éaéb123", "eaeb123", "日本語x9", None)
    assert values(df.select(cut_field(F.col("t"), Field("x", 3, 2)))) == ["éb", "eb", "語x", None]


def test_band_without_bounds_is_refused():
    with pytest.raises(ValueError):
        Band("all")
