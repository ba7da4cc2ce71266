"""JDBC against embedded in-memory Derby, which opens no port: reads, writes, publishing."""

import datetime
import subprocess
import sys
import uuid
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks.people import remote_of
from tallyroom import sinks, sources
from tallyroom.operators import frame_report, top_n
from tallyroom.plans import hr
from tallyroom.sinks import remote as staged
from tests.conftest import ROOT


@pytest.fixture
def remote():
    return sources.Remote(f"jdbc:derby:memory:test{uuid.uuid4().hex};create=true")


TITLES = [
    (1, "Senior Engineer", "9999-01-01"), (2, "Senior Engineer", "2001-01-01"),
    (3, "Senior Engineer", "2030-06-01"), (4, "Staff", "2001-01-01"),
    (5, "Senior Engineer", "2002-02-02"),
]
TITLE_TYPES = "title VARCHAR(40)"


def titles(spark):
    df = spark.createDataFrame(TITLES, "emp_no int, title string, to_date string")
    return df.withColumn("to_date", F.col("to_date").cast("date"))


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_table_query_and_schema(spark, remote):
    sinks.write_jdbc(titles(spark), remote, "titles", column_types=TITLE_TYPES, expect_rows=5)
    assert rows(sources.read_jdbc(spark, remote, "titles")) == rows(titles(spark))
    assert len(rows(hr.titles_of(spark, remote))) == 4
    report = frame_report(sources.read_jdbc(spark, remote, "titles")).collect()
    assert [(r.name, r.type, r.rows) for r in report] == [
        ("emp_no", "int", 5), ("title", "string", 5), ("to_date", "date", 5)
    ]


def test_quotes_in_a_title(spark, remote):
    df = titles(spark).withColumn("title", F.lit("Chief's Aide"))
    sinks.write_jdbc(df, remote, "titles", column_types=TITLE_TYPES)
    assert hr.titles_of(spark, remote, "Chief's Aide").count() == 5


def test_table_or_query_and_split_or_predicates(spark, remote):
    with pytest.raises(ValueError):
        sources.read_jdbc(spark, remote)
    with pytest.raises(ValueError):
        sources.read_jdbc(spark, remote, "a", query="b")
    with pytest.raises(ValueError):
        sources.read_jdbc(spark, remote, "a", split=sources.Split("x", "0", "1", 2), predicates=["x"])


def clustered(spark):
    """Keys with a far outlier, a run of duplicates that is a third of all rows, and nulls."""
    return (
        spark.range(100).select("id")
        .union(spark.range(60).select(F.lit(50).cast("long")))
        .union(spark.range(1).select(F.lit(1_000_000).cast("long")))
        .union(spark.range(3).select(F.lit(None).cast("long")))
    )


@pytest.mark.parametrize("parts", [1, 2, 5, 300])
def test_parallel_reads_are_whole(spark, remote, parts):
    sinks.write_jdbc(clustered(spark), remote, "keys_of", expect_rows=164)
    wanted = sorted(map(repr, clustered(spark).collect()))
    split = sources.split_over(spark, remote, "keys_of", "id", parts)
    assert (split.lower, split.upper) == ("0", "1000000")
    by_range = sources.read_jdbc(spark, remote, "keys_of", split=split)
    assert sorted(map(repr, by_range.collect())) == wanted
    ranges = sources.even_predicates(spark, remote, "keys_of", "id", parts)
    assert len(ranges) <= parts
    by_share = sources.read_jdbc(spark, remote, "keys_of", predicates=ranges)
    assert sorted(map(repr, by_share.collect())) == wanted
    of_query = sources.read_jdbc(
        spark, remote, query='SELECT "id" FROM keys_of WHERE "id" < 20',
        split=sources.Split("id", "0", "20", parts),
    )
    assert of_query.count() == 20


def test_even_predicates_balance_clustered_keys(spark, remote):
    keys = spark.range(1000).select(
        F.when(F.col("id") < 500, F.col("id")).otherwise(F.col("id") + 9_500).alias("id")
    )
    sinks.write_jdbc(keys, remote, "keys_of")

    def sizes(df):
        counts = df.groupBy(F.spark_partition_id()).count().collect()
        return sorted(row[1] for row in counts)

    split = sources.split_over(spark, remote, "keys_of", "id", 4)
    assert max(sizes(sources.read_jdbc(spark, remote, "keys_of", split=split))) == 500
    ranges = sources.even_predicates(spark, remote, "keys_of", "id", 4, cells_per_part=64)
    shares = sizes(sources.read_jdbc(spark, remote, "keys_of", predicates=ranges))
    assert len(shares) == 4 and max(shares) < 300


def test_empty_table_has_no_split(spark, remote):
    sinks.write_jdbc(clustered(spark).where("id < 0"), remote, "keys_of")
    assert sources.split_over(spark, remote, "keys_of", "id", 4) is None
    assert sources.even_predicates(spark, remote, "keys_of", "id", 4) == ["1 = 1"]
    assert sources.read_jdbc(spark, remote, "keys_of").count() == 0


def test_save_modes(spark, remote):
    df = titles(spark)
    sinks.write_jdbc(df, remote, "titles", column_types=TITLE_TYPES)
    sinks.write_jdbc(df.limit(2), remote, "titles", "overwrite", truncate=True, expect_rows=2)
    sinks.write_jdbc(df.limit(2), remote, "titles", mode="append", expect_rows=4)
    with pytest.raises(AnalysisException):
        sinks.write_jdbc(df, remote, "titles")
    assert sources.read_jdbc(spark, remote, "titles").count() == 4


def test_wrong_number_of_rows_is_noticed(spark, remote):
    with pytest.raises(RuntimeError, match="5 rows, not 6"):
        sinks.write_jdbc(titles(spark), remote, "titles", expect_rows=6)


def test_catalog_limit_is_kept(spark, remote):
    sinks.write_jdbc(clustered(spark), remote, "keys_of")
    sources.attach_catalog(spark, "people_db", remote)
    best = top_n(spark.table("people_db.APP.KEYS_OF"), 3, [F.desc("id")])
    assert [row.id for row in best.collect()] == [1_000_000, 99, 98]
    assert spark.table("people_db.APP.KEYS_OF").where("id = 50").count() == 61


def test_top_salaries_with_ties(spark, remote, tmp_path):
    df = spark.createDataFrame(
        [(1, 100), (2, 300), (3, 200), (4, 200), (5, 200)], "emp_no int, salary int"
    )
    wanted = [(2, 300), (3, 200), (4, 200)]
    assert [tuple(r) for r in hr.top_salaries(df, 3).collect()] == wanted
    path = str(tmp_path / "top.csv.snappy")
    best = hr.publish_top_salaries(df, remote, path, n=3)
    assert rows(best) == rows(sources.read_jdbc(spark, remote, "aces")) == wanted
    back = sources.read_csv(spark, path, "emp_no INT, salary INT", header=False)
    assert rows(back) == wanted


def test_status_and_counts(spark):
    labelled = hr.with_status(titles(spark), as_of="2024-01-01")
    assert dict(rows(hr.status_counts(labelled))) == {"current": 1, "left": 3, "NA": 1}


@pytest.mark.parametrize("remote_names", [None, hr.HYPHENATED_NAMES])
def test_leavers_are_published_three_times(spark, remote, tmp_path, remote_names):
    sinks.write_jdbc(titles(spark), remote, "titles", column_types=TITLE_TYPES)
    holders = hr.with_status(hr.titles_of(spark, remote), as_of="2024-01-01")
    paths = {"table": str(tmp_path / "t"), "frame": str(tmp_path / "f")}
    types = "title VARCHAR(40), status VARCHAR(10)"
    published = hr.publish_leavers(
        hr.leavers(holders), remote, remote_names=remote_names, column_types=types, paths=paths
    )
    wanted = [
        (2, "Senior Engineer", datetime.date(2001, 1, 1), "left"),
        (5, "Senior Engineer", datetime.date(2002, 2, 2), "left"),
    ]
    for kind, name in (remote_names or hr.LEAVER_NAMES).items():
        target = hr.remote_table(remote, name)
        assert rows(published[kind]) == wanted
        assert rows(sources.read_jdbc(spark, remote, target)) == wanted
        with pytest.raises(AnalysisException):
            sinks.write_jdbc(published["table"], remote, target, mode="errorifexists")
    for kind in ("table", "frame"):
        spark.sql(f"DROP TABLE {hr.LEAVER_NAMES[kind]}")


def test_credentials_stay_out_of_repr():
    shown = repr(sources.Remote("jdbc:mysql://host/db", "driver", "worker", "secret"))
    assert "secret" not in shown and "worker" not in shown
    assert sources.Remote("jdbc:mysql://host/db").quote("a`b") == "`a``b`"


def test_driver_options():
    mysql = sources.Remote("jdbc:mysql://h/db", user="u", extra={"useCursorFetch": "false"})
    assert mysql.options() == {
        "useCursorFetch": "false", "rewriteBatchedStatements": "true",
        "url": "jdbc:mysql://h/db", "user": "u",
    }
    assert sources.Remote("jdbc:derby:memory:x").options() == {"url": "jdbc:derby:memory:x"}


def names_of(spark, remote):
    with staged.connection(spark, remote) as link:
        found, names = link.getMetaData().getTables(None, "APP", None, None), []
        while found.next():
            names.append(found.getString("TABLE_NAME"))
        return sorted(names)


def test_published_rows_and_modes(spark, remote):
    df = titles(spark).repartition(3)
    assert sinks.publish_jdbc(df, remote, "titles", column_types=TITLE_TYPES) == 5
    with pytest.raises(AnalysisException, match="exists"):
        sinks.publish_jdbc(df, remote, "titles")
    assert sinks.publish_jdbc(df.limit(2), remote, "titles", "append", column_types=TITLE_TYPES) == 2
    assert sources.read_jdbc(spark, remote, "titles").count() == 7
    assert sinks.publish_jdbc(df, remote, "titles", "overwrite", column_types=TITLE_TYPES) == 5
    assert rows(sources.read_jdbc(spark, remote, "titles")) == rows(titles(spark))
    assert sinks.publish_jdbc(df.limit(0), remote, "none_yet") == 0
    assert sinks.publish_jdbc(df, remote, '"left-titles"') == 5  # texts without a type of their own are CLOBs
    assert names_of(spark, remote) == ["NONE_YET", "TITLES", "left-titles"]


def test_publishing_that_fails_leaves_the_table_as_it_was(spark, remote):
    sinks.publish_jdbc(titles(spark), remote, "titles", column_types=TITLE_TYPES)
    with staged.transaction(spark, remote) as run:
        run("ALTER TABLE titles ADD CONSTRAINT short CHECK (LENGTH(\"title\") < 20)")
    long = titles(spark).withColumn("title", F.lit("x" * 30))
    with pytest.raises(Exception, match="SHORT"):
        sinks.publish_jdbc(long, remote, "titles", "overwrite", column_types=TITLE_TYPES)
    assert rows(sources.read_jdbc(spark, remote, "titles")) == rows(titles(spark))
    assert names_of(spark, remote) == ["TITLES"]
    for frame, mode in ((long.drop("title"), "append"), (long.withColumnRenamed("title", "stage_part"), "append"), (long, "ignore")):
        with pytest.raises(ValueError):
            sinks.publish_jdbc(frame, remote, "titles", mode)


def test_attempts_that_all_committed_count_once(spark, remote):
    """What a task leaves behind that is lost after its commit: its rows again, under another attempt."""
    df = spark.range(0, 90, 1, 3)
    sinks.write_jdbc(staged.with_attempt(df), remote, "staging")
    sinks.write_jdbc(df.limit(0), remote, "target", "append")
    part, attempt = '"stage_part"', '"stage_attempt"'
    with staged.transaction(spark, remote) as run:
        assert run(f'INSERT INTO staging SELECT "id", {part}, {attempt} + 1000 FROM staging WHERE {part} <> 0') == 60
        assert run(f'INSERT INTO staging SELECT "id", {part}, -1 FROM staging WHERE {part} = 0 AND "id" < 10') == 10
        assert run(staged.copy_statement(remote, "target", "staging", ["id"])) == 90
    assert rows(sources.read_jdbc(spark, remote, "target")) == [(n,) for n in range(90)]


FAILING = """
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from tallyroom import sinks, sources

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
remote = sources.Remote("jdbc:derby:memory:failing;create=true", extra={"isolationLevel": "NONE"})


def fail_once(batches):
    for batch in batches:
        for n in range(0, len(batch), 10):
            yield batch.slice(n, 10)
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("lost")


df = spark.range(0, 400, 1, 4).mapInArrow(fail_once, "id long")
sinks.write_jdbc(df, remote, "plain", batch_rows=10)
written = sinks.publish_jdbc(df, remote, "published", batch_rows=10)
found = sorted(r.id for r in sources.read_jdbc(spark, remote, "published").collect())
print("RESULT", sources.read_jdbc(spark, remote, "plain").count() > 400, written, found == list(range(400)))
"""


def test_a_task_that_fails_after_its_rows_were_committed():
    """In a session of its own, whose tasks may run again. Without a transaction of its own the first attempt's
    rows stay: the plain write holds them twice, the published table once."""
    done = subprocess.run([sys.executable, "-c", FAILING], cwd=ROOT, capture_output=True, text=True, timeout=200)
    assert "RESULT True 400 True" in done.stdout, done.stdout + done.stderr[-2000:]


def test_quantiles_of_clustered_keys_dates_and_texts(spark, remote):
    keys = spark.range(2000).select(
        F.when(F.col("id") < 1900, F.col("id")).otherwise(F.col("id") * 1_000_000_007).alias("id"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.pow(F.col("id") % 1000 / 100, F.lit(3)).cast("int")).alias("day"),
        F.concat(F.lit("o'"), F.lpad(F.pow(F.col("id") % 997 / 100, F.lit(3)).cast("int"), 5, "0")).alias("name"),
    )
    sinks.write_jdbc(keys, remote, "keys_of", column_types="name VARCHAR(20)")
    wanted = rows(keys)
    for column, parts in (("id", 4), ("id", 7), ("day", 5), ("name", 6)):
        ranges = sources.quantile_predicates(spark, remote, "keys_of", column, parts)
        read = sources.read_jdbc(spark, remote, "keys_of", predicates=ranges)
        sizes = [r[1] for r in read.groupBy(F.spark_partition_id()).count().collect()]
        assert len(ranges) == parts and max(sizes) < 2 * 2000 / parts and rows(read) == wanted


@pytest.mark.parametrize("parts", [1, 3, 300])
def test_quantiles_with_nulls_repeats_and_no_rows(spark, remote, parts):
    sinks.write_jdbc(clustered(spark), remote, "keys_of")
    ranges = sources.quantile_predicates(spark, remote, "keys_of", "id", parts)
    read = sources.read_jdbc(spark, remote, "keys_of", predicates=ranges)
    assert len(ranges) <= parts and sorted(map(repr, read.collect())) == sorted(map(repr, clustered(spark).collect()))
    sinks.write_jdbc(clustered(spark).limit(0), remote, "empty_keys")
    assert sources.quantile_predicates(spark, remote, "empty_keys", "id", parts) == ["1 = 1"]


def session_of(settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))


@pytest.mark.parametrize("master", ["local-cluster[3,4,10240]", "spark://host:7077", "yarn", "k8s://https://host"])
def test_embedded_database_is_refused_where_executors_are_processes_of_their_own(master):
    with pytest.raises(ValueError, match="spark.tallyroom.jdbc.url"):
        remote_of(session_of({"spark.master": master}))
    url = "jdbc:mysql://host/db"
    assert remote_of(session_of({"spark.master": master, "spark.tallyroom.jdbc.url": url})).url == url


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]", "local[2,3]"])
def test_embedded_database_serves_a_local_session(master):
    assert remote_of(session_of({"spark.master": master})).url.startswith("jdbc:derby:memory:")
