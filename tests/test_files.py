"""Readers and writers: schemas, codecs, save modes, single files, staging."""

import datetime
import glob
import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyroom import operators as op
from tallyroom import sinks, sources
from tallyroom.staging import scratch_path, settle

PLACES = "id INT, name STRING, at TIMESTAMP_NTZ, day DATE, share DOUBLE, ok BOOLEAN"


@pytest.fixture(scope="module")
def places(spark):
    moment = datetime.datetime(2024, 2, 29, 1, 2, 3, 456789)
    return spark.createDataFrame(
        [
            (1, 'comma, "quote"', moment, moment.date(), 0.1, True),
            (2, "two", None, None, -2.5e-7, False),
            (3, None, moment, None, None, None),
        ],
        PLACES,
    )


def same_rows(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("codec", [None, "lz4", "snappy", "gzip"])
@pytest.mark.parametrize("header", [True, False])
def test_csv_round_trip(spark, places, tmp_path, codec, header):
    path = str(tmp_path / "csv")
    sinks.write_csv(places, path, header=header, compression=codec)
    assert same_rows(sources.read_csv(spark, path, PLACES, header=header), places)
    endings = {None: ".csv", "lz4": ".csv.lz4", "snappy": ".csv.snappy", "gzip": ".csv.gz"}
    assert glob.glob(f"{path}/*{endings[codec]}")


def test_csv_tells_empty_from_null_with_a_null_mark(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None)], "id int, t string")
    for options, wanted in (({}, [None, None]), ({"nullValue": "NULL"}, ["", None])):
        sinks.write_csv(df, str(tmp_path / "csv"), mode="overwrite", **options)
        back = sources.read_csv(spark, str(tmp_path / "csv"), "id INT, t STRING", **options)
        assert [r.t for r in back.orderBy("id").collect()] == wanted


def test_csv_of_one_column_keeps_nulls_with_a_null_mark(spark, tmp_path):
    df = spark.createDataFrame([("x",), (None,)], "t string")
    for options, count in (({}, 1), ({"nullValue": "NULL"}, 2)):
        sinks.write_csv(df, str(tmp_path / "csv"), mode="overwrite", **options)
        assert sources.read_csv(spark, str(tmp_path / "csv"), "t STRING", **options).count() == count


@pytest.mark.parametrize("codec", [None, "lz4"])
def test_json_round_trip(spark, places, tmp_path, codec):
    path = str(tmp_path / "json")
    sinks.write_json(places, path, compression=codec)
    assert same_rows(sources.read_json(spark, path, PLACES), places)
    assert glob.glob(f"{path}/*.json{'.lz4' if codec else ''}")


def test_json_inferred_and_conformed(spark, places, tmp_path):
    path = str(tmp_path / "json")
    sinks.write_json(places, path)
    assert same_rows(op.conform(sources.read_json(spark, path), places.schema, lossy=True), places)


@pytest.mark.parametrize("compact", [True, False])
def test_parquet_round_trip(spark, places, tmp_path, compact):
    path = str(tmp_path / "parquet")
    sinks.write_parquet(places, path, compact=compact)
    assert same_rows(sources.read_parquet(spark, path), places)
    assert same_rows(sources.read_parquet(spark, [path, path]), places.union(places))


def test_compact_writes_few_files(spark, tmp_path):
    spread = spark.range(1000).repartition(40)
    sinks.write_parquet(spread, str(tmp_path / "plain"))
    sinks.write_parquet(spread, str(tmp_path / "compact"), compact=True)
    count = {name: len(glob.glob(str(tmp_path / name / "part-*"))) for name in ("plain", "compact")}
    assert count == {"plain": 40, "compact": 1}


def test_overwrite_replaces_and_errorifexists_refuses(spark, places, tmp_path):
    for write in (sinks.write_csv, sinks.write_json, sinks.write_parquet, sinks.write_single_csv):
        path = str(tmp_path / write.__name__)
        write(places, path)
        write(places, path, mode="overwrite")
        with pytest.raises(AnalysisException):
            write(places, path)


def test_single_csv_keeps_order_and_is_one_file(spark, tmp_path):
    df = spark.range(100).repartition(7).orderBy("id")
    path = str(tmp_path / "single")
    sinks.write_single_csv(df, path)
    assert len(glob.glob(f"{path}/part-*")) == 1
    assert [r[0] for r in sources.read_csv(spark, path, "id INT").collect()] == list(range(100))


@pytest.mark.parametrize("rows", [0, 1, 100, 200_000])
def test_single_csv_is_one_file_at_any_number_of_rows(spark, tmp_path, rows):
    path = str(tmp_path / "single")
    sinks.write_single_csv(spark.range(rows).repartition(7), path)
    assert len(glob.glob(f"{path}/part-*")) == 1
    assert sources.read_csv(spark, path, "id INT").count() == rows


@pytest.mark.parametrize("rows", [0, 1, 50_000])
def test_joined_csv_is_one_file_from_many_tasks(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(sinks.files, "JOIN_BYTES", 10_000)
    path = str(tmp_path / "joined")
    df = spark.range(0, rows, 1, 7).withColumns({"task": F.spark_partition_id(), "text": F.lit(' a,"b" ')})
    sinks.write_joined_csv(df, path)
    files = glob.glob(f"{path}/part-*")
    read = sources.read_csv(spark, path, "id LONG, task INT, text STRING").collect()
    assert len(files) == 1 and sorted(os.listdir(tmp_path)) == ["joined"] and os.path.exists(f"{path}/_SUCCESS")
    assert sorted((r.id, r.text) for r in read) == [(i, ' a,"b" ') for i in range(rows)]
    assert len({r.task for r in read}) == min(rows, 7)
    lines = open(files[0]).read().splitlines()
    assert lines[0] == "id,task,text" and [int(x.split(",")[0]) for x in lines[1:]] == list(range(rows))


def test_joined_csv_keeps_to_its_mode(spark, tmp_path):
    path = str(tmp_path / "joined")
    sinks.write_joined_csv(spark.range(3), path, header=False)
    with pytest.raises(AnalysisException):
        sinks.write_joined_csv(spark.range(1), path)
    sinks.write_joined_csv(spark.range(9), path, mode="ignore")
    assert sources.read_csv(spark, path, "id INT", header=False).count() == 3
    sinks.write_joined_csv(spark.range(4), path, mode="append", header=False)
    assert sources.read_csv(spark, path, "id INT", header=False).count() == 7
    sinks.write_joined_csv(spark.range(2), path, mode="overwrite")
    assert sources.read_csv(spark, path, "id INT").count() == 2 and len(glob.glob(f"{path}/part-*")) == 1


def test_text_sinks_keep_strings_as_they_are(spark, tmp_path):
    df = spark.createDataFrame([(1, "  12 ", None), (2, " ", None), (3, "a\nb,\"c\"", None), (4, None, None)], "id int, t string, n double")
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert same_rows(sources.read_csv(spark, str(tmp_path / "csv"), df.schema, multiLine=True), df)
    sinks.write_json(df, str(tmp_path / "json"))
    inferred = sources.read_json(spark, str(tmp_path / "json"))
    assert set(inferred.columns) == {"id", "t", "n"}
    assert same_rows(op.conform(inferred, df.schema, lossy=True), df)


def test_parquet_in_folders_is_pruned(spark, tmp_path):
    path = str(tmp_path / "years")
    sinks.write_parquet(spark.range(100).selectExpr("id", "2000 + id % 4 AS year"), path, partition_by=["year"])
    chosen = sources.read_parquet(spark, path).where("year = 2001")
    assert chosen.count() == 25 and len(glob.glob(f"{path}/year=*")) == 4
    assert "PartitionFilters: [isnotnull(year" in chosen._jdf.queryExecution().toString()


def test_replace_table_can_read_what_it_replaces(spark, tmp_path):
    op.create_database(spark, "replace_db", str(tmp_path / "db"))
    for path in (None, str(tmp_path / "t")):
        name = f"replace_db.t{path is None}"
        sinks.replace_table(spark.range(3), name, path)
        again = sinks.replace_table(spark.table(name).selectExpr("id + 1 AS id"), name, path)
        assert sorted(r.id for r in again.collect()) == [1, 2, 3]
        with pytest.raises(Exception, match="no"):
            sinks.replace_table(spark.table(name).selectExpr("raise_error('no') AS id"), name, path)
        assert spark.table(name).count() == 3
        op.drop_table(spark, name)


def test_a_reader_in_a_loop_never_fails_while_a_table_is_replaced(spark, tmp_path):
    op.create_database(spark, "loop_db", str(tmp_path / "db"))
    for path in (None, str(tmp_path / "t")):
        name, seen, stop = f"loop_db.t{path is None}", [], threading.Event()
        sinks.replace_table(spark.range(100), name, path)

        def read(name=name, seen=seen, stop=stop):
            while not stop.is_set():
                seen.append(spark.newSession().table(name).count() if len(seen) % 2 else spark.table(name).count())

        with ThreadPoolExecutor(1) as pool:
            reader = pool.submit(read)
            for n in range(1, 7):
                sinks.replace_table(spark.range(100 + n), name, path)
            stop.set()
            reader.result(60)
        assert set(seen) <= set(range(100, 107)) and seen == sorted(seen) and len(seen) > 3
        assert sinks.forget_versions(spark, name) == (6 if path else 5)
        assert spark.table(name).count() == 106 and sinks.forget_versions(spark, name) == 0
        op.drop_table(spark, name)


def test_a_table_of_other_columns_or_layout_is_replaced(spark, tmp_path):
    op.create_database(spark, "other_db", str(tmp_path / "db"))
    spark.range(4).selectExpr("id", "id % 2 AS half").write.partitionBy("half").saveAsTable("other_db.t")
    assert sinks.replace_table(spark.range(3).selectExpr("id", "id AS half"), "other_db.t").count() == 3
    assert sinks.replace_table(spark.range(2), "other_db.t").columns == ["id"]
    assert sinks.forget_versions(spark, "other_db.t") == 0
    op.drop_table(spark, "other_db.t")


def test_external_table_notices_another_place_or_other_columns(spark, trips, tmp_path):
    op.create_database(spark, "external_db", str(tmp_path / "db"))
    name, other = "external_db.trips", tmp_path / "other.csv"
    other.write_text("a,b,c\n9,y,0\n")
    for _ in range(2):
        assert op.external_table(spark, name, "a INT, b STRING, c DOUBLE", trips).count() == 2
    for columns, path in (("a INT, b STRING, c DOUBLE", str(other)), ("a INT, b STRING", trips)):
        with pytest.raises(ValueError, match="is there with other"):
            op.external_table(spark, name, columns, path)
    assert op.external_table(spark, name, "a INT, b STRING, c DOUBLE", str(other), replace=True).first().a == 9
    assert [t.name for t in spark.catalog.listTables("external_db") if not t.isTemporary] == ["trips"]
    op.drop_table(spark, name)


@pytest.fixture
def trips(tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text("a,b,c\n1,x,2.5\n2,,\n")
    return str(path)


def test_csv_schemas(spark, trips):
    inferred = sources.read_csv(spark, trips)
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "string", "double"]
    named = sources.read_csv(spark, trips, "first INT, second STRING, third DOUBLE")
    assert named.columns == ["first", "second", "third"]
    assert inferred.count() == named.count() == 2
    assert sources.read_csv(spark, [trips, trips], named.schema).count() == 4
    strict = op.conform(inferred, inferred.schema)
    assert all(field.nullable for field in strict.schema)


def test_lines_are_whole_and_blank_ones_skipped(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text('one, "two", three\n\n   \nlast\n')
    lines = [r[0] for r in sources.read_lines(spark, str(path)).collect()]
    assert lines == ['one, "two", three', "last"]


def test_external_table_needs_its_header(spark, trips, tmp_path):
    columns = "a INT, b STRING, c DOUBLE"
    op.create_database(spark, "files_db", str(tmp_path / "db"))
    with_header = op.external_table(spark, "files_db.with_header", columns, trips)
    without = op.external_table(spark, "files_db.without", columns, trips, header=False)
    assert (with_header.count(), without.count()) == (2, 3)
    op.drop_table(spark, "files_db.with_header")
    assert os.path.exists(trips)
    op.drop_table(spark, "files_db.without")


def test_tables(spark, places, tmp_path):
    op.create_database(spark, "tables_db", str(tmp_path / "db"))
    kept = sinks.save_table(places, "tables_db.kept", path=str(tmp_path / "kept"))
    assert same_rows(kept, places)
    with pytest.raises(AnalysisException):
        sinks.save_table(places, "tables_db.kept", mode="errorifexists")
    sinks.save_table(places.limit(1), "tables_db.kept", "overwrite", str(tmp_path / "kept"))
    assert spark.table("tables_db.kept").count() == 1
    managed = sinks.save_table(places, "tables_db.managed")
    assert same_rows(managed, places)
    columns = {r["name"]: r["type"] for r in op.catalog_columns(spark, "tables_db.managed").collect()}
    assert columns["at"] == "timestamp_ntz" and len(columns) == 6
    for name in ("kept", "managed"):
        op.drop_table(spark, f"tables_db.{name}")


def test_writes_together_all_finish_before_an_error(spark, tmp_path):
    done = str(tmp_path / "done")
    sinks.write_parquet(spark.range(1), str(tmp_path / "taken"))
    with pytest.raises(AnalysisException):
        sinks.write_together(
            spark,
            lambda: sinks.write_parquet(spark.range(1), str(tmp_path / "taken"), mode="error"),
            lambda: sinks.write_parquet(spark.range(100_000), done),
        )
    assert sources.read_parquet(spark, done).count() == 100_000


def test_settle_reads_the_copy(spark, places):
    kept = settle(places)
    assert same_rows(kept, places) and kept.schema == places.schema
    assert "tallyroom/settled-" in kept.inputFiles()[0]


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert "/tallyroom/x-" in path and path != scratch_path(spark, "x")
    if base:
        assert path.startswith(base)


def test_object_store_conf(monkeypatch):
    monkeypatch.delenv("ACCESSKEY", raising=False)
    monkeypatch.delenv("SECRETKEY", raising=False)
    committed = sources.object_store_conf()
    assert committed["spark.hadoop.fs.s3a.committer.name"] == "magic"
    assert committed["spark.hadoop.fs.s3a.committer.magic.enabled"] == "true"
    assert "PathOutputCommitProtocol" in committed["spark.sql.sources.commitProtocolClass"]
    assert sources.object_store_conf(committer="directory")["spark.hadoop.fs.s3a.committer.magic.enabled"] == "false"
    with pytest.raises(ValueError, match="committer"):
        sources.object_store_conf(committer="fast")
    conf = sources.object_store_conf("http://store:9000", committer=None)
    assert conf == {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
    }
    monkeypatch.setenv("ACCESSKEY", "a")
    with pytest.raises(ValueError):
        sources.object_store_conf()
    monkeypatch.setenv("SECRETKEY", "b")
    conf = sources.object_store_conf(path_style=False)
    assert conf["spark.hadoop.fs.s3a.secret.key"] == "b"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "false"


def rows_scanned(df):
    """Rows that the scan of a plan without shuffles gave to the filter above it."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def row_groups(path):
    """(column -> (least, greatest)) of every row group, file by file."""
    out = []
    for file in sorted(glob.glob(f"{path}/*.parquet")):
        metadata = pq.read_metadata(file)
        for i in range(metadata.num_row_groups):
            group = metadata.row_group(i)
            columns = [group.column(j) for j in range(group.num_columns)]
            out.append({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns if c.statistics and c.statistics.has_min_max})
    return out


def test_clustered_parquet_lets_a_filter_skip_row_groups(spark, tmp_path):
    """A third of the rows share one origin; the rest are dealt over 50."""
    rows = spark.range(0, 60_000, 1, 12).selectExpr(
        "id", "IF(id % 3 = 0, 'ORD', concat('A', lpad(pmod(xxhash64(id), 50), 2, '0'))) AS origin", "xxhash64(id, 1) AS trip", "id AS row_number_in"
    )
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    small = {"parquet.block.size": 64 * 1024, "parquet.page.size": 8 * 1024}
    sinks.write_parquet(rows, plain, **small)
    joined = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(joined, "false")  # these few rows would be joined into one file
    try:
        sinks.write_parquet(rows, laid, cluster_by=["origin", "id"], bloom_for=["trip"], **small)
    finally:
        spark.conf.unset(joined)
    assert same_rows(sources.read_parquet(spark, laid), rows)

    def holding(path, value):
        groups = row_groups(path)
        return sum(g["origin"][0] <= value <= g["origin"][1] for g in groups), len(groups)

    held, of = holding(plain, "A07")
    assert held == of
    held, of = holding(laid, "A07")
    assert held <= 2 < of
    files = {f for f in glob.glob(f"{laid}/*.parquet") if "ORD" in pq.read_table(f, columns=["origin"])["origin"].to_pylist()}
    assert len(files) >= 2  # the frequent value is not left to one task

    def one_origin(path):
        return sources.read_parquet(spark, path).where("origin = 'A07'")

    assert same_rows(one_origin(laid), one_origin(plain))
    assert rows_scanned(one_origin(laid)) < 0.25 * rows_scanned(one_origin(plain))
    trip = rows.where("id = 31415").first().trip
    by_trip = sources.read_parquet(spark, laid).where(f"trip = {trip}")
    assert [r.id for r in by_trip.collect()] == [31415]
    assert rows_scanned(by_trip) < 0.5 * 60_000
    assert rows_scanned(sources.read_parquet(spark, plain).where(f"trip = {trip}")) > rows_scanned(by_trip)


def test_clustered_parquet_of_nothing_and_of_nulls(spark, tmp_path):
    for n, rows in enumerate([[], [(None, 1), (None, 2), ("a", 3)]]):
        frame = spark.createDataFrame(rows, "origin string, id int")
        path = str(tmp_path / str(n))
        sinks.write_parquet(frame, path, cluster_by=["origin"], bloom_for=["origin"])
        assert same_rows(sources.read_parquet(spark, path), frame)
    folders = str(tmp_path / "folders")
    sinks.write_parquet(spark.range(100).selectExpr("id", "id % 4 AS year"), folders, partition_by=["year"], cluster_by=["id"])
    assert sources.read_parquet(spark, folders).where("year = 2").count() == 25
