"""File writers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tallyroom.operators.topk import unused_name
from tallyroom.staging import discard, scratch_path

# How to write: "errorifexists", as in Spark, unless the caller says otherwise.
REFUSE = "errorifexists"

# Spark's text formats keep milliseconds unless told otherwise.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Bytes of one file that a task copies into a joined one.
JOIN_BYTES = 64 << 20
# Spark's CSV writer trims strings unless told otherwise.
WHOLE_STRINGS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _text_writer(
    df: DataFrame, mode: str, compression: str | None, options: dict[str, Any]
) -> DataFrameWriter:
    writer = df.write.mode(mode).options(**MICROSECONDS)
    if compression is not None:
        writer = writer.option("compression", compression)
    return writer.options(**options)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = REFUSE,
    compact: bool = False,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    bloom_for: Sequence[str] = (),
    **options: Any,
) -> None:
    """Parquet. `compact` shuffles the rows into files of even, sensible size first: for the few
    rows that a filter leaves in each of very many tasks. `partition_by` lays the rows out in a
    folder per value, so that a filter on these columns reads only its folders; rebalancing by
    them first keeps a task from opening a file in every folder.

    `cluster_by` lays the rows out by ranges of these columns, sorted inside each file, so that the
    least and greatest values kept in the footers let a later filter on the first of them skip most
    files and row groups. A value that a third of the rows share spreads over several files. The input is
    read twice, once to find the ranges: settle what is costly. `bloom_for` adds bloom filters on
    columns of many values in no such order; an equality then skips the row groups that lack the value.
    """
    if cluster_by:
        rows = by_ranges(df, [*partition_by, *cluster_by])
    else:
        rows = df.hint("rebalance", *partition_by) if compact or partition_by else df
    blooms = {f"parquet.bloom.filter.enabled#{column}": "true" for column in bloom_for}
    rows.write.mode(mode).options(**{**blooms, **options}).partitionBy(*partition_by).parquet(path)


def by_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows dealt out by ranges of the columns and sorted inside each. A row number as the last
    key parts rows of the same key. Nulls come first."""
    number = unused_name(df, "row_number_in")
    numbered = df.withColumn(number, F.monotonically_increasing_id())
    return numbered.repartitionByRange(*columns, number).sortWithinPartitions(*columns, number).drop(number)


def write_json(
    df: DataFrame,
    path: str,
    mode: str = REFUSE,
    compression: str | None = None,
    **options: Any,
) -> None:
    """JSON lines. Nulls are written out, so a column of nulls alone is still there when the types
    are inferred; `ignoreNullFields=True` leaves them out."""
    _text_writer(df, mode, compression, {"ignoreNullFields": False, **options}).json(path)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = REFUSE,
    header: bool = True,
    compression: str | None = None,
    **options: Any,
) -> None:
    """CSV. Compressed text cannot be split by its readers, so leave it in many files.

    Blanks around a string are kept, where Spark's writer would trim them. A line break inside a
    string is written within quotes: read such files with `multiLine=True`, which takes one task
    per file, or the row is split.

    Empty strings are read back as nulls unless both sides name the same `nullValue`. So do for a
    frame of one column too: a null alone is an empty line, which readers skip.
    """
    _text_writer(df, mode, compression, {**WHOLE_STRINGS, **options}).csv(path, header=header)


def write_single_csv(
    df: DataFrame,
    path: str,
    mode: str = REFUSE,
    header: bool = True,
    **options: Any,
) -> None:
    """CSV in one file, at any number of rows. One file means that one task reads and writes them
    all: it is for frames that are small by nature, such as an aggregate settled before."""
    write_csv(df.coalesce(1), path, mode, header, **options)


def write_joined_csv(df: DataFrame, path: str, mode: str = REFUSE, header: bool = True) -> None:
    """CSV in one file, for frames of any size: many tasks write parts, and tasks copy these, JOIN_BYTES
    each, to their places in the file, in the order of the frame. A repeated copy writes the same bytes
    again, and the output gets its name when it is whole.

    Writing at places takes a file system that allows it, so only `file:` folders, which all executors
    must share, are written like this. Elsewhere (HDFS, object stores) one task writes all, as
    `write_single_csv` does.
    """
    spark = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = place(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getScheme() != "file":
        return write_single_csv(df, path, mode, header)
    if files.exists(target) and mode not in ("overwrite", "append"):
        if mode == "ignore":
            return
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {path} already exists.")
    parts, joining = scratch_path(spark, "csv-parts"), target.suffix(f"-joining-{uuid.uuid4().hex}")
    name = f"part-00000-{uuid.uuid4()}-c000.csv"
    try:
        write_csv(df.limit(0).coalesce(1), f"{parts}/0-header", header=header)
        write_csv(df, f"{parts}/1-rows", header=False)
        files.mkdirs(joining)
        _join(spark, [f"{parts}/0-header", f"{parts}/1-rows"], files.makeQualified(joining).toUri().getPath() + f"/{name}")
        files.create(place(joining, "_SUCCESS")).close()
        if mode == "overwrite":
            files.delete(target, True)
        moves = [(joining, target)]
        if files.exists(target):
            moves = [(place(joining, name), place(target, name))]
        for source, to in moves:
            if not files.rename(source, to):
                raise OSError(f"{source} could not be named {to}")
    finally:
        discard(spark, joining.toString())
        discard(spark, parts)


def _join(spark: SparkSession, folders: Sequence[str], target: str) -> None:
    """Copy the part files of some local folders, one after the other, into one file. Only their names and
    sizes reach the driver."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    pieces, size = [], 0
    for folder in folders:
        files = place(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [(f.getPath().toUri().getPath(), f.getLen()) for f in files.globStatus(place(f"{folder}/part-*"))]
        for source, length in sorted(found, key=lambda f: (int(os.path.basename(f[0]).split("-")[1]), f[0])):
            pieces += [(source, b, min(JOIN_BYTES, length - b), size + b) for b in range(0, length, JOIN_BYTES)]
            size += length

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                with open(piece["source"], "rb") as source, open(os.open(target, os.O_WRONLY | os.O_CREAT, 0o644), "wb") as out:
                    source.seek(piece["begin"])
                    out.seek(piece["place"])
                    left = piece["length"]
                    while left and (some := source.read(min(left, 1 << 20))):
                        out.write(some)
                        left -= len(some)
                    out.flush()
                    os.fsync(out.fileno())
                yield pa.RecordBatch.from_pydict({"copied": [piece["length"] - left]})

    schema = "source string, begin long, length long, place long"
    dealt = spark.createDataFrame(pieces or [(os.devnull, 0, 0, 0)], schema).repartition(max(1, len(pieces)))
    copied = dealt.mapInArrow(copy, "copied long").agg(F.sum("copied")).first()[0]
    if copied != size:
        raise OSError(f"{copied} of {size} bytes copied to {target}")
