"""Relational reads and the plain writers."""

import os
import re
import uuid
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators.selection import require_positive, require_text
from docweave.schemas import METHOD_RECORD
from docweave.session import spread_if_few
from docweave.sources import folders


def query(spark: SparkSession, sql: str, **parameters) -> DataFrame:
    """Any SELECT over registered tables; values come in as named parameters."""
    require_text(sql, "query")
    return spark.sql(sql, args=parameters)


def jdbc_query(spark: SparkSession, url: str, sql: str, split=None, **options) -> DataFrame:
    """A SELECT run by a database. `split` = (column, low, high, partitions) reads it
    in parallel ranges; without it one task reads everything."""
    require_text(url, "url")
    require_text(sql, "query")
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split is None:
        return reader.option("query", sql).load()
    column, low, high, partitions = split
    return (reader.option("dbtable", f"({sql}) AS source").option("partitionColumn", column)
            .option("lowerBound", low).option("upperBound", high)
            .option("numPartitions", require_positive(partitions, "partitions")).load())


def method_records(methods: DataFrame) -> DataFrame:
    """Method rows shaped as `{metadata: {...}, content}`."""
    names = METHOD_RECORD["metadata"].dataType.names
    return methods.select(
        F.struct(*[F.col(n).cast("string").alias(n) for n in names]).alias("metadata"), "content")


def write_table(df: DataFrame, path: str, overwrite=False, partition_by=()) -> None:
    """Write a new table; an existing one is an error unless `overwrite`.

    Empty data is refused. With partition columns the rows are first shared out by
    them, so that each value has few files; a value with most rows is split.
    """
    require_text(path, "path")
    if df.isEmpty():
        raise ValueError("no data to write")
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(*partition_by).parquet(path)


def append_records(df: DataFrame, path: str, partition_by=()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_run_log(entries: DataFrame, path: str) -> None:
    """Append log entries (chat_id, ts, seq, message), partitioned by day; read them
    with `reports.run_log_latest`."""
    append_records(entries.withColumn("day", F.to_date("ts")), path, ["day"])


def export_texts(methods: DataFrame, path: str, max_methods=None) -> None:
    """One text folder per method, for debugging; refused for more than `max_methods`,
    if that is given."""
    require_text(path, "path")
    if max_methods is not None and methods.select("method_id").distinct().limit(max_methods + 1).count() > max_methods:
        raise ValueError(f"text export is for at most {max_methods} methods")
    rows = methods.select("method_id", F.col("content").alias("value"))
    place = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration())
    if system.getScheme() != "file":
        rows.write.partitionBy("method_id").text(path)
        return
    # Into a shared folder the tasks write the same files themselves: Spark's writer starts
    # a process or two for each file there, and moves all of them at the end.
    rows.limit(0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("method_id").text(path)
    named = rows.select(F.col("method_id").cast("string").alias("method_id"), F.col("value").cast("binary").alias("value"))
    shared = spread_if_few(named, "method_id").sortWithinPartitions("method_id")
    shared.mapInArrow(_text_files(place.toUri().getPath()), "files long").agg(F.sum("files")).collect()
    system.create(rows.sparkSession._jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS")).close()


def exported_texts(spark: SparkSession, path: str) -> DataFrame:
    """method_id and value: the lines of the texts that `export_texts` wrote. A shared folder
    of many methods is read by the tasks; Spark's reader would hold its partitions on the
    driver."""
    large = folders.large_folder(spark, require_text(path, "path"))
    if large is None:
        return spark.read.schema("value string, method_id string").option("lineSep", "\n").text(path).select("method_id", "value")
    name = F.regexp_extract("path", "/method_id=([^/]*)/[^/]*$", 1)
    method = F.when(name != _NO_ID, F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))
    return folders.lines(folders.listed(spark, large)).select(method.alias("method_id"), "value")


# Fixed value: what stands for a missing id in the name of a folder.
_NO_ID = "__HIVE_DEFAULT_PARTITION__"


def _folder(value):
    """Name of the folder of a partition value, as Spark writes and reads it."""
    if not value:
        return f"method_id={_NO_ID}"
    return "method_id=" + re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda c: f"%{ord(c[0]):02X}", value)


def _text_files(root):
    """method_id, value (sorted by method_id) -> a file for each method of the task, put in
    its place when it is whole; a task that is run again puts the same files there."""
    def run(batches):
        name = f"part-{TaskContext.get().partitionId():05d}.txt"
        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        count = 0
        # No id and an empty one share a folder, and follow each other.
        for named, own in groupby(rows, lambda row: _folder(row[0])):
            folder = os.path.join(root, named)
            os.makedirs(folder, exist_ok=True)
            whole = os.path.join(folder, name)
            part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
            with open(part, "wb") as out:
                for _, value in own:
                    out.write((value or b"") + b"\n")
            os.replace(part, whole)
            count += 1
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["files"])
    return run
