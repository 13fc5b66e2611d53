"""Session defaults and staging of intermediate tables."""

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name="docweave", master=None, **conf):
    """A session with the settings the operators are written for.

    Partition counts are left to adaptive execution: it starts from
    `initialPartitionNum` and merges small partitions, splits skewed ones and
    switches to a broadcast join once the real size of a side is known.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Whole files travel as single rows: bound Arrow batches by size too.
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(rows: DataFrame, *by) -> DataFrame:
    """Rows in even shares for a costly step, by columns that are unique together.

    Adaptive execution sets the number of shares from the data size and splits
    those that come out too large, so neither one large file nor one hot value
    decides how long the step takes.
    """
    return rows.hint("rebalance", *[F.col(name) for name in by])


def spread_if_few(scan: DataFrame, *by) -> DataFrame:
    """`spread` a scan that has fewer tasks than there are cores, such as one file
    with a single row group; a scan with enough tasks is left where it is.

    Only for plans without shuffles: for those the number of tasks is known
    without running anything.
    """
    if scan.rdd.getNumPartitions() >= scan.sparkSession.sparkContext.defaultParallelism:
        return scan
    return spread(scan, *by)


_LOCAL_ROOTS = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="docweave-stage-")
    return _LOCAL_ROOTS[context.applicationId]


_open_scopes = threading.local()


@contextmanager
def staging_scope(spark: SparkSession):
    """Removes, at the end, the tables staged inside by the same thread.

    For jobs that have written their results by then; a DataFrame that reads a
    staged table must not be used afterwards.
    """
    outer = getattr(_open_scopes, "paths", None)
    _open_scopes.paths = paths = []
    try:
        yield
    finally:
        _open_scopes.paths = outer
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once under the shared folder and read it back.

    Used where a result is read more than once and must not change between the
    reads (row positions, UDF output). The written table survives lost
    executors, and its known size lets Catalyst choose the later joins. It stays
    until its `staging_scope` ends, or the owner of the folder removes it.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/docweave/{name}-{uuid.uuid4().hex}"
    if getattr(_open_scopes, "paths", None) is not None:
        _open_scopes.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
