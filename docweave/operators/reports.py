"""Counts per category, namespace and collection, failures and the run log.

All are aggregates with a partial step before the shuffle, so a category or
namespace that holds most rows still arrives as one row per task.
"""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from docweave.functions.names import log_key


def _rows():
    return F.count(F.lit(1))


def category_batches(files: DataFrame) -> DataFrame:
    """Files and bytes per category. The files themselves stay in their table."""
    return files.groupBy("category").agg(
        _rows().alias("files"), F.sum("size_bytes").alias("total_bytes"))


def namespace_stats(vectors: DataFrame) -> DataFrame:
    return (vectors.groupBy("namespace").agg(
        F.max(F.size("embedding")).alias("dimensions"), _rows().alias("vector_count"))
        .withColumnRenamed("namespace", "namespaces"))


def collection_count(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy(F.col("namespace").alias("collection")).agg(_rows().alias("documents"))


def list_collections(entries: DataFrame) -> DataFrame:
    """One row per collection name: when it was first created, and its type then."""
    first = F.min(F.struct("created_at", "type"))
    return (entries.groupBy("name").agg(first.alias("_first"))
            .select("name", "_first.created_at", "_first.type"))


def failure_counts(outcomes: DataFrame) -> DataFrame:
    """`outcomes` has file_id, category, error (null = fine): files per category.

    A file counts as failed when any of its rows failed.
    """
    per_file = outcomes.groupBy("category", "file_id").agg(
        F.bool_or(F.col("error").isNotNull()).alias("failed"))
    return per_file.groupBy("category").agg(
        F.count_if(~F.col("failed")).alias("ok"), F.count_if(F.col("failed")).alias("failed"))


def failure_messages(outcomes: DataFrame) -> DataFrame:
    """Distinct messages with the number of files, as rows rather than collected sets."""
    failed = outcomes.where("error is not null").select("category", "file_id", "error").distinct()
    return failed.groupBy("category", "error").agg(_rows().alias("files"))


# Where a file can fail.
STAGES = ("read", "split", "embed")


def observed_outcomes(outcomes: DataFrame):
    """(outcomes, observation): `outcomes` has one row per file, with error and stage.

    The first action on the rows counts them on the way (`observation.get`: ok, failed,
    and failed_<stage> for each stage), without a job or a scan of its own. Counted
    where the rows leave the plan, so a task that is run again counts once.
    """
    seen, bad = Observation(), F.col("error").isNotNull()
    counts = {"ok": ~bad, "failed": bad, **{f"failed_{s}": bad & (F.col("stage") == s) for s in STAGES}}
    return outcomes.observe(seen, *[F.count(F.when(which, 1)).alias(name) for name, which in counts.items()]), seen


def failed_files(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("error is not null").select("file_id").distinct()


def run_log_latest(log: DataFrame) -> DataFrame:
    """`log` has chat_id, ts, seq, message. One entry per id and second: the last written."""
    second = F.date_trunc("second", F.col("ts"))
    return (log.groupBy("chat_id", second.alias("second"))
            .agg(F.max_by("message", "seq").alias("message"))
            .select(log_key(F.col("chat_id"), F.col("second")).alias("name"),
                    "chat_id", "message"))
