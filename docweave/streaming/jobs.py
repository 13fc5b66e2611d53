"""Message-driven jobs.

State lives in the published tables, so no watermark or stateful operator is
needed. A failed micro-batch is run again by Spark; ids depend on the inputs and
the batch, and a batch already published is skipped.
"""

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators.mutations import VECTOR_KEY, get_or_create_collections
from docweave.operators.quality import message_ids, split_by_validity
from docweave.operators.selection import by_ids
from docweave.plans.changelog import ChangeLog
from docweave.plans.file_etl import replaced_chunks, run_file_etl
from docweave.plans.method_sync import sync_methods
from docweave.schemas import COLLECTIONS, FILE_METADATA, METHOD_METADATA, VECTORS, conform_files
from docweave.session import stage, staging_scope

OUTCOMES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("file_id", "category", "full_path")]
    + [T.StructField(n, T.LongType()) for n in ("documents", "chunks")]
    + [T.StructField(n, T.StringType()) for n in ("stage", "error")])
STORED = T.StructType(
    [T.StructField("full_path", T.StringType()), T.StructField("doc_no", T.LongType()),
     T.StructField("namespace", T.StringType()), T.StructField("chunks", T.LongType())])
#: Batches after which the changes are folded into a new base.
COMPACT_EVERY = 20

REJECTS = T.StructType([T.StructField(n, T.StringType()) for n in ("message_id", "method_id", "reason")])


def file_tables(spark, root) -> ChangeLog:
    return ChangeLog(spark, root, {
        "vectors": (VECTORS, VECTOR_KEY, ["namespace"]), "outcomes": (OUTCOMES, ["file_id", "full_path"]),
        "stored": (STORED, ["full_path", "doc_no"]), "collections": (COLLECTIONS, ["name"])})


def method_tables(spark, root) -> ChangeLog:
    return ChangeLog(spark, root, {
        "methods": (METHOD_METADATA, ["method_id"]), "vectors": (VECTORS, VECTOR_KEY, ["namespace"]),
        "rejects": (REJECTS, ["message_id", "method_id", "reason"])})


def apply_file_messages(messages: DataFrame, batch_id: int, log: ChangeLog, files: DataFrame,
                        root: str, on_counts=None, **options) -> bool:
    """One micro-batch of file messages: check, read, split, embed and publish the files,
    and register the collections written to.

    Records that break a rule become failure rows; their files are not read.
    `on_counts(batch_id, counts)` is told how many files of a published batch went well.
    """
    last = log.last_batch()
    if last is not None and batch_id <= last:
        return False
    with staging_scope(log.spark):
        ids = message_ids(messages).select(F.col("id").alias("file_id"))
        chosen = stage(by_ids(files, ids, "file_id"), "chosen-files")
        valid, invalid = split_by_validity(chosen)
        done = run_file_etl(stage(conform_files(valid), "valid-files"), root, invalid=_typed(invalid), **options)
        stored = stage(done.stored, "stored-now")
        before = stage(log.current("stored", stored.select("full_path")), "stored-before")
        names = stored.select(F.col("namespace").alias("name")).distinct()
        made = get_or_create_collections(log.current("collections", names), names, F.current_timestamp())
        published = log.publish(batch_id, {
            "vectors": (done.vectors, replaced_chunks(before, stored)), "outcomes": (done.outcomes, None),
            "stored": (stored, before.select("full_path", "doc_no")), "collections": (made, None)})
        if published and on_counts is not None:
            on_counts(batch_id, done.counts)
        if published and batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            log.compact()
        return published


def _typed(invalid):
    """Typed records that keep the names of the rules they break."""
    return invalid.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in invalid.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in FILE_METADATA.fields], "violations")


def apply_method_messages(messages: DataFrame, batch_id: int, log: ChangeLog, records: DataFrame,
                          run_time=None, **options) -> bool:
    """One micro-batch of method messages: both tables are published together."""
    last = log.last_batch()
    if last is not None and batch_id <= last:
        return False
    now = F.current_timestamp() if run_time is None else run_time
    with staging_scope(log.spark):
        messages = stage(messages, "messages")
        done = sync_methods(messages, records, partial(log.current, "methods"), now, batch_id, **options)
        published = log.publish(batch_id, {
            "methods": (done.metadata, None), "vectors": (done.vectors, done.old_vectors),
            "rejects": (done.rejects.distinct(), None)}, unique=("methods", "vectors", "rejects"))
        if published and batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            log.compact()
        return published


def _start(messages, apply, checkpoint, available_now):
    writer = messages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_file_job(messages: DataFrame, log: ChangeLog, files: DataFrame, root: str, checkpoint: str,
                   available_now=False, **options):
    """Run file messages as a stream; `files` is the file metadata table."""
    return _start(messages, lambda batch, batch_id: apply_file_messages(
        batch, batch_id, log, files, root, **options), checkpoint, available_now)


def start_method_job(messages: DataFrame, log: ChangeLog, records: DataFrame, checkpoint: str,
                     available_now=False, **options):
    """Run method messages as a stream; `records` are the `{metadata, content}` rows."""
    return _start(messages, lambda batch, batch_id: apply_method_messages(
        batch, batch_id, log, records, **options), checkpoint, available_now)
