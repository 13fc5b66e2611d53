"""Method records -> metadata table and vector table, kept in step."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.maps import fill_nulls, merge
from docweave.functions.names import stable_uuid, table_time
from docweave.operators.embedding import DIMENSION, embed_rows
from docweave.operators.mutations import one_per_key
from docweave.operators.quality import check_messages, message_ids, unmatched_messages
from docweave.operators.selection import namespace_name
from docweave.schemas import METHOD_METADATA, METHOD_RECORD
from docweave.session import stage

RECORD_FIELDS = METHOD_RECORD["metadata"].dataType.names


@dataclass
class MethodSync:
    """`metadata`: rows to upsert by method_id; `old_vectors`: namespace and id of
    vectors to delete; `vectors`: rows to insert; `rejects`: message_id, method_id, reason."""

    metadata: DataFrame
    old_vectors: DataFrame
    vectors: DataFrame
    rejects: DataFrame


def wanted_ids(messages: DataFrame) -> DataFrame:
    """The ids that valid messages ask for, each once."""
    valid = check_messages(messages).where("valid")
    # Written first: the size of the id list is then known to the joins with it.
    return stage(message_ids(valid).select(F.col("id").alias("method_id")).distinct(), "wanted-ids")


def requested_records(messages: DataFrame, records: DataFrame, wanted: DataFrame | None = None):
    """(records asked for by valid messages, rejected messages).

    `records` are `{metadata, content}` rows. A message with a bad id, or whose
    ids match no record, is rejected; a record asked for twice appears once.
    `wanted` are the `wanted_ids` of the messages, if they are written already.
    """
    wanted = wanted_ids(messages) if wanted is None else wanted
    flat = records.select("metadata.*", "content")
    matched = flat.join(wanted, "method_id", "left_semi")
    # Records carry no version, so among copies with one id any fixed rule will do.
    return one_per_key(matched, ["method_id"]), rejected_messages(messages, flat)


def rejected_messages(messages: DataFrame, records: DataFrame) -> DataFrame:
    """message_id and reason of the messages with a bad id, and of those none of whose
    ids is a method_id of `records`."""
    checked = check_messages(messages)
    bad = checked.where("not valid").select(
        "message_id", F.concat(F.lit("ids are not numeric: "), F.concat_ws(", ", "bad_ids")).alias("reason"))
    none = unmatched_messages(checked.where("valid").select("message_id", "value"), records, "method_id").select(
        "message_id", F.lit("no matching data").alias("reason"))
    return bad.unionByName(none)


def classify(records: DataFrame, state: DataFrame, reduced=False) -> DataFrame:
    """Each record with `exists`, `old_uuid` and `old_created_at` from the table.

    `reduced=True` says that `state` holds only rows of the ids asked for.
    """
    # The table is reduced to the ids asked for before the join, by a semi join
    # that needs no shuffle of the table while they are few.
    asked = state if reduced else state.join(records.select("method_id"), "method_id", "left_semi")
    known = asked.select("method_id", F.lit(True).alias("_known"), F.col("uuid").alias("old_uuid"),
                         F.col("vector_created_at").alias("old_created_at"))
    return (records.join(known, "method_id", "left")
            .withColumn("exists", F.coalesce("_known", F.lit(False))).drop("_known"))


def next_metadata(classified: DataFrame, run_time, batch_id, *kept) -> DataFrame:
    """Rows of the metadata table after the run: a new uuid for each, the first
    creation time kept, the update time set only where the method existed; `kept` are
    columns of `classified` to keep beside them.

    The uuid depends on the method and the batch, so a replayed batch writes the
    same rows again.
    """
    exists = F.col("exists")
    return classified.select(
        "method_id", stable_uuid(F.col("method_id"), F.lit(str(batch_id))).alias("uuid"),
        "method_name", "segment", "category", F.col("content").alias("description"),
        "created_by", "updated_by",
        F.when(exists, F.col("old_created_at")).otherwise(run_time).alias("vector_created_at"),
        F.when(exists, run_time).alias("vector_updated_at"), *kept)


def document_metadata():
    """The metadata map of a row's document; nulls become the empty string."""
    record = F.map_from_arrays(F.array(*[F.lit(n) for n in RECORD_FIELDS]),
                               F.array(*[F.col(n) for n in RECORD_FIELDS]))
    added = F.create_map(
        F.lit("uuid"), F.col("uuid"),
        F.lit("vectorCreatedAt"), table_time(F.col("vector_created_at")),
        F.lit("vectorUpdatedAt"), table_time(F.col("vector_updated_at")))
    return fill_nulls(merge(record, added))


def old_vector_ids(classified: DataFrame, namespace=None) -> DataFrame:
    """Keys of the vectors the new ones replace."""
    return classified.where("exists").select(
        F.lit(namespace_name(namespace)).alias("namespace"), F.col("old_uuid").alias("id"))


def sync_methods(messages: DataFrame, records: DataFrame, state, run_time, batch_id,
                 model_factory=None, dim=DIMENSION, namespace=None) -> MethodSync:
    """Everything one batch of messages changes, from one plan.

    `state` is the metadata table, or a function that picks from it the rows of given ids
    (a DataFrame with `method_id`). A method that cannot be embedded changes neither table
    and is reported.
    """
    # One list of ids picks from both tables: what is picked is not worked out twice.
    wanted = wanted_ids(messages)
    asked, _ = requested_records(messages, records, wanted)
    known = state(wanted) if callable(state) else state.join(wanted, "method_id", "left_semi")
    rows = next_metadata(classify(asked, known, reduced=True), run_time, batch_id, "exists", "old_uuid")
    # Embedding is the costly step and feeds all outputs: the texts are written once.
    done = stage(embed_rows(rows.withColumn("_metadata", document_metadata()), "description",
                            model_factory, dim), "method-sync")
    good = done.where("embedding_error is null")
    vectors = good.select(F.col("uuid").alias("id"), "embedding", F.col("description").alias("content"),
                          F.col("_metadata").alias("metadata"),
                          F.lit(namespace_name(namespace)).alias("namespace"))
    failed = done.where("embedding_error is not null").select(
        F.lit(None).cast("string").alias("message_id"), "method_id",
        F.concat(F.lit("cannot embed: "), "embedding_error").alias("reason"))
    # Each record asked for is among the rows just written: the records are not read again.
    rejects = rejected_messages(messages, done).select(
        "message_id", F.lit(None).cast("string").alias("method_id"), "reason")
    return MethodSync(good.select(*METHOD_METADATA.names), old_vector_ids(good, namespace),
                      vectors, rejects.unionByName(failed))
