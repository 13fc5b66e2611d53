"""Keyed changes of a table, as pure functions (current, change) -> next."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions.maps import merge
from docweave.operators.embedding import DIMENSION, embed_rows
from docweave.operators.selection import in_namespace, namespace_name, require_positive, require_text
from docweave.schemas import DEFAULT_NAMESPACE
from docweave.session import stage

VECTOR_KEY = ["namespace", "id"]


def latest_per_key(changes: DataFrame, keys, order_by) -> DataFrame:
    """One row per key: the one with the greatest `order_by` columns.

    An aggregate, so the copies of a hot key are reduced before the shuffle.
    """
    payload = F.struct(*[F.col(c) for c in changes.columns])
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    return (changes.groupBy(*keys).agg(F.max_by(payload, order).alias("_row"))
            .select("_row.*"))


def one_per_key(changes: DataFrame, keys, order_by=None) -> DataFrame:
    """One row per key; of several, the one with the greatest `order_by` columns, and of
    equal ones the one with the greatest hash of the row: any, but always the same.

    One aggregate, which reads the change once.
    """
    rest = [_hashable(F.col(f.name), f.dataType) for f in changes.schema.fields if f.name not in keys]
    order = [*(order_by or []), F.xxhash64(*rest) if rest else F.lit(0)]
    return latest_per_key(changes, keys, order)


def _hashable(value, kind):
    """What stands for a value in a hash: maps are alike whatever the order of their entries."""
    if isinstance(kind, T.MapType) and not isinstance(kind.valueType, (T.MapType, T.VariantType)):
        # An empty map and none at all would hash alike.
        return F.struct(value.isNull().alias("none"), F.array_sort(F.map_entries(value)).alias("entries"))
    if isinstance(kind, (T.MapType, T.VariantType)):
        return F.to_json(F.struct(value.alias("v")))
    return value


def insert(current: DataFrame, new: DataFrame) -> DataFrame:
    return current.unionByName(new)


def delete(current: DataFrame, gone: DataFrame, keys) -> DataFrame:
    """Rows whose key is not in `gone`. Null keys are kept."""
    return current.join(gone.select(*keys), keys, "left_anti")


def upsert(current: DataFrame, new: DataFrame, keys, order_by=None, unique=False) -> DataFrame:
    """Rows of `new`, one per key (see `one_per_key`), and the rows of `current` with
    other keys.

    `unique=True` says that no key of `new` repeats. The current rows pass through an
    anti join on the keys only: no shuffle while the change is small.
    """
    if not unique:
        new = one_per_key(new, keys, order_by)
    return current.join(new.select(*keys), keys, "left_anti").unionByName(new)


def merge_into(new: DataFrame, table: str, keys) -> None:
    """Upsert into a catalogue table whose format supports MERGE (parquet does not)."""
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"{table}.{key}") == F.col(f"new.{key}"))
    new.alias("new").mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def update(current: DataFrame, changes: DataFrame, keys, order_by=None, unique=False) -> DataFrame:
    """Overwrite the columns `changes` carries beside its keys, where the key matches.

    A null in `changes` overwrites too; unmatched changes do nothing; of changes with
    one key a single one counts (see `one_per_key`). Columns of `order_by` that the
    table lacks only serve the order.
    """
    columns = [c for c in changes.columns if c not in keys and (c in current.columns or c not in (order_by or ()))]
    unknown = sorted(set(columns) - set(current.columns))
    if unknown or not columns:
        raise ValueError(f"nothing to update, or unknown columns: {unknown}")
    if not unique:
        changes = one_per_key(changes, keys, order_by)
    renamed = changes.select(*keys, F.lit(True).alias("_hit"),
                             *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = current.join(renamed, keys, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in current.columns])


def chain(current: DataFrame, *steps) -> DataFrame:
    """Apply `steps` (table -> table) in order. Nothing is written in between, so
    either the last result is published or nothing is."""
    for step in steps:
        current = step(current)
    return current


# Vector tables ---------------------------------------------------------------

def fill_namespace(rows: DataFrame) -> DataFrame:
    named = F.when(F.coalesce(F.col("namespace"), F.lit("")) == "", DEFAULT_NAMESPACE)
    return rows.withColumn("namespace", named.otherwise(F.col("namespace")))


def upsert_vectors(vectors: DataFrame, new: DataFrame, order_by=None, unique=False) -> DataFrame:
    """New vectors replace those of the same namespace and id; of several with one id
    the last by `order_by` counts (columns the table lacks only serve the order).
    `unique=True` says that there are none."""
    one = fill_namespace(new)
    if not unique:
        one = one_per_key(one, VECTOR_KEY, order_by)
    return upsert(vectors, one.select(*vectors.columns), VECTOR_KEY, unique=True)


def delete_vectors(vectors: DataFrame, ids, namespace=None) -> DataFrame:
    """Remove ids from one namespace; `ids` is a list, or a DataFrame with `id` and
    optionally `namespace`."""
    if isinstance(ids, DataFrame):
        if "namespace" not in ids.columns:
            ids = ids.withColumn("namespace", F.lit(namespace_name(namespace)))
        return delete(vectors, fill_namespace(ids), VECTOR_KEY)
    ids = list(ids)
    if not ids:
        raise ValueError("no ids given for deletion")
    gone = vectors.sparkSession.createDataFrame([(i,) for i in ids], "id string")
    return delete_vectors(vectors, gone, namespace)


def update_vectors(vectors: DataFrame, changes: DataFrame, order_by=None) -> DataFrame:
    """New vectors, and metadata merged into the old, by (namespace, id).

    `changes` has namespace, id, embedding and metadata; a null metadata leaves
    the old one. Ids that do not exist change nothing; of several changes of one id
    the last by `order_by` counts.
    """
    renamed = one_per_key(fill_namespace(changes), VECTOR_KEY, order_by).select(
        *VECTOR_KEY, F.lit(True).alias("_hit"),
        F.col("embedding").alias("_embedding"), F.col("metadata").alias("_metadata"))
    joined = vectors.join(renamed, VECTOR_KEY, "left")
    new = {
        "embedding": F.when(F.col("_hit"), F.col("_embedding")).otherwise(F.col("embedding")),
        "metadata": F.when(F.col("_hit"), merge(F.col("metadata"), F.col("_metadata")))
        .otherwise(F.col("metadata")),
    }
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in vectors.columns])


def update_texts(vectors: DataFrame, changes: DataFrame, model_factory=None, dim=DIMENSION):
    """`update_vectors` from new texts: `changes` has namespace, id, text, metadata.

    Returns (vectors, rejects): changes without id or text, or whose text cannot be
    embedded, are rejected with a reason and change nothing.
    """
    done = stage(embed_rows(changes, "text", model_factory, dim), "updates")
    reason = (F.when(F.coalesce(F.col("id"), F.lit("")) == "", "id is empty")
              .when(F.coalesce(F.col("text"), F.lit("")) == "", "text is empty")
              .otherwise(F.col("embedding_error")))
    good = done.where(reason.isNull()).select("namespace", "id", "embedding", "metadata")
    rejects = done.where(reason.isNotNull()).select("namespace", "id", reason.alias("reason"))
    return update_vectors(vectors, good), rejects


def wrong_dimension(vectors: DataFrame, dim: int) -> DataFrame:
    """Rows whose vector does not have `dim` values."""
    require_positive(dim, "dimension")
    return vectors.where(F.coalesce(F.size("embedding") != dim, F.lit(True)))


def delete_namespace(vectors: DataFrame, namespace: str) -> DataFrame:
    """All rows but those of `namespace`; an unknown namespace is an error."""
    require_text(namespace, "namespace")
    if in_namespace(vectors, namespace).select(F.lit(1)).limit(1).isEmpty():
        raise ValueError(f"namespace {namespace!r} does not exist")
    return vectors.where(~F.col("namespace").eqNullSafe(namespace))


def delete_all_namespaces(vectors: DataFrame) -> DataFrame:
    return vectors.where(F.lit(False))


def get_or_create_collections(collections: DataFrame, wanted: DataFrame, run_time) -> DataFrame:
    """Adds the names of `wanted` (name[, type]) that do not exist; existing rows stay."""
    kind = F.col("type") if "type" in wanted.columns else F.lit("Document")
    new = (wanted.groupBy("name").agg(F.min(kind).alias("type"))
           .where(F.coalesce(F.col("name"), F.lit("")) != "")
           .select("name", run_time.alias("created_at"), "type"))
    return collections.unionByName(new.join(collections.select("name"), "name", "left_anti"))


def delete_collection(vectors: DataFrame, collections: DataFrame, name: str):
    """(vectors, collections) without the collection."""
    require_text(name, "collection name")
    return (vectors.where(~F.col("namespace").eqNullSafe(name)),
            collections.where(~F.col("name").eqNullSafe(name)))


# File catalogue --------------------------------------------------------------

def delete_files(catalogue: DataFrame, gone: DataFrame) -> DataFrame:
    return delete(catalogue, gone, ["container", "name"])
