"""Rows chosen by ids, metadata and namespace, and the argument guards."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.schemas import DEFAULT_NAMESPACE

# Above this many literal ids a semi join is planned instead of an IN filter.
MAX_LITERAL_IDS = 1000


def require_text(value, what):
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"{what} cannot be empty")
    return value


def require_positive(value, what):
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{what} must be a positive whole number")
    return value


def namespace_name(namespace=None):
    if namespace is None:
        return DEFAULT_NAMESPACE
    return require_text(namespace, "namespace")


def by_ids(rows: DataFrame, ids, key: str) -> DataFrame:
    """Rows whose `key` is among `ids` (a list, or a DataFrame with that column).

    A short list becomes an IN filter that reaches the scan; otherwise a semi
    join, broadcast only if Catalyst knows they are small.
    """
    if isinstance(ids, DataFrame):
        return rows.join(ids.select(key), key, "left_semi")
    ids = list(dict.fromkeys(ids))
    if not ids:
        raise ValueError("no ids given")
    if len(ids) <= MAX_LITERAL_IDS:
        return rows.where(F.col(key).isin(ids))
    wanted = rows.sparkSession.createDataFrame([(i,) for i in ids], rows.select(key).schema)
    return rows.join(wanted, key, "left_semi")


def in_namespace(vectors: DataFrame, namespace=None) -> DataFrame:
    """One namespace; prunes partitions on a table partitioned by `namespace`."""
    return vectors.where(F.col("namespace") == namespace_name(namespace))


def with_metadata(vectors: DataFrame, filters=None, columns=None) -> DataFrame:
    """Rows whose metadata equals every given value.

    `columns` (key -> column) names keys that are kept as columns too: these are
    compared there, so that the filter is pushed to the scan. A key that merely has
    the name of a column is looked up in the metadata.
    """
    for key, value in (filters or {}).items():
        source = F.col(columns[key]) if columns and key in columns else F.col("metadata")[key]
        vectors = vectors.where(source == F.lit(value))
    return vectors
