"""Metadata maps."""

from pyspark.sql import functions as F


def fill_nulls(metadata):
    """Null values become the empty string."""
    return F.transform_values(metadata, lambda _, value: F.coalesce(value, F.lit("")))


def merge(left, right):
    """All keys of both maps; the right side wins on a shared key."""
    kept = F.map_filter(left, lambda key, _: ~F.map_contains_key(right, key))
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(
        F.map_concat(kept, right))


def record_map(*names, **shown):
    """The named columns as one map of texts; `shown` gives other expressions for some."""
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in names]),
        F.array(*[shown.get(name, F.col(name)).cast("string") for name in names]),
    )
