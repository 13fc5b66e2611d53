"""Similarity of two vector columns, and of a vector column with one fixed vector."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

DOT, COSINE, L2 = "dotproduct", "cosine", "euclidean"
METRICS = (DOT, COSINE, L2)


def check_metric(metric):
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    return metric


def _total(products):
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def dot(left, right):
    return _total(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")))


def squared_l2(left, right):
    def gap(a, b):
        return a.cast("double") - b.cast("double")
    return _total(F.zip_with(left, right, lambda a, b: gap(a, b) * gap(a, b)))


def cosine(left, right):
    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(norms > 0, dot(left, right) / norms)


def similarity(metric, left, right):
    return {DOT: dot, COSINE: cosine, L2: squared_l2}[check_metric(metric)](left, right)


def as_matrix(column, dim):
    """Arrow list column -> (row numbers, matrix) of the rows that have `dim` values."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(lengths == dim)
    if len(fits) < len(column):
        column = column.take(pa.array(fits))
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return fits, flat.reshape(len(fits), dim)


def score_matrix(metric, rows, queries):
    """Scores of every row against every query, one matrix product."""
    products = rows @ queries.T
    if metric == DOT:
        return products
    row_squares = np.einsum("ij,ij->i", rows, rows)[:, None]
    query_squares = np.einsum("ij,ij->i", queries, queries)[None, :]
    if metric == L2:
        return np.maximum(row_squares + query_squares - 2 * products, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return products / np.sqrt(row_squares * query_squares)


def score_pairs(metric, rows, queries):
    """Score of each row against the query beside it (or the only one), summed in an
    order that depends on the length alone: equal vectors score alike in any batch."""
    if metric == L2:
        return ((rows - queries) ** 2).sum(axis=1)
    products = (rows * queries).sum(axis=1)
    if metric == DOT:
        return products
    with np.errstate(divide="ignore", invalid="ignore"):
        return products / np.sqrt((rows * rows).sum(axis=1) * (queries * queries).sum(axis=1))


def score_error(metric, rows, queries):
    """How far `score_matrix` can be from `score_pairs`, for every row and query."""
    lengths = np.einsum("ij,ij->i", rows, rows)[:, None], np.einsum("ij,ij->i", queries, queries)[None, :]
    scale = lengths[0] + lengths[1] if metric == L2 else np.sqrt(lengths[0] * lengths[1])
    unit = 8 * rows.shape[1] * np.finfo(float).eps
    return unit * (np.ones_like(scale) if metric == COSINE else scale)


def score_margin(metric, rows, queries):
    """`score_error` for each query, with the worst of the rows; None if a vector has no
    finite length."""
    unit = 8 * rows.shape[1] * np.finfo(float).eps
    rows, queries = np.einsum("ij,ij->i", rows, rows), np.einsum("ij,ij->i", queries, queries)
    worst = rows.max(initial=0.0)
    if not np.isfinite(worst) or not np.isfinite(queries).all():
        return None
    scale = worst + queries if metric == L2 else np.sqrt(worst) * np.sqrt(queries)
    return unit * (np.ones_like(queries) if metric == COSINE else scale)


def score_against(metric, query_vector):
    """A column function scoring vectors against one fixed vector.

    Only the vector column crosses to Python, as Arrow batches; a vector of
    another length, or one without a cosine, scores null.
    """
    check_metric(metric)
    query = np.asarray(query_vector, dtype="float64").reshape(1, -1)
    dim = query.shape[1]

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        fits, matrix = as_matrix(vectors, dim)
        scores = np.full(len(vectors), np.nan)
        scores[fits] = score_pairs(metric, matrix, query)
        return pa.array(scores, mask=np.isnan(scores))

    return score
