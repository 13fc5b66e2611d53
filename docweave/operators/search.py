"""Exact top-k similarity search."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.vectors import (
    DOT, L2, as_matrix, check_metric, score_against, score_error, score_margin, score_matrix, score_pairs)
from docweave.operators.embedding import DIMENSION, embed_text
from docweave.operators.selection import (
    in_namespace, require_positive, require_text, with_metadata)

# Default numbers of results for namespaces and for collections.
NAMESPACE_K = 5
COLLECTION_K = 3

# Query vectors up to this size are sent to every task; a larger set is joined
# block by block, with blocks of about these sizes in memory.
BROADCAST_BYTES = 64 * 1024 * 1024
QUERY_BLOCK_BYTES = 32 * 1024 * 1024
ROW_BLOCK_BYTES = 128 * 1024 * 1024
SCORES_AT_ONCE = 4_000_000
QUERIES_AT_ONCE = 1_024
# Pairs whose vectors are held to score them again.
PAIRS_AT_ONCE = 50_000

ALL_NAMESPACES = object()


def _best_first(metric, score="score"):
    return F.col(score).asc_nulls_last() if metric == L2 else F.col(score).desc_nulls_last()


def search(vectors: DataFrame, query_vector, k=NAMESPACE_K, metric=DOT, namespace=None,
           filters=None, columns=None) -> DataFrame:
    """The `k` rows nearest to one vector, with score and rank; equal scores by id.

    Filters compare the metadata; `columns` names keys kept as columns too.
    `namespace=ALL_NAMESPACES` searches every namespace. Each task keeps its own
    best `k` and only those travel (TakeOrderedAndProject). A vector of another
    length than the query has no score and is never a result.
    """
    require_positive(k, "k")
    query_vector = list(query_vector)
    if not query_vector:
        raise ValueError("the query vector cannot be empty")
    rows = vectors if namespace is ALL_NAMESPACES else in_namespace(vectors, namespace)
    rows = with_metadata(rows, filters, columns)
    score = score_against(metric, query_vector)(F.col("embedding"))
    top = (rows.select("id", "namespace", "content", "metadata", score.alias("score"))
           .orderBy(_best_first(metric), "id", "namespace").limit(k)
           .where("score is not null"))
    # At most k rows are left here, so one task ranks them.
    place = Window.partitionBy(F.lit(0)).orderBy(_best_first(metric), "id", "namespace")
    return top.withColumn("rank", F.row_number().over(place))


def search_text(vectors, text, k=NAMESPACE_K, model_factory=None, dim=DIMENSION, **options):
    """`search` for a query text, embedded with the model of the table."""
    require_text(text, "query")
    return search(vectors, embed_text(text, model_factory, dim), k, **options)


def search_collection(vectors, text, collection, k=COLLECTION_K, filters=None, metric=L2, **options):
    """`search_text` in one collection, with metadata filters, by squared distance."""
    require_text(collection, "collection name")
    return search_text(vectors, text, k, namespace=collection, filters=filters, metric=metric, **options)


class _Best:
    """The best `k` rows per query seen so far."""

    def __init__(self, metric, k, query_count):
        self.k, self.sign = k, (1.0 if metric == L2 else -1.0)
        self.costs = np.full((query_count, k), np.inf)
        self.ids = np.full((query_count, k), None, dtype=object)
        self.held = np.zeros(query_count, dtype=np.int64)
        self.bar = np.full(query_count, np.inf)

    def add(self, metric, ids, order, rows, queries, part):
        """Takes the rows that may be among the best of the queries of `part`: the matrix
        product tells all others off, and those left are scored again in fixed order.
        `order` numbers the ids in their order."""
        asked, bar = queries[part], self.bar[part]
        costs, margin = score_matrix(metric, asked, rows), score_margin(metric, rows, asked)
        if self.sign < 0:
            np.negative(costs, out=costs)
        if margin is None:  # Vectors without a finite length: errors pair by pair.
            error = score_error(metric, asked, rows)
            costs -= error
            hits, margin = costs <= bar[:, None], error.max(axis=1)
        else:
            hits = costs <= (bar + margin)[:, None]  # NaN compares false
        if np.count_nonzero(hits) > 4 * self.k * len(asked) and costs.shape[1] > self.k:
            # Only what reaches the k-th best of this slice, errors included.
            limit = np.partition(costs, self.k - 1, axis=1)[:, self.k - 1] + 2 * margin
            hits &= costs <= np.where(np.isnan(limit), np.inf, limit)[:, None]
        q, r = np.nonzero(hits)
        if not len(q):
            return
        exact = np.concatenate([
            self.sign * score_pairs(metric, rows[r[i:i + PAIRS_AT_ONCE]], asked[q[i:i + PAIRS_AT_ONCE]])
            for i in range(0, len(q), PAIRS_AT_ONCE)])
        q, exact, r = self._first(q, exact, order[r], r)
        self._merge(q + part.start, exact, ids[r])

    def _first(self, q, cost, turn, what):
        """The best `k` of each query, equal ones by `turn`."""
        place = np.lexsort((turn, cost, q))
        q = q[place]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        place = place[rank < self.k]
        return q[rank < self.k], cost[place], what[place]

    def _merge(self, q, cost, ids):
        touched = np.unique(q)
        old = np.arange(self.k)[None, :] < self.held[touched][:, None]
        q = np.concatenate([np.repeat(touched, self.held[touched]), q])
        cost = np.concatenate([self.costs[touched][old], cost])
        ids = np.concatenate([self.ids[touched][old], ids])
        q, cost, ids = self._first(q, cost, ids.astype(str), ids)
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        self.costs[q, rank], self.ids[q, rank] = cost, ids
        self.held[touched] = np.bincount(q, minlength=len(self.held))[touched]
        full = touched[self.held[touched] == self.k]
        self.bar[full] = self.costs[full, -1]

    def table(self, query_ids):
        there = np.arange(self.k)[None, :] < self.held[:, None]
        return pa.table({
            "query_id": pa.array(np.repeat(np.asarray(query_ids, dtype=object), self.held), pa.string()),
            "id": pa.array(self.ids[there], pa.string()),
            "score": pa.array(self.sign * self.costs[there], pa.float64()),
        })


def _scan(best, metric, ids, vectors, queries):
    """Score one batch of rows against all queries, a slice of both at a time."""
    fits, matrix = as_matrix(vectors, queries.shape[1])
    names = np.asarray(ids.to_pylist(), dtype=object)[fits]
    across = min(QUERIES_AT_ONCE, len(queries))
    down = max(1, SCORES_AT_ONCE // across)
    for start in range(0, len(fits), down):
        rows = slice(start, start + down)
        order = np.argsort(np.argsort(names[rows].astype(str), kind="stable"))
        for first in range(0, len(queries), across):
            best.add(metric, names[rows], order, matrix[rows], queries, slice(first, first + across))


def _by_broadcast(vectors, query_ids, matrix, k, metric):
    shared = vectors.sparkSession.sparkContext.broadcast((query_ids, matrix))

    def best_of_partition(batches):
        ids, queries = shared.value
        best = _Best(metric, k, len(ids))
        for batch in batches:
            _scan(best, metric, batch.column("id"), batch.column("embedding"), queries)
        yield from best.table(ids).to_batches()

    return vectors.select("id", "embedding").mapInArrow(
        best_of_partition, "query_id string, id string, score double")


def _by_blocks(vectors, queries, row_count, query_count, dim, k, metric):
    """Queries in blocks against rows in blocks, one task group per pair of blocks.

    Each side is sent once per block of the other, and neither passes through the
    driver. Inside a pair the scores are one matrix product, and at most `k` rows
    per query leave it. Blocks are cut by a hash of the unique id, so they are
    even whatever the data looks like.
    """
    across = -(-query_count * dim * 8 // QUERY_BLOCK_BYTES)
    down = max(1, -(-row_count * dim * 8 // ROW_BLOCK_BYTES))

    def spread(df, key, own, own_count, other, other_count):
        return (df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(own_count)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1)))))

    left = spread(queries.select("query_id", "embedding"), "query_id", "across", across, "down", down)
    right = spread(vectors.select("id", "embedding"), "id", "down", down, "across", across)

    def best_of_pair(asked, rows):
        names = asked.column("query_id").to_pylist()
        best = _Best(metric, k, len(names))
        if names and rows.num_rows:
            matrix = as_matrix(asked.column("embedding").combine_chunks(), dim)[1]
            _scan(best, metric, rows.column("id"), rows.column("embedding").combine_chunks(), matrix)
        return best.table(names)

    return (left.groupBy("across", "down").cogroup(right.groupBy("across", "down"))
            .applyInArrow(best_of_pair, "query_id string, id string, score double"))


def knn_join(vectors: DataFrame, queries: DataFrame, k=NAMESPACE_K, metric=DOT,
             broadcast_bytes=BROADCAST_BYTES) -> DataFrame:
    """The `k` nearest rows of `vectors` (id, embedding) for every row of `queries`
    (query_id, embedding): columns query_id, id, score, rank. Ids are unique.

    The query set is measured first. Up to `broadcast_bytes` it is sent to every
    task and the vectors are read once, unshuffled; beyond that both sides are
    joined block by block. Either way a task emits its best `k` per query, never
    the pairs, and a window keeps the overall best.
    """
    require_positive(k, "k")
    check_metric(metric)
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim"),
                       F.min(F.size("embedding")).alias("low")).first()
    if size.n == 0:
        raise ValueError("no queries given")
    if size.low != size.dim or size.dim < 1:
        raise ValueError("query vectors must all have the same length")
    if size.n * size.dim * 8 <= broadcast_bytes:
        asked = queries.select("query_id", "embedding").toArrow()
        matrix = as_matrix(asked.column("embedding").combine_chunks(), size.dim)[1]
        found = _by_broadcast(vectors, asked.column("query_id").to_pylist(), matrix, k, metric)
    else:
        found = _by_blocks(vectors, queries, vectors.count(), size.n, size.dim, k, metric)
    place = Window.partitionBy("query_id").orderBy(_best_first(metric), "id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
