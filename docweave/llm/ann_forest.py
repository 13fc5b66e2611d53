"""Nearest neighbours by inner product from a forest of random-projection trees.

Vectors are given one more component, the root of (largest squared length - own), which
turns the largest inner product into the smallest angle. A tree has one random direction
per level and one threshold per node, the median of the sample there; a level splits
every node. The forest is fitted on at most `sample` vectors and sent to the tasks.

Every vector is put into one leaf of each tree. A query walks all trees at once: one
priority queue holds the branches not taken, by the sum of squared distances to the
planes crossed, and leaves are taken from its head until they hold the budget of rows.
The budget is measured, not guessed: for a bounded sample of queries the true neighbours
are found by a scan, and the share of rows that finds `recall` of them is the budget.

Leaves are dealt out in buckets of bounded size; a leaf larger than that is split, and
its queries visit all its parts. The rows of a bucket come first and are held, then its
queries pass by in slices, so that a task holds one bucket and one slice, however many
queries there are. A bucket gives, for each of its queries, its best there, equal scores
in the order of the ids; the final score is summed in fixed order in double precision on
the original components.

Equal vectors are one class with its k + 1 smallest ids, which is all that a list of k
can hold: a group of copies, however large, is one entry of the index.

Defined cases: vectors that are null, zero, of another length than most, or that hold a
null or non-finite component take no part; a repeated row counts once; an id with several
vectors takes part with each, and its best score counts; with k or fewer others, all are
returned, as the budget covers small tables whole; an empty table gives an empty table.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.session import stage

TREES = 8
LEAF_ROWS = 96
MAX_DEPTH = 14
SAMPLE = 32_768
TEST_QUERIES = 48
RECALL = 0.97
BUCKET_ROWS = 12_288
#: Queries that meet a bucket at once, visits written at once, scores held at once, and
#: lists of a bucket and query that are merged at once.
SLICE = 2_048
VISITS = 8_192
CELLS = 1 << 21
MERGED = 16_384


def usable(rows, vector):
    """Rows whose vectors take part."""
    v = F.col(vector)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(v.isNotNull() & (F.size(v) > 0)).where(F.coalesce(whole, F.lit(False))).where(
        F.exists(v, lambda x: x != 0))


def _matrix(column):
    """Rows of an Arrow list column as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Forest:
    def __init__(self, sample, longest, trees, depth, seed):
        rng = np.random.default_rng(seed)
        self.longest, self.trees, self.depth = longest, trees, depth
        dim = sample.shape[1] + 1
        self.directions = rng.standard_normal((dim, trees * depth))
        for t in range(trees):
            own = self.directions[:, t * depth:(t + 1) * depth]
            if depth <= dim:
                own[:] = np.linalg.qr(own)[0]
            else:
                own /= np.linalg.norm(own, axis=0)
        shadow = self.project(self.lifted(sample))
        self.thresholds = np.zeros((trees, depth, 1 << max(depth - 1, 0)))
        for t in range(trees):
            node = np.zeros(len(sample), dtype=np.int64)
            for level in range(depth):
                values = shadow[:, t * depth + level]
                cut = self.thresholds[t, level]
                cut[:] = np.median(values) if len(values) else 0.0
                order = np.argsort(node, kind="stable")
                edges = np.searchsorted(node[order], np.arange((1 << level) + 1))
                for n in range(1 << level):
                    if edges[n] < edges[n + 1]:
                        cut[n] = np.median(values[order[edges[n]:edges[n + 1]]])
                node = node * 2 + (values > cut[node])

    def lifted(self, vectors):
        rest = self.longest ** 2 - np.einsum("ij,ij->i", vectors, vectors)
        return np.hstack([vectors, np.sqrt(np.maximum(rest, 0))[:, None]])

    def project(self, lifted):
        return lifted @ self.directions

    def leaves(self, vectors):
        """Leaf numbers, tree by tree: tree * leaves + leaf."""
        shadow = self.project(self.lifted(vectors))
        out = np.zeros((len(vectors), self.trees), dtype=np.int64)
        for t in range(self.trees):
            node = np.zeros(len(vectors), dtype=np.int64)
            for level in range(self.depth):
                node = node * 2 + (shadow[:, t * self.depth + level] > self.thresholds[t, level][node])
            out[:, t] = (t << self.depth) + node
        return out

    def walk(self, shadow, sizes, budget):
        """Leaves in the order of the queue until they hold `budget` rows."""
        depth, thresholds = self.depth, self.thresholds
        queue = [(0.0, t, 0, 0) for t in range(self.trees)]
        taken, rows = [], 0
        while queue and rows < budget:
            far, t, level, node = heapq.heappop(queue)
            while level < depth:
                gap = shadow[t * depth + level] - thresholds[t, level, node]
                side = 1 if gap > 0 else 0
                heapq.heappush(queue, (far + gap * gap, t, level + 1, node * 2 + 1 - side))
                node, level = node * 2 + side, level + 1
            leaf = (t << depth) + node
            if sizes[leaf]:
                taken.append(leaf)
                rows += int(sizes[leaf])
        return taken

    def query_shadows(self, vectors):
        # A query's extra component is 0.
        return self.project(np.hstack([vectors, np.zeros((len(vectors), 1))]))


class _Layout:
    """Leaves in buckets: leaf -> first bucket and number of parts. A bucket holds leaves
    of one tree, so that no vector is in it twice."""

    def __init__(self, sizes, rows, trees):
        self.bucket = np.zeros(len(sizes), dtype=np.int64)
        self.parts = np.ones(len(sizes), dtype=np.int64)
        bucket, held = 0, 0
        for leaf, size in enumerate(sizes.tolist()):
            if leaf and (held + size > rows and held or leaf % (len(sizes) // trees) == 0):
                bucket, held = bucket + 1, 0
            self.bucket[leaf] = bucket
            held += size
            if size > rows:
                self.parts[leaf] = -(-size // rows)
                bucket, held = bucket + self.parts[leaf], 0
        self.count = int(bucket) + 1


def _index_rows(shared):
    def run(batches):
        forest, layout = shared.value[0], shared.value[1]
        for batch in batches:
            vectors = _matrix(batch.column(1))
            if not len(vectors):
                continue
            leaves = forest.leaves(vectors)
            for t in range(forest.trees):
                own = leaves[:, t]
                ids = batch.column(0)
                part = np.abs(ids.to_numpy()) % layout.parts[own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(layout.bucket[own] + part), pa.array(own), ids, batch.column(1), batch.column(2)],
                    names=["bucket", "leaf", "c", "vector", "least"])
    return run


def _leaf_sizes(shared):
    def run(batches):
        forest = shared.value
        sums = np.zeros(forest.trees << forest.depth, dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0))
            if len(vectors):
                sums += np.bincount(forest.leaves(vectors).ravel(), minlength=len(sums))
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums[held])], names=["leaf", "n"])
    return run


def _visits(shared):
    """Queries -> one row per bucket they visit, with the leaves there."""
    def run(batches):
        forest, layout, sizes, budget = shared.value
        for batch in batches:
            vectors = _matrix(batch.column(1))
            if not len(vectors):
                continue
            shadows = forest.query_shadows(vectors)
            which, buckets, lists = [], [], []

            def written(batch=batch):
                take = pa.array(which, pa.int32())
                made = pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int64()), batch.column(0).take(take), batch.column(1).take(take),
                     pa.array(lists, pa.list_(pa.int64()))], names=["bucket", "q", "vector", "leaves"])
                for part in (which, buckets, lists):
                    part.clear()
                return made

            for i in range(len(vectors)):
                leaves = np.array(forest.walk(shadows[i], sizes, budget), dtype=np.int64)
                many = layout.parts[leaves]
                each = np.repeat(leaves, many)
                bucket = layout.bucket[each] + np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
                order = np.argsort(bucket, kind="stable")
                found, cuts = np.unique(bucket[order], return_index=True)
                lists += np.split(each[order], cuts[1:])
                buckets += found.tolist()
                which += [i] * len(found)
                if len(which) >= VISITS:
                    yield written()
            if which:
                yield written()
    return run


def _exact(queries, vectors):
    """Inner products row by row, each summed in the same order wherever it is made."""
    return (queries * vectors).sum(axis=1)


class _Bucket:
    """The rows of one bucket, leaf by leaf."""

    def __init__(self, parts):
        index = pa.Table.from_batches(parts)
        leaf_of = index.column("leaf").to_numpy()
        self.order = np.argsort(leaf_of, kind="stable")
        self.leaves, self.starts = np.unique(leaf_of[self.order], return_index=True)
        self.ends = np.append(self.starts[1:], len(self.order))
        self.vectors = _matrix(index.column("vector"))
        self.ids, self.least = index.column("id").to_numpy(), index.column("least").to_numpy()

    def best(self, asked, keep):
        """The best `keep` of each query of a slice."""
        queries = _matrix(asked.column("vector"))
        lists = asked.column("leaves")
        asked_leaf = lists.flatten().to_numpy()
        asked_by = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        by_leaf = np.argsort(asked_leaf, kind="stable")
        asked_leaf, asked_by = asked_leaf[by_leaf], asked_by[by_leaf]
        best = np.full((len(queries), keep), -np.inf)
        settled = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        found, waiting = [], 0
        for leaf, start, end in zip(self.leaves, self.starts, self.ends, strict=True):
            lo, hi = np.searchsorted(asked_leaf, [leaf, leaf + 1])
            here = self.order[start:end]
            step = max(1, CELLS // len(here))
            for at in range(lo, hi, step):
                own = asked_by[at:min(at + step, hi)]
                scores = queries[own] @ self.vectors[here].T
                top = np.concatenate([best[own], scores], axis=1)
                best[own] = np.partition(top, top.shape[1] - keep, axis=1)[:, -keep:]
                row, col = np.nonzero(scores >= _below(best[own].min(axis=1))[:, None])
                found.append((own[row], here[col], scores[row, col]))
                waiting += len(row)
                if waiting > CELLS:
                    settled, found, waiting = self._settled(settled, found, queries, best, keep), [], 0
        q, v, exact = self._settled(settled, found, queries, best, keep)
        rows, cuts = np.unique(q, return_index=True)
        offsets = pa.array(np.append(cuts, len(q)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [asked.column("id").take(pa.array(rows)), pa.ListArray.from_arrays(offsets, pa.array(self.ids[v])),
             pa.ListArray.from_arrays(offsets, pa.array(self.least[v])),
             pa.ListArray.from_arrays(offsets, pa.array(exact))], names=["q", "found", "least", "scores"])

    def _settled(self, settled, found, queries, best, keep):
        """Candidates told apart by their exact scores, in the order of `_merge`."""
        if not found:
            return settled
        q, v, s = (np.concatenate([f[i] for f in found]) for i in range(3))
        good = s >= _below(best.min(axis=1))[q]
        q, v = q[good], v[good]
        step = max(1, CELLS // queries.shape[1])
        exact = [_exact(queries[q[at:at + step]], self.vectors[v[at:at + step]]) for at in range(0, len(q), step)]
        q, v, exact = (np.concatenate(both) for both in zip(settled, (q, v, np.concatenate([np.zeros(0), *exact])),
                                                            strict=True))
        order = np.lexsort((self.ids[v], self.least[v], -exact, q))
        q, v, exact = q[order], v[order], exact[order]
        good = _places(q) < keep
        return q[good], v[good], exact[good]


def _places(groups):
    """Place of each row within its run of equal numbers."""
    _, starts, counts = np.unique(groups, return_index=True, return_counts=True)
    return np.arange(len(groups)) - np.repeat(starts, counts)


def _search_buckets(keep):
    """Rows in order of bucket, those of the index before those that ask."""
    def run(batches):
        number, held, bucket = None, [], None
        for batch in batches:
            numbers = batch.column("bucket").to_numpy()
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero((numbers[1:] != numbers[:-1]) | (asked[1:] != asked[:-1])) + 1).tolist()
            for start, end in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if numbers[start] != number:
                    number, held, bucket = numbers[start], [], None
                if not asked[start]:
                    held.append(part)
                    continue
                if held:
                    bucket, held = _Bucket(held), []
                # A part of a leaf may be empty.
                if bucket is not None:
                    for at in range(0, part.num_rows, SLICE):
                        yield bucket.best(part.slice(at, SLICE), keep)
    return run


def _below(bound):
    """A little less than the bound: sums in another order differ by that much at most."""
    return np.where(np.isfinite(bound), bound - 1e-9 * np.maximum(1.0, np.abs(bound)), bound)


def _merge(keep):
    """Best `keep` classes of each query; equal scores in the order of their smallest ids."""
    def run(rows):
        lists = rows.column("found").combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        q = np.repeat(rows.column("q").to_numpy(), counts)
        ids = lists.flatten().to_numpy()
        least = rows.column("least").combine_chunks().flatten().to_numpy()
        scores = rows.column("scores").combine_chunks().flatten().to_numpy()
        order = np.lexsort((ids, least, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        # One class is found through several trees, with the same score.
        fresh = np.ones(len(q), dtype=bool)
        fresh[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
        q, ids, scores = q[fresh], ids[fresh], scores[fresh]
        good = _places(q) < keep
        return pa.table({"q": q[good], "c": ids[good], "score": scores[good]})
    return run


def _true_neighbours(queries, k):
    """Best k of each task for the test queries (bounded): their vectors and scores."""
    def run(batches):
        best = [(np.full(0, -np.inf), np.zeros((0, queries.shape[1])))] * len(queries)
        for batch in batches:
            vectors = _matrix(batch.column(0))
            if not len(vectors):
                continue
            scores = queries @ vectors.T
            for i in range(len(queries)):
                both = np.concatenate([best[i][0], scores[i]])
                rows = np.concatenate([best[i][1], vectors])
                top = np.argsort(-both, kind="stable")[:k]
                best[i] = (both[top], rows[top])
        which = np.repeat(np.arange(len(queries)), [len(b[0]) for b in best])
        vectors = [row for b in best for row in b[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(which), pa.array(np.concatenate([b[0] for b in best])), pa.array(vectors, pa.list_(pa.float64()))],
            names=["i", "score", "vector"])
    return run


def _measured_budget(forest, sizes, classes, tests, k, recall, n):
    """Rows to visit so that `recall` of the true neighbours of the test queries are met."""
    if not len(tests):
        return n * forest.trees
    found = classes.select("vector").mapInArrow(
        _true_neighbours(tests, k + 1), "i long, score double, vector array<double>")
    rows = found.withColumn("place", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score")))).where(
        F.col("place") <= k + 1).select("i", "vector").toArrow()
    of, vectors = rows.column("i").to_numpy(), _matrix(rows.column("vector"))
    leaves = forest.leaves(vectors)
    shadows = forest.query_shadows(tests)
    needed = []
    for i in range(len(tests)):
        order = forest.walk(shadows[i], sizes, np.inf)
        reached = np.full(len(sizes), np.inf)
        reached[order] = np.cumsum(sizes[order])
        needed += reached[leaves[of == i]].min(axis=1).tolist()
    return float(np.quantile(needed, recall, method="higher"))


def search(rows: DataFrame, queries: DataFrame, k=20, row_id="vec_id", vector="embedding", trees=TREES,
           leaf_rows=LEAF_ROWS, sample=SAMPLE, recall=RECALL, bucket_rows=BUCKET_ROWS, seed=11) -> DataFrame:
    """query_id, rank, vec_id and score: for each row of `queries` (a part of `rows`,
    same columns) its k nearest among the other rows."""
    own = usable(rows.select(F.col(row_id).alias("id"), F.col(vector).alias("vector")), "vector").where("id is not null")
    asked = usable(queries.select(F.col(row_id).alias("id"), F.col(vector).alias("vector")), "vector").where("id is not null")
    lengths = own.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    none = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if lengths is None:
        return none
    own, asked = (x.where(F.size("vector") == lengths["n"]) for x in (own, asked))
    # The k + 1 smallest ids of each distinct vector; more can be in no list.
    copies = own.distinct().withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id")))
    grouped = copies.where(F.col("place") <= k + 1).groupBy("vector").agg(
        F.array_sort(F.collect_list("id")).alias("ids"))
    # An id with several vectors may head several classes: a hash tells them apart.
    classes = stage(grouped.select(F.xxhash64(F.col("ids")[0], "vector").alias("c"), "vector", "ids"), "ann-classes")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    facts = classes.agg(F.count("c").alias("n"), F.sqrt(F.max(norm)).alias("longest")).first()
    n = facts["n"]
    askers = stage(asked.distinct().join(classes.select("c", "vector"), "vector").select("id", "c"), "ann-askers")
    query_rows = stage(classes.join(askers.select("c").distinct(), "c", "left_semi").select("c", "vector"), "ann-queries")

    picked = classes.where(F.pmod("c", F.lit(1_000_003)) < int(1_000_003 * min(1.0, sample / n)) + 1)
    depth = max(0, min(MAX_DEPTH, int(np.ceil(np.log2(max(n, 1) / leaf_rows)))))
    forest = Forest(_matrix(picked.select("vector").toArrow().column(0)), facts["longest"], trees, depth, seed)
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(forest)  # trees x 2^depth thresholds
    counted = classes.select("vector").mapInArrow(_leaf_sizes(shared), "leaf long, n long").groupBy("leaf").agg(
        F.sum("n").alias("n")).toPandas()
    sizes = np.zeros(trees << depth, dtype=np.int64)
    sizes[counted["leaf"]] = counted["n"]
    tests = query_rows.orderBy(F.xxhash64("c")).limit(TEST_QUERIES).select("vector").toArrow().column(0)
    budget = _measured_budget(forest, sizes, classes, _matrix(tests), k, recall, n)
    budget = max(budget, 4.0 * trees * leaf_rows, 4.0 * (k + 1))
    layout = _Layout(sizes, bucket_rows, trees)
    plan = context.broadcast((forest, layout, sizes, budget))

    element = classes.schema["vector"].dataType.simpleString()
    index = classes.select("c", "vector", F.col("ids")[0].alias("least")).mapInArrow(
        _index_rows(plan), f"bucket long, leaf long, c long, vector {element}, least long")
    visits = query_rows.repartition(2 * context.defaultParallelism, "c").mapInArrow(
        _visits(plan), f"bucket long, q long, vector {element}, leaves array<long>")
    none_of = {"leaf": "bigint", "least": "bigint", "leaves": "array<bigint>"}
    index = index.withColumnRenamed("c", "id").withColumns({
        "asked": F.lit(False), "leaves": F.lit(None).cast(none_of["leaves"])})
    visits = visits.withColumnRenamed("q", "id").withColumns({
        "asked": F.lit(True), **{n: F.lit(None).cast(none_of[n]) for n in ("leaf", "least")}})
    met = index.unionByName(visits).repartition("bucket").sortWithinPartitions("bucket", "asked")
    found = met.mapInArrow(
        _search_buckets(k + 1), "q long, found array<long>, least array<long>, scores array<double>")
    # A query has at most one list of each bucket.
    n_queries = query_rows.count()
    shares = max(1, min(n_queries, -(-n_queries * layout.count // MERGED)))
    best = stage(found.withColumn("share", F.pmod(F.xxhash64("q"), F.lit(shares))).groupBy("share").applyInArrow(
        _merge(k + 1), "q long, c long, score double"), "ann-best")
    # The list of a class: the ids of the classes found, by score and id.
    listed = best.join(classes.select("c", "ids"), "c").select("q", "score", F.explode("ids").alias("id")).select(
        "q", F.struct((-F.col("score")).alias("far"), "id").alias("hit"))
    lists = listed.groupBy("q").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
    each = askers.join(lists, askers["c"] == lists["q"]).select(F.col("id").alias("query_id"), "hits")
    others = F.slice(F.filter("hits", lambda h: h["id"] != F.col("query_id")), 1, 4 * k + 4)
    return _ranked(each.select("query_id", F.explode(others).alias("hit")), k)


def _ranked(hits, k):
    best = hits.groupBy("query_id", F.col("hit.id").alias("vec_id")).agg((-F.min("hit.far")).alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
