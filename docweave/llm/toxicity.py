"""Toxicity by a linear classifier on character n-grams with naive Bayes log-count ratios.

Features are the character n-grams (3 to 6) that a lower-cased text holds, blanks as one
blank and one at either end; presence, not counts, so that a few words in a long text
weigh as much as in a short one. Each feature is scaled by its log-count ratio, and a
regularised logistic regression is fitted on the scaled features.

Fitting uses labelled texts only, at most `max_rows` of them (by hash of the id), and
counts n-grams on at most `max_counted` of these per label; features are the
`max_features` that are most of all commoner in toxic texts. Only counts of
n-grams and the sparse features of those rows reach the driver. Scoring is one pass over
all documents, each whole, without a shuffle.

Defined cases: null and empty texts have no features and get the score of the bias; with
no labelled text of either label every score is the smoothed share of toxic labels, 1/3
without labels; null labels are none, repeated labels count as their largest; repeated
rows get a score each; an empty table gives an empty table; other columns pass through
(result columns replace columns of the same names).
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.arrow import map_column
from docweave.session import spread_if_few, stage

SIZES = (3, 4, 5, 6)
#: Bounds of the fit: labelled texts, of these counted per label, features.
MAX_ROWS = 20_000
MAX_COUNTED = 2_000
MAX_FEATURES = 4_000
MIN_DOCS = 2
PENALTY = 0.1
#: Characters handled at once; bits of the table that tells most n-grams off.
SLICE = 500_000
TABLE_BITS = 21

_BLANKS = re.compile(r"\s+")
_MULTIPLIERS = np.random.default_rng(20240229).integers(1, 2**63, size=max(SIZES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slices(texts):
    """Runs of texts of about SLICE characters: (first, texts)."""
    first, run, chars = 0, [], 0
    for at, text in enumerate(texts):
        run.append(text or "")
        chars += len(run[-1])
        if chars >= SLICE:
            yield first, run
            first, run, chars = at + 1, [], 0
    if run:
        yield first, run


def _characters(texts):
    """Code points of the texts, each between blanks, and where each text starts."""
    flat = [" " + _BLANKS.sub(" ", text).strip().lower() + " " for text in texts]
    starts = np.cumsum([0] + [len(t) for t in flat])
    return np.frombuffer("".join(flat).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64), starts


def _grams(points, starts):
    """For each size: (hashes, of which the last size - 1 of a text reach into the next)."""
    n = len(points)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(max(SIZES)):
        if n - k > 0:
            total[:n - k] += (points[k:] + np.uint64(k + 1)) * _MULTIPLIERS[k]
        if k + 1 in SIZES:
            hashes = total ^ (total >> np.uint64(29))
            hashes *= _MIX + np.uint64(2 * k)
            yield k + 1, hashes


def _inside(places, starts, size):
    """Text of each place, and whether the n-gram there ends inside it."""
    text = np.searchsorted(starts, places, side="right") - 1
    return text, places + size <= starts[text + 1]


def _count_grams(batches):
    """(hash, toxic texts, other texts) that hold it, summed over the task's batches
    as far as they are alike; counts of a text are of distinct n-grams."""
    for batch in batches:
        labels = batch.column(1).to_numpy()
        texts = (value.as_py() for value in batch.column(0))
        for first, run in _slices(texts):
            points, starts = _characters(run)
            held = []
            for size, hashes in _grams(points, starts):
                for i in range(len(run)):
                    own = hashes[starts[i]:max(starts[i], starts[i + 1] - size + 1)]
                    if len(own):
                        own = np.unique(own)
                        held.append((own, np.full(len(own), labels[first + i], dtype=np.int64)))
            if not held:
                continue
            keys, back = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            toxic = np.concatenate([x[1] for x in held])
            yes = np.bincount(back, weights=toxic, minlength=len(keys)).astype(np.int64)
            all_ = np.bincount(back, minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(yes), pa.array(all_ - yes)], names=["h", "yes", "no"])


class Finder:
    """Finds the chosen n-grams in texts."""

    def __init__(self, keys):
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.shift = np.uint64(64 - TABLE_BITS)
        self.table = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.table[(self.keys >> self.shift).astype(np.int64)] = True

    def find(self, run):
        """(text, feature) pairs, distinct, of a run of texts."""
        points, starts = _characters(run)
        pairs = [np.zeros(0, dtype=np.int64)]
        for size, hashes in _grams(points, starts):
            places = np.flatnonzero(self.table[(hashes >> self.shift).astype(np.int32)])
            at = np.searchsorted(self.keys, hashes[places])
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == hashes[places] if len(self.keys) else np.zeros(0, dtype=bool)
            text, inside = _inside(places[hit], starts, size)
            pairs.append((text[inside] << 32) | self.order[at[hit][inside]])
        found = np.unique(np.concatenate(pairs))
        return found >> 32, found & 0xFFFFFFFF


def _find_features(keys):
    def run(batches):
        finder = Finder(keys)
        for batch in batches:
            texts = [value.as_py() for value in batch.column(0)]
            labels = batch.column(1).to_pylist()
            lists = [None] * len(texts)
            for first, part in _slices(texts):
                text, feature = finder.find(part)
                cuts = np.searchsorted(text, np.arange(len(part) + 1))
                for i in range(len(part)):
                    lists[first + i] = feature[cuts[i]:cuts[i + 1]].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists, pa.list_(pa.int32())), pa.array(labels, pa.int32())], names=["features", "label"])
    return run


@dataclass
class Model:
    """Score = logistic(bias + sum of the weights of the n-grams in the text)."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


def _fit_logistic(rows, cols, values, n_rows, n_cols, labels, penalty=PENALTY, steps=120, memory=8):
    """Logistic regression with an L2 penalty by L-BFGS, on sparse features in driver
    memory (bounded by MAX_ROWS and MAX_FEATURES)."""
    def loss(w):
        margin = np.bincount(rows, weights=values * w[cols], minlength=n_rows) + w[-1]
        gap = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / n_rows
        grad = penalty / n_rows * w
        grad[-1] = gap.sum()
        grad[:-1] += np.bincount(cols, weights=values * gap[rows], minlength=n_cols)
        fit_ = (np.logaddexp(0, margin) - labels * margin).mean()
        return fit_ + penalty / (2 * n_rows) * (w[:-1] @ w[:-1]), grad

    w = np.zeros(n_cols + 1)
    value, grad = loss(w)
    pairs = []
    for _ in range(steps):
        way, coefficients = grad.copy(), []
        for s, y, r in reversed(pairs):
            coefficients.append(r * (s @ way))
            way -= coefficients[-1] * y
        if pairs:
            s, y, r = pairs[-1]
            way *= 1 / (r * (y @ y))
        for (s, y, r), c in zip(pairs, reversed(coefficients), strict=True):
            way += s * (c - r * (y @ way))
        slope, rate = grad @ way, 1.0 if pairs else 1.0 / max(np.linalg.norm(grad), 1e-12)
        while True:
            new_w = w - rate * way
            new_value, new_grad = loss(new_w)
            if new_value <= value - 1e-4 * rate * slope or rate < 1e-10:
                break
            rate /= 2
        s, y = new_w - w, new_grad - grad
        if s @ y > 1e-14:
            pairs = [*pairs[1 - memory:], (s, y, 1 / (s @ y))]
        done = value - new_value < 1e-7 * max(value, 1e-9)
        w, value, grad = new_w, new_value, new_grad
        if done:
            break
    return w[:-1], w[-1]


def _bounded(labelled, bound):
    """At most about `bound` rows by the hash of their id, alike in every run."""
    n = labelled.count()
    if n <= bound:
        return labelled
    return labelled.where(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < int(1_000_000 * bound / n))


def fit(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic", max_rows=MAX_ROWS,
        max_counted=MAX_COUNTED, max_features=MAX_FEATURES, min_docs=MIN_DOCS) -> Model:
    """Fit on the documents that `labels` (doc_id, label 0/1) marks."""
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("label_id")).agg(F.max(F.col(label)).cast("int").alias("label"))
    # At most max_rows ids of 12 bytes: safe to send to the tasks that read the texts.
    chosen = F.broadcast(_bounded(marks, max_rows))
    train = stage(docs.select(F.col(doc_id).alias("label_id"), F.col(text).alias("text")).join(
        chosen, "label_id").select("label_id", "text", "label"), "toxicity-train")
    sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    yes, no = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    if not yes or not no:
        share = (yes + 1) / (yes + no + 3)
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), float(np.log(share / (1 - share))))

    part = F.pmod(F.xxhash64("label_id", F.lit(7)), F.lit(1_000_000))
    counted = train.where(F.when(F.col("label") == 1, part < int(1_000_000 * min(1, max_counted / yes)))
                          .otherwise(part < int(1_000_000 * min(1, max_counted / no))))
    here = {r["label"]: r["count"] for r in counted.groupBy("label").count().collect()}
    n_yes, n_no = here.get(1, 0), sum(n for k, n in here.items() if k != 1)
    sums = counted.select("text", F.when(F.col("label") == 1, 1).otherwise(0).cast("int").alias("label")).mapInArrow(
        _count_grams, "h long, yes long, no long").groupBy("h").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    # Separation: the difference of the shares, in standard errors. Only what speaks for
    # toxicity is kept: a long text holds so much of the rest that it would outweigh it.
    p, q = (F.col("yes") + 1) / (n_yes + 2), (F.col("no") + 1) / (n_no + 2)
    both = (F.col("yes") + F.col("no") + 1) / (n_yes + n_no + 2)
    apart = (p - q) / F.sqrt(both * (1 - both) * F.lit(1 / max(n_yes, 1) + 1 / max(n_no, 1)))
    best = sums.where(F.col("yes") >= min(min_docs, n_yes)).where(apart > 0).orderBy(apart.desc(), "h").limit(
        max_features).toPandas()
    if not len(best):
        share = (yes + 1) / (yes + no + 3)
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    keys = best["h"].to_numpy().view(np.uint64)
    toxic, clean = 1.0 + best["yes"].to_numpy(), 1.0 + best["no"].to_numpy()
    ratio = np.log((toxic / toxic.sum()) / (clean / clean.sum()))

    rows = train.select("text", F.when(F.col("label") == 1, 1).otherwise(0).cast("int").alias("label")).mapInArrow(
        _find_features(keys), "features array<int>, label int").toArrow()
    lists = rows.column("features").combine_chunks()
    offsets = lists.offsets.to_numpy()
    cols = lists.values.to_numpy()[offsets[0]:offsets[-1]].astype(np.int64)
    of = np.repeat(np.arange(len(lists)), np.diff(offsets))
    target = rows.column("label").to_numpy().astype(float)
    weights, bias = _fit_logistic(of, cols, ratio[cols], len(target), len(keys), target)
    return Model(keys, weights * ratio, float(bias))


def _scores(shared, position, width):
    def run(batches):
        model = shared.value
        finder = Finder(model.keys)
        for batch in batches:
            texts = [value.as_py() for value in batch.column(position)]
            margin = np.full(len(texts), model.bias)
            for first, part in _slices(texts):
                text, feature = finder.find(part)
                margin[first:first + len(part)] += np.bincount(
                    text, weights=model.weights[feature] if len(feature) else None, minlength=len(part))
            score = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            arrays = [batch.column(i) for i in range(width)] + [pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
    return run


def score(docs: DataFrame, model: Model, text="text", out="score", key="doc_id") -> DataFrame:
    """`docs` with a score from 0 to 1: the higher, the likelier toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES numbers
    made = T.StructType([T.StructField(out, T.DoubleType())])
    return map_column(spread_if_few(docs, key), made, lambda at, n: _scores(shared, at, n), text)
