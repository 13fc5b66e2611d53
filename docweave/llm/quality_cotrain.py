"""Quality by co-training a classifier on the text with one on the page's metadata.

The two views see different columns. The text view is a logistic regression on shape
statistics and hashed words of the whole text; the metadata view is naive Bayes over
language, source and length, with a count of its own for every value, however many there
are. Both start from the labelled rows. In each round each view gives labels to the
unlabelled rows it is most certain of, a share of them per class (`EXCHANGED`, dealt by
the classes' shares among the labels), and the *other* view learns from these and from the
labelled rows; all rows are looked at anew in each round. What a given label weighs
follows from how often the view is right, beyond chance, on labelled rows kept apart. At
the end each view is calibrated on those, and the calibrated views are combined: their
log-odds are added and the prior, which both hold, is taken off once.

The most certain rows are found by counted quantiles: margins fall into bins of width
`BIN`, whose counts (some thousand numbers) reach the driver; within the last bin a hash
of the id decides. Newton's method fits the text view: a task sums its rows' gradients
and curvatures, and only the sums reach the driver. The metadata view is fitted by one
grouping per round, joined back by value. No rows are sampled.

Defined cases: a null or empty text has all features 0; null metadata is a value of its
own, a value without labels says nothing; numbers count by half powers of two; without
labels of both kinds every score is the smoothed share of good labels (2/3 without
labels); null labels are none, repeated labels count as their smallest; repeated rows get
a score each; a metadata column that is missing is left out, and a view that is always of
one mind gives labels of no weight; an empty table gives an empty table.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.shingles import slices, word_hashes
from docweave.session import spread_if_few, stage

ROUNDS = 3
NEWTON_STEPS = 4
#: Share of the unlabelled rows a view gives labels to in a round; what such a label
#: weighs at most.
EXCHANGED = 0.25
PSEUDO_WEIGHT = 0.3
#: Width of the bins that margins (-30 to 30) are counted in.
BIN = 0.01
RIDGE, WORD_RIDGE = 1.0, 10.0
#: Hashed words of the text view.
WORDS = 128
#: Labels at the prior that every metadata value starts with.
SMOOTHING = 10.0

SHAPES = ("upper", "digits", "symbols", "marks", "blanks", "lines", "wide",
          "word_length", "log_words", "same_words", "distinct", "short_words", "long_words")


def _byte_classes():
    kinds = np.zeros((7, 256), dtype=np.float32)
    for i, chars in enumerate((range(65, 91), range(48, 58), b"#*$%&|<>", b".,;:!?'\"()-", b" \t\x0b\x0c\r",
                               b"\n", range(128, 256))):
        kinds[i, list(chars)] = 1
    return kinds


_KINDS = _byte_classes()


def text_features(texts):
    """A row per text: SHAPES, then roots of the frequencies of WORDS hashed words."""
    out = np.zeros((len(texts), len(SHAPES) + WORDS))
    for first, part in slices(texts):
        encoded = [t.encode("utf-8") if t else b"" for t in part]
        lengths = np.array([len(e) for e in encoded])
        held = np.flatnonzero(lengths)
        if not len(held):
            continue
        raw = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        starts = (np.cumsum(lengths) - lengths)[held]
        rows = out[first:first + len(part)]
        for i in range(len(_KINDS)):
            rows[held, i] = np.add.reduceat(_KINDS[i][raw], starts, dtype=np.float64) / lengths[held]
        words, bounds = word_hashes(part)
        counts = np.diff(bounds)
        some = np.flatnonzero(counts)
        if not len(some):
            continue
        n = counts[some]
        same = np.append(words[1:] == words[:-1], False).astype(np.float64)
        same[bounds[1:][some] - 1] = 0
        letters = lengths[some] * (1 - rows[some, 4] - rows[some, 5])
        rows[some, 7] = letters / n / 10
        rows[some, 8] = np.log1p(n) / 10
        rows[some, 9] = np.add.reduceat(same, bounds[:-1][some]) / n
        rows[some, 10] = [len(np.unique(words[bounds[i]:bounds[i + 1]])) / counts[i] for i in some]
        rows[some, 11] = letters / n < 3
        rows[some, 12] = letters / n > 12
        place = np.repeat(np.arange(len(part)) * WORDS, counts) + (words % np.uint64(WORDS)).astype(np.int64)
        found = np.bincount(place, minlength=len(part) * WORDS).reshape(len(part), WORDS)
        rows[some, len(SHAPES):] = np.sqrt(found[some] / n[:, None])
    return out


def _with_features(batches):
    """d, text, values... -> d, values..., text features."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = text_features([value.as_py() for value in batch.column(1)])
        offsets = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(rows.ravel().astype(np.float32)))
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], lists], names=[names[0], *names[2:], "t"])


class TextView:
    """Standardised linear model of the text features."""

    def __init__(self, mean, scale):
        self.mean, self.scale = mean, scale
        self.w = np.zeros(len(mean) + 1)

    def design(self, rows):
        return np.hstack([np.ones((len(rows), 1)), (rows - self.mean) / self.scale])

    def margin(self, rows):
        return np.clip(self.design(rows) @ self.w, -30, 30)


class Certain:
    """Which margins are among the most certain of each class, and what they weigh.

    `counts` holds (bin, kind, rows): kind -1 for unlabelled rows, 0 or 1 for labelled
    rows kept apart."""

    def __init__(self, counts, share, exchanged=EXCHANGED):
        tables = {kind: {} for kind in (-1, 0, 1)}
        for at, kind, n in counts:
            tables[kind][at] = n
        total = sum(tables[-1].values())
        self.cut, self.part, self.weight, self.given = {}, {}, {}, {}
        for label, chance in ((1, share), (0, 1 - share)):
            wanted, taken = exchanged * chance * total, 0.0
            self.cut[label], self.part[label] = (1e9 if label else -1e9), 0.0
            for at in sorted(tables[-1], reverse=label == 1):
                n = tables[-1][at]
                self.cut[label], self.part[label] = at, min(1.0, (wanted - taken) / n)
                taken += n
                if taken >= wanted:
                    break
            self.given[label] = min(wanted, taken)
            right, seen = (sum(n * self._within(at, label) for at, n in tables[k].items()) for k in (label, 1 - label))
            rate = (right + 2 * chance) / (right + seen + 2)
            self.weight[label] = PSEUDO_WEIGHT * max(0.0, (rate - chance) / (1 - chance))

    def _within(self, at, label):
        """Share of a bin's rows that get the label."""
        if at == self.cut[label]:
            return self.part[label]
        return float(at > self.cut[1] if label else at < self.cut[0])

    def labels(self, bins, unit):
        """Label and weight of each row; weight 0 where the view is not certain."""
        good = (bins > self.cut[1]) | ((bins == self.cut[1]) & (unit < self.part[1]))
        bad = (bins < self.cut[0]) | ((bins == self.cut[0]) & (unit >= 1 - self.part[0]))
        return good.astype(np.float64), np.where(good, self.weight[1], np.where(bad, self.weight[0], 0.0))


def bins(margins):
    return np.floor(np.asarray(margins) / BIN).astype(np.int64)


def _chance(margin):
    return 1 / (1 + np.exp(-margin))


def _lists(column):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _floats(column):
    return np.array([np.nan if v is None else float(v) for v in column.to_pylist()])


def _sums(values):
    return pa.RecordBatch.from_arrays([pa.array([values.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])


def _total(rows, function):
    """Sums over all tasks, added in the cluster."""
    flat = rows.mapInArrow(function, "sums array<double>").select(F.posexplode("sums").alias("at", "x"))
    table = flat.groupBy("at").agg(F.sum("x").alias("x")).toPandas()
    return table.sort_values("at")["x"].to_numpy()


def _moments(batches):
    held = 0.0
    for batch in batches:
        rows = _lists(batch.column(0))
        held = held + np.concatenate([[len(rows)], rows.sum(axis=0), (rows ** 2).sum(axis=0)])
    if np.ndim(held):
        yield _sums(held)


def newton_sums(xs, w, y, weight):
    """Gradient and curvature of weighted rows."""
    p = _chance(np.clip(xs @ w, -30, 30))
    curve = weight * np.maximum(p * (1 - p), 1e-6)
    return np.concatenate([xs.T @ (weight * (y - p)), ((xs.T * curve) @ xs).ravel()])


def newton_move(w, sums):
    d = len(w)
    penalty = np.full(d, WORD_RIDGE)
    penalty[:1 + len(SHAPES)] = RIDGE
    penalty[0] = 1e-3
    move = np.linalg.solve(sums[d:].reshape(d, d) + np.diag(penalty), sums[:d] - penalty * w)
    return w + move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-9))


def _training(view, certain):
    """(t, label, apart, u, m) -> sums of the text view, taught by labels and metadata."""
    def run(batches):
        held = 0.0
        for batch in batches:
            label, apart = _floats(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
            y, weight = np.nan_to_num(label), np.where(np.isnan(label) | apart, 0.0, 1.0)
            if certain is not None:
                given, weighs = certain.labels(bins(_floats(batch.column(4))), _floats(batch.column(3)))
                y, weight = np.where(np.isnan(label), given, y), np.where(np.isnan(label), weighs, weight)
            keep = weight > 0
            held = held + newton_sums(view.design(_lists(batch.column(0))[keep]), view.w, y[keep], weight[keep])
        if np.ndim(held):
            yield _sums(held)
    return run


def _with_margin(view):
    """t, others... -> others..., margin of the text view."""
    def run(batches):
        for batch in batches:
            margin = view.margin(_lists(batch.column(0)))
            names = batch.schema.names[1:]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(margin)], names=[*names, "x"])
    return run


def _text_margins(rows, view, *others):
    """`others` and the margin x of the text view."""
    chosen = rows.select("t", *others)
    schema = T.StructType([*chosen.schema.fields[1:], T.StructField("x", T.DoubleType())])
    return chosen.mapInArrow(_with_margin(view), schema)


def _counted(margins):
    """Rows (x, label, apart) by bin and kind, for `Certain`."""
    kind = F.when(F.col("label").isNull(), -1).otherwise(F.col("label"))
    kept = margins.where("label is null or apart").select(F.floor(F.col("x") / BIN).alias("bin"), kind.alias("kind"))
    return [tuple(r) for r in kept.groupBy("bin", "kind").count().collect()]


def _meta_value(column, kind):
    """A metadata value as text: null apart, numbers by half powers of two."""
    if isinstance(kind, T.NumericType):
        number = F.col(column).cast("double")
        size = F.floor(2 * F.log2(1 + F.abs(number))) * F.signum(number)
        text = F.when(F.isnan(number), "nan").otherwise(size.cast("string"))
    else:
        text = F.col(column).cast("string")
    return F.coalesce(F.concat(F.lit("="), text), F.lit(""))


def _fit_metadata(taught, values, share):
    """Per metadata column the log-odds of each value, beyond the prior; staged."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(v).alias("value")) for i, v in enumerate(values)]))
    counted = taught.select(pairs.alias("p"), "y", "weight").groupBy("p.i", "p.value").agg(
        F.sum(F.col("weight") * F.col("y")).alias("good"), F.sum(F.col("weight") * (1 - F.col("y"))).alias("bad"))
    odds = F.ln((F.col("good") + SMOOTHING * share) / (F.col("bad") + SMOOTHING * (1 - share)))
    return stage(counted.select("i", "value", (odds - float(np.log(share / (1 - share)))).alias("w")), "cotrain-values")


def _with_metadata(rows, weights, values, prior):
    """`rows` with the margin m of the metadata view."""
    found = []
    for i, name in enumerate(values if weights is not None else []):
        own = weights.where(F.col("i") == i).select(F.col("value").alias(f"value_{i}"), F.col("w").alias(f"w_{i}"))
        rows = rows.join(own, F.col(name) == F.col(f"value_{i}"), "left")
        found.append(F.coalesce(f"w_{i}", F.lit(0.0)))
    m = sum(found, F.lit(prior))
    return rows.withColumn("m", F.greatest(F.lit(-30.0), F.least(F.lit(30.0), m)))


def _calibration(lines):
    """(x, m, label) -> sums for the two lines."""
    def run(batches):
        held = 0.0
        for batch in batches:
            y = _floats(batch.column(2))
            held = held + np.concatenate([newton_sums(np.column_stack([np.ones(len(y)), _floats(batch.column(at))]),
                                                      line, y, np.ones(len(y))) for at, line in enumerate(lines)])
        if np.ndim(held):
            yield _sums(held)
    return run


def calibration_move(line, sums):
    """Drawn towards the margin as it is where there is little to go by."""
    grad = sums[:2] + np.array([0.0, 1.0 - line[1]])
    return line + np.clip(np.linalg.solve(sums[2:].reshape(2, 2) + np.diag([1e-3, 1.0]), grad), -5, 5)


def score(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", metadata=("lang", "source", "n_chars"),
          label="quality", rounds=ROUNDS, log=None) -> DataFrame:
    """doc_id, text_score, meta_score and score (0 to 1: the higher, the better) for every
    row of `docs`. `labels` holds the rows that may be learnt from (doc_id, label 0/1);
    a quarter of them, by hash of the id, serves calibration. A list given as `log` gets
    the two `Certain` (text, metadata) of each round."""
    metadata = [c for c in metadata if c in docs.columns]
    values = [f"v{i}" for i in range(len(metadata))]
    source = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text"), *[
        _meta_value(c, docs.schema[c].dataType).alias(v) for c, v in zip(metadata, values)])
    made = T.StructType([source.schema["d"], *[source.schema[v] for v in values],
                         T.StructField("t", T.ArrayType(T.FloatType()))])
    plain = spread_if_few(source, "d").mapInArrow(_with_features, made)
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("label_id")).agg((F.min(F.col(label)) == 1).cast("int").alias("label"))
    rows = stage(plain.join(marks, F.col("d") == F.col("label_id"), "left").select(
        "d", *values, "t", "label",
        ((F.pmod(F.xxhash64("d", F.lit(5)), F.lit(4)) == 0) & F.col("label").isNotNull()).alias("apart"),
        (F.pmod(F.xxhash64("d", F.lit(17)), F.lit(1_000_003)) / 1_000_003.0).alias("u")), "cotrain-rows")

    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect() if r["label"] is not None}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    share = (good + 2) / (good + bad + 3)
    prior = float(np.log(share / (1 - share)))
    d = len(SHAPES) + WORDS
    view, weights, lines = TextView(np.zeros(d), np.ones(d)), None, [np.array([0.0, 1.0])] * 2
    view.w[0] = prior
    if good and bad:
        sums = _total(rows.select("t"), _moments)
        view.mean = sums[1:1 + d] / sums[0]
        view.scale = np.sqrt(np.maximum(sums[1 + d:] / sums[0] - view.mean ** 2, 1e-8))
        view.w[0] = 0.0
        by_text = by_meta = None
        for this in range(rounds + 1):
            taught = rows.where("label is not null and not apart").select(
                *values, F.col("label").cast("double").alias("y"), F.lit(1.0).alias("weight"))
            if this:
                by_text = Certain(_counted(_text_margins(rows, view, "label", "apart")), share)
                by_meta = Certain(_counted(_with_metadata(rows, weights, values, prior).select(
                    "label", "apart", F.col("m").alias("x"))), share)
                if log is not None:
                    log.append((by_text, by_meta))
                taught = taught.unionByName(_certain_rows(rows, view, by_text, values))
            met = _with_metadata(rows, weights, values, prior).select("t", "label", "apart", "u", "m")
            for _ in range(NEWTON_STEPS):
                view.w = newton_move(view.w, _total(met, _training(view, by_meta)))
            # The metadata view learns from the text view of the round before, as `taught` holds it.
            weights = _fit_metadata(taught, values, share) if values else None
        seen = _text_margins(_with_metadata(rows.where("apart"), weights, values, prior), view, "m", "label").select(
            "x", "m", "label")
        for _ in range(NEWTON_STEPS):
            sums = _total(seen, _calibration(lines))
            if len(sums):
                lines = [calibration_move(line, sums[6 * i:6 * i + 6]) for i, line in enumerate(lines)]
    both = _text_margins(_with_metadata(rows, weights, values, prior), view, "d", "m")

    def within(margin):
        return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), margin))

    def chance(margin):
        return 1 / (1 + F.exp(-margin))

    t, m = (within(F.col(c) * float(line[1]) + float(line[0])) for c, line in zip(("x", "m"), lines))
    return both.select(F.col("d").alias(doc_id), chance(t).alias("text_score"), chance(m).alias("meta_score"),
                       chance(within(t + m - prior)).alias("score"))


def _certain_rows(rows, view, certain, values):
    """Values, label and weight of the unlabelled rows the text view is certain of."""
    at = F.floor(F.col("x") / BIN)
    sure = {label: (at > certain.cut[1] if label else at < certain.cut[0]) | (
        (at == certain.cut[label]) & (F.col("u") < certain.part[1] if label else F.col("u") >= 1 - certain.part[0]))
        for label in (0, 1)}
    found = _text_margins(rows.where("label is null"), view, *values, "u")
    return found.where(sure[0] | sure[1]).select(
        *values, sure[1].cast("double").alias("y"),
        F.when(sure[1], certain.weight[1]).otherwise(certain.weight[0]).alias("weight"))
