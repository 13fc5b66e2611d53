"""Classifiers and the vector search: held-out accuracy, recall, odd rows."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docweave.llm import ann_forest, quality_cotrain, toxicity
from tests.llm.conftest import DOCS, documents

rng = random.Random(8)
PLAIN = ["the", "and", "river", "stone", "market", "letter", "winter", "garden", "is", "of", "silent", "paper", "été", "größe"]
BAD = ["idiotic", "scumbag", "wörthless"]


def prose(n):
    return " ".join(rng.choice(PLAIN) + rng.choice(["", "s", "ing", "er"]) for _ in range(n))


def toxic_table(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        words = prose(rng.randint(3, 200)).split()
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(2):
                words.insert(rng.randint(0, len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), "en", f"src{i % 3}", 1))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 5 <> 0"))
    out = toxicity.score(docs, model).join(labels, "doc_id").where("doc_id % 5 = 0").collect()
    assert all((r["score"] >= 0.5) == r["toxic"] for r in out)
    # A bounded fit serves as well, and does so alike each time.
    small = [toxicity.fit(docs, labels, max_rows=200, max_counted=40) for _ in range(2)]
    assert np.array_equal(small[0].weights, small[1].weights)
    out = toxicity.score(docs, small[0]).join(labels, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.5) == r["toxic"] for r in out]) > 0.97


def test_toxicity_reads_whole_texts_and_odd_rows(spark, empty):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels)
    long = prose(60000)
    odd = documents(spark, [None, "", " \n ", long, long + " scumbag idiotic", "scumbag idiotic " + long, "x", (6, "x")])
    scores = [r["score"] for r in toxicity.score(odd, model).orderBy("doc_id").collect()]
    assert max(scores[:4]) < 0.5 < min(scores[4:6]) and scores[0] == scores[1] and scores[6] == scores[7]
    assert all(0 <= s <= 1 for s in scores)
    clash = odd.withColumns({"score": F.lit("x"), "label": F.lit("y"), "label_id": F.lit(1)})
    assert toxicity.score(clash, toxicity.fit(clash, labels)).count() == 8
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_without_both_labels(spark, empty):
    docs, labels = toxic_table(spark, 40)
    for given, top in ((labels.limit(0), 0.5), (labels.where("toxic = 0"), 0.2), (labels.withColumn("toxic", F.lit(None).cast("int")), 0.5)):
        scores = [r["score"] for r in toxicity.score(docs, toxicity.fit(docs, given)).collect()]
        assert len(set(scores)) == 1 and scores[0] < top
    assert toxicity.score(docs, toxicity.fit(empty, labels)).count() == 40


def quality_table(spark, n=600):
    rows, labels = [], []
    for i in range(n):
        good = i % 5 != 0
        words = prose(rng.randint(20, 120)).split()
        if not good:
            words = rng.choice([[w + "$$$" for w in words], [w for w in words[:5] for _ in range(20)], [w.upper() + "!!" for w in words]])
        # The source tells something of the quality too.
        source = f"src{rng.randint(0, 3) if good or rng.random() < 0.3 else 9}"
        rows.append((i, " ".join(words), rng.choice(["en", "de", None]), source, len(words)))
        if i % 3:
            labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cotraining_on_rows_without_labels(spark):
    docs, labels = quality_table(spark)
    out = {r["doc_id"]: r for r in quality_cotrain.score(docs, labels).collect()}
    assert len(out) == 600
    unseen = [i for i in out if i % 3 == 0]
    assert np.mean([(out[i]["score"] >= 0.5) == (i % 5 != 0) for i in unseen]) > 0.97
    # The metadata view alone knows less, but something.
    meta = [out[i]["meta_score"] for i in unseen]
    assert np.mean([s for i, s in zip(unseen, meta) if i % 5]) > 0.1 + np.mean([s for i, s in zip(unseen, meta) if not i % 5])


def test_both_views_give_labels_of_both_classes(spark):
    docs, labels = quality_table(spark)
    log = []
    quality_cotrain.score(docs, labels, log=log)
    assert len(log) == quality_cotrain.ROUNDS
    for both in log:
        for certain in both:
            # Of 200 unlabelled rows a quarter, dealt by the classes' shares.
            assert abs(certain.given[1] - 40) < 3 and abs(certain.given[0] - 10) < 3
            assert certain.weight[0] > 0.01 and certain.weight[1] > 0.01


def plain_cotraining(rows, labels, unit, apart):
    """The rounds, row by row: ids -> (text, metadata, both) scores."""
    texts = quality_cotrain.text_features([r[1] for r in rows])
    mean, scale = texts.mean(axis=0), np.sqrt(np.maximum(texts.var(axis=0), 1e-8))
    xs = np.hstack([np.ones((len(rows), 1)), (texts - mean) / scale])
    ids = [r[0] for r in rows]
    values = [(str(r[2]), str(r[3]), int(np.floor(2 * np.log2(1 + r[4])))) for r in rows]
    n_good = sum(labels.values())
    share = (n_good + 2) / (len(labels) + 3)
    prior = np.log(share / (1 - share))
    learnt = [i for i in range(len(ids)) if ids[i] in labels and not apart[i]]
    free = [i for i in range(len(ids)) if ids[i] not in labels]
    kept = [i for i in range(len(ids)) if ids[i] in labels and apart[i]]
    ridge = np.array([1e-3] + [1.0] * len(quality_cotrain.SHAPES) + [10.0] * quality_cotrain.WORDS)

    def logistic(w, x, y, weight, ridge, towards):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = (x * (weight * (y - p))[:, None]).sum(axis=0) + ridge * (towards - w)
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        return np.linalg.solve(curve, grad)

    def certain(margin):
        place = [int(np.floor(m / 0.01)) for m in margin]
        out = {}
        for label, chance in ((1, share), (0, 1 - share)):
            sign = -1 if label else 1
            wanted, n = 0.25 * chance * len(free), 0
            for cut in sorted({place[i] for i in free}, key=lambda b: sign * b):
                inside = sum(place[i] == cut for i in free)
                part = min(1.0, (wanted - n) / inside)
                n += inside
                if n >= wanted:
                    break
            right = seen = 0.0
            for i in kept:
                w = part if place[i] == cut else float(sign * place[i] < sign * cut)
                right, seen = right + w * (labels[ids[i]] == label), seen + w
            rate = (right + 2 * chance) / (seen + 2)
            weight = 0.3 * max(0.0, (rate - chance) / (1 - chance))
            for i in free:
                u = unit[i] if label else 1 - unit[i]
                if sign * place[i] < sign * cut or (place[i] == cut and (u < part or (not label and u == part))):
                    out.setdefault(i, (label, weight))
        return out

    w, odds, t, m, by_meta = np.zeros(xs.shape[1]), None, None, None, {}
    for this in range(4):
        taught = [(i, labels[ids[i]], 1.0) for i in learnt]
        by_text = certain(t) if this else {}
        by_meta = certain(m) if this else {}
        for_text = taught + [(i, *g) for i, g in by_meta.items() if g[1] > 0]
        for_meta = taught + [(i, *g) for i, g in by_text.items()]
        at, y, weight = (np.array(c) for c in zip(*for_text))
        for _ in range(4):
            move = logistic(w, xs[at], y, weight, ridge, 0.0)
            w = w + move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
        counts = {}
        for i, label, weighs in for_meta:
            for j, value in enumerate(values[i]):
                pair = counts.setdefault((j, value), [0.0, 0.0])
                pair[label] += weighs
        odds = {k: np.log((g + 10 * share) / (b + 10 * (1 - share))) - prior for k, (b, g) in counts.items()}
        t = np.clip(xs @ w, -30, 30)
        m = np.array([np.clip(prior + sum(odds.get(pair, 0.0) for pair in enumerate(v)), -30, 30) for v in values])
    y = np.array([labels[ids[i]] for i in kept])
    margins = []
    for x in (t, m):
        line = np.array([0.0, 1.0])
        for _ in range(4):
            own = np.column_stack([np.ones(len(kept)), x[kept]])
            move = logistic(line, own, y, np.ones(len(y)), np.array([1e-3, 1.0]), np.array([line[0], 1.0]))
            line = line + np.clip(move, -5, 5)
        margins.append(np.clip(line[0] + line[1] * x, -30, 30))
    margins.append(np.clip(margins[0] + margins[1] - prior, -30, 30))
    return {i: tuple(float(1 / (1 + np.exp(-x[at]))) for x in margins) for at, i in enumerate(ids)}


def test_cotraining_equals_a_plain_loop(spark):
    docs, labels = quality_table(spark, 240)
    rows = docs.withColumns({
        "u": F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_003)) / 1_000_003.0,
        "apart": F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0}).orderBy("doc_id").collect()
    want = plain_cotraining([tuple(r)[:5] for r in rows], {r["doc_id"]: r["quality"] for r in labels.collect()},
                            [r["u"] for r in rows], [r["apart"] for r in rows])
    got = {r["doc_id"]: (r["text_score"], r["meta_score"], r["score"]) for r in quality_cotrain.score(docs, labels).collect()}
    assert got.keys() == want.keys()
    # Features are stored in single precision.
    assert max(abs(a - b) for i in want for a, b in zip(got[i], want[i])) < 2e-3


def test_cotraining_of_odd_tables(spark, empty):
    docs, labels = quality_table(spark, 60)
    odd = docs.unionByName(documents(spark, [None, "", "x", (0, "x")], first=900)).unionByName(
        spark.createDataFrame([(None, None, None, None, None)], DOCS))
    scores = [r["score"] for r in quality_cotrain.score(odd, labels).collect()]
    assert len(scores) == 65 and all(0 <= s <= 1 for s in scores)
    constant = quality_cotrain.score(docs, labels.limit(0)).select("score").distinct().collect()
    assert len(constant) == 1 and constant[0][0] > 0.5
    assert quality_cotrain.score(docs.select("doc_id", "text"), labels).count() == 60
    assert quality_cotrain.score(docs.withColumns({"t": F.lit(1), "label": F.lit(2)}), labels).count() == 60
    assert quality_cotrain.score(empty, labels).count() == 0


def vectors(n, dim=16, seed=1):
    return np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)


def embeddings(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows],
                                 "vec_id long, embedding array<float>")


def exact(rows, asked, k):
    ids, all_ = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in asked:
        scores = (all_ * np.asarray(v, dtype=np.float64)).sum(axis=1)
        out[i] = [(j, s) for s, j in sorted((-s, j) for j, s in zip(ids, scores) if j != i)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], -r["score"]))
    return out


def test_recall_and_scores(spark):
    rows = list(enumerate(vectors(4000) * np.linspace(0.5, 2, 4000)[:, None].astype(np.float32)))
    table = embeddings(spark, rows)
    got = found(ann_forest.search(table, table.where("vec_id % 100 = 0"), k=10))
    want = exact(rows, rows[::100], 10)
    assert got.keys() == want.keys()
    recall = np.mean([len({x for x, _ in got[q]} & {x for x, _ in want[q]}) / 10 for q in want])
    assert recall >= 0.9
    for q, hits in got.items():
        assert len(hits) == 10 and hits == sorted(hits, key=lambda h: (h[1], h[0]))
        assert all(dict(exact(rows, [rows[q]], 4000)[q])[j] == s for j, s in hits)


def test_small_tables_copies_and_ties_are_exact(spark):
    base = vectors(40, 6, 3)
    # Whole numbers make equal scores; a large group of copies; a copy of a query.
    rows = [(i, np.round(v * 2)) for i, v in enumerate(base) if np.round(v * 2).any()]
    rows += [(1000 + i, np.ones(6)) for i in range(300)] + [(2000, rows[0][1])]
    table = embeddings(spark, rows)
    asked = [r for r in rows if r[0] % 10 == 0]
    got = found(ann_forest.search(table, table.where("vec_id % 10 = 0"), k=20, bucket_rows=64))
    assert got == exact(rows, asked, 20)


def test_a_bucket_meets_its_queries_in_slices(monkeypatch):
    """Queries of one bucket beyond any number pass by in slices, with all their results."""
    index, asked = np.round(vectors(300, 4, 7) * 2), np.round(vectors(900, 4, 8) * 2)
    lists, leaves = pa.list_(pa.float32()), pa.list_(pa.int64())

    def batch(rows, first, asks):
        n = len(rows)
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array([5] * n, pa.int64()), "asked": pa.array([asks] * n),
            "id": pa.array(range(first, first + n), pa.int64()), "vector": pa.array(list(rows), lists),
            "leaf": pa.array([None if asks else i % 3 for i in range(n)], pa.int64()),
            "least": pa.array([None if asks else 1000 - i for i in range(first, first + n)], pa.int64()),
            "leaves": pa.array([[0, 1, 2] if asks else None] * n, leaves)})

    held, scored = [], []
    slices, exact_rows = ann_forest._Bucket.best, ann_forest._exact
    monkeypatch.setattr(ann_forest, "SLICE", 64)
    monkeypatch.setattr(ann_forest, "CELLS", 1000)
    monkeypatch.setattr(ann_forest._Bucket, "best", lambda own, part, keep: held.append(part.num_rows) or slices(own, part, keep))
    monkeypatch.setattr(ann_forest, "_exact", lambda q, v: scored.append(q.size) or exact_rows(q, v))
    made = list(ann_forest._search_buckets(5)([batch(index[:200], 0, False), batch(index[200:], 200, False),
                                               batch(asked[:500], 0, True), batch(asked[500:], 500, True)]))
    assert sum(held) == 900 and max(held) <= 64 and max(scored) <= 1000
    got = {q: (i, s) for b in made for q, i, s in zip(*(b.column(n).to_pylist() for n in ("q", "found", "scores")))}
    scores = asked.astype(np.float64) @ index.astype(np.float64).T
    for q in range(900):
        best = sorted(range(300), key=lambda i: (-scores[q, i], 1000 - i))[:5]
        assert got[q] == (best, [scores[q, i] for i in best])


def test_visits_are_written_in_parts(monkeypatch):
    monkeypatch.setattr(ann_forest, "VISITS", 50)
    rows = vectors(400, 4, 9).astype(np.float64)
    forest = ann_forest.Forest(rows, np.linalg.norm(rows, axis=1).max(), 2, 3, 1)
    sizes = np.bincount(forest.leaves(rows).ravel(), minlength=16)
    layout = ann_forest._Layout(sizes, 60, 2)
    shared = SimpleNamespace(value=(forest, layout, sizes, 500))
    batch = pa.RecordBatch.from_pydict({"c": pa.array(range(400), pa.int64()), "vector": pa.array(list(rows))})
    parts = list(ann_forest._visits(shared)([batch]))
    assert max(p.num_rows for p in parts) < 50 + layout.count
    visits = [v for p in parts for v in zip(p.column("q").to_pylist(), p.column("leaves").to_pylist())]
    seen = {q: sorted({x for i, leaves in visits if i == q for x in leaves}) for q in range(0, 400, 40)}
    shadows = forest.query_shadows(rows)
    assert seen == {q: sorted(forest.walk(shadows[q], sizes, 500)) for q in seen}


def test_vectors_that_take_no_part(spark):
    good = [(i, v) for i, v in enumerate(vectors(12, 4, 5))]
    bad = [(100, None), (110, [0, 0, 0, 0]), (120, [1, None, 0, 0]), (130, [float("nan"), 1, 1, 1]),
           (140, [float("inf"), 1, 1, 1]), (150, [1, 2]), (160, [])]
    table = embeddings(spark, good + bad + good[:2])
    got = found(ann_forest.search(table, table.where("vec_id % 10 = 0"), k=20))
    assert got == exact(good, [good[0], good[10]], 20)
    assert ann_forest.search(table.limit(0), table.limit(0)).count() == 0
    assert ann_forest.search(embeddings(spark, bad[:2]), embeddings(spark, bad[:2])).count() == 0
    one = embeddings(spark, good[:1])
    assert ann_forest.search(one, one).count() == 0
    more = table.withColumns({"id": F.lit("x"), "c": F.lit(1), "vector": F.lit(2)})
    assert found(ann_forest.search(more, more.where("vec_id = 0"), k=3)) == exact(good, [good[0]], 3)
