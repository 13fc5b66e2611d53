import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from docweave.functions.vectors import COSINE, DOT, L2
from docweave.operators import search
from docweave.operators.search import ALL_NAMESPACES, knn_join, search_text


def table(spark, data):
    return spark.createDataFrame(
        data, "id string, embedding array<float>, content string, metadata map<string,string>, namespace string")


def small(spark):
    return table(spark, [
        ("a", [1.0, 0.0], "A", {"lang": "en"}, "n1"), ("b", [2.0, 0.0], "B", {"lang": "fr"}, "n1"),
        ("c", [0.0, 3.0], "C", {"lang": "en"}, "n1"), ("d", [9.0, 9.0], "D", {"lang": "en"}, "n2"),
        ("e", [1.0, 0.0], "E", None, "n1"), ("f", [1.0], "F", {"lang": "en"}, "n1"), ("g", None, "G", None, "n1"),
        ("h", [0.0, 0.0], "H", None, "default")])


def test_search_orders_and_breaks_ties_by_id(spark):
    found = search.search(small(spark), [1.0, 0.0], k=3, namespace="n1")
    assert [(r.id, r.score, r["rank"]) for r in found.orderBy("rank").collect()] == [
        ("b", 2.0, 1), ("a", 1.0, 2), ("e", 1.0, 3)]


def test_wrong_length_is_never_a_result(spark):
    found = search.search(small(spark), [1.0, 0.0], k=50, namespace="n1")
    assert sorted(r.id for r in found.collect()) == ["a", "b", "c", "e"]


def test_filters_metrics_and_default_namespace(spark):
    found = search.search(small(spark), [1.0, 0.0], 2, L2, ALL_NAMESPACES, {"lang": "en"})
    assert [(r.id, r.score) for r in found.orderBy("rank").collect()] == [("a", 0.0), ("c", 10.0)]
    cosine = search.search(small(spark), [1.0, 0.0], 1, COSINE, "n1").first()
    assert (cosine.id, cosine.score) == ("a", 1.0)
    assert [r.id for r in search.search(small(spark), [1.0, 0.0]).collect()] == ["h"]


def test_argument_guards(spark):
    vectors = small(spark)
    for bad in (lambda: search.search(vectors, [1.0], 0), lambda: search.search(vectors, []),
                lambda: search.search(vectors, [1.0], metric="other"),
                lambda: search.search(vectors, [1.0], namespace=" "),
                lambda: search_text(vectors, "  "),
                lambda: knn_join(vectors, vectors.limit(0).select(F.col("id").alias("query_id"), "embedding"))):
        with pytest.raises(ValueError):
            bad()


def test_search_plan(spark, tmp_path):
    path = str(tmp_path / "vectors")
    small(spark).write.partitionBy("namespace").parquet(path)
    stored = spark.read.schema(small(spark).schema).parquet(path)
    text = plan(search.search(stored, [1.0, 0.0], 2, namespace="n1"))
    assert "PartitionFilters: [isnotnull(namespace" in text and "TakeOrderedAndProject" in text


@pytest.mark.parametrize("metric", [DOT, COSINE, L2])
@pytest.mark.parametrize("limit", [search.BROADCAST_BYTES, 0])
def test_knn_join_matches_all_pairs(spark, monkeypatch, metric, limit):
    monkeypatch.setattr(search, "QUERY_BLOCK_BYTES", 5 * 4 * 8)
    monkeypatch.setattr(search, "ROW_BLOCK_BYTES", 60 * 4 * 8)
    monkeypatch.setattr(search, "SCORES_AT_ONCE", 100)
    rng = np.random.default_rng(3)
    # A third of the rows are copies of one vector: their scores tie.
    data = np.where(rng.random((300, 1)) < 0.33, np.ones((1, 4)), rng.normal(size=(300, 4))).astype("float32")
    asked = rng.normal(size=(12, 4)).astype("float32")
    vectors = spark.createDataFrame([(f"v{i}", v.tolist()) for i, v in enumerate(data)],
                                    "id string, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(asked)],
                                    "query_id string, embedding array<float>")
    found = knn_join(vectors, queries, 7, metric, broadcast_bytes=limit)
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in found.collect()}

    expected = {}
    for q, query in enumerate(asked.astype("float64")):
        scored = []
        for i, v in enumerate(data.astype("float64")):
            score = {DOT: v @ query, COSINE: v @ query / np.linalg.norm(v) / np.linalg.norm(query),
                     L2: ((v - query) ** 2).sum()}[metric]
            scored.append((round(score, 9) * (1 if metric == L2 else -1), f"v{i}", score))
        for rank, (_, name, score) in enumerate(sorted(scored)[:7], 1):
            expected[(f"q{q}", rank)] = (name, float(score))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    assert all(abs(got[k][1] - expected[k][1]) < 1e-9 for k in expected)


@pytest.mark.parametrize("metric", [DOT, COSINE, L2])
def test_small_gaps_decide(spark, metric):
    # Scores that differ by 1e-7, in the reverse order of the ids; very short vectors too.
    for scale in (1.0, 1e-8):
        data = [(f"v{9 - i}", [scale * (1 + i * (1e-7 if metric != COSINE else 0)), scale * (5 - i) * 1e-4]) for i in range(5)]
        vectors = spark.createDataFrame([(i, v, "", None, "n") for i, v in data], "id string, embedding array<double>, "
                                        "content string, metadata map<string,string>, namespace string")
        query = [2.0 * scale, 0.0]
        score = {DOT: lambda v: -v[0], COSINE: lambda v: -v[0] / np.hypot(*v),
                 L2: lambda v: (v[0] - query[0]) ** 2 + v[1] ** 2}[metric]
        want = [i for i, v in sorted(data, key=lambda d: score(d[1]))][:3]
        for parts in (1, 4):
            found = search.search(vectors.repartition(parts), query, 3, metric, "n").orderBy("rank").collect()
            assert [r.id for r in found] == want
            asked = spark.createDataFrame([("q", query)], "query_id string, embedding array<double>")
            joined = knn_join(vectors.repartition(parts), asked, 3, metric).orderBy("rank").collect()
            assert [(r.id, r.score) for r in joined] == [(r.id, r.score) for r in found]


def test_knn_join_plan_has_no_pairs(spark):
    vectors = small(spark).where("size(embedding) = 2")
    queries = vectors.select(F.col("id").alias("query_id"), "embedding")
    for limit in (search.BROADCAST_BYTES, 0):
        text = plan(knn_join(vectors, queries, 2, broadcast_bytes=limit))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
        assert "WindowGroupLimit" in text


def test_collection_search(spark):
    from docweave.operators.embedding import embed_rows
    docs = spark.createDataFrame([("1", "red house", "c", {"lang": "en"}), ("2", "red car", "c", {"lang": "fr"}),
                                  ("3", "red house", "d", None)],
                                 "id string, content string, namespace string, metadata map<string,string>")
    vectors = embed_rows(docs, "content", dim=64)
    found = search.search_collection(vectors, "a red house", "c", dim=64)
    assert [r.id for r in found.orderBy("rank").collect()] == ["1", "2"]
    assert [r.id for r in search.search_collection(vectors, "red", "c", filters={"lang": "fr"}, dim=64).collect()] == ["2"]
    assert found.orderBy("rank").first().score == 0 or found.orderBy("rank").first().score < found.agg(F.max("score")).first()[0]


def test_knn_scores_slices_of_queries_too(monkeypatch):
    import pyarrow as pa

    shapes, whole = [], search.score_matrix
    monkeypatch.setattr(search, "score_matrix", lambda m, a, b: shapes.append((len(a), len(b))) or whole(m, a, b))
    data = np.random.default_rng(5).normal(size=(3000, 8))
    data[7] = np.inf
    data[::3] = data[0]
    column = pa.array(data.tolist(), pa.list_(pa.float64()))
    best = search._Best(DOT, 5, 2999)
    search._scan(best, DOT, pa.array([f"v{i}" for i in range(3000)]), column, data[8:9].repeat(2999, axis=0))
    assert max(min(shape) for shape in shapes) <= 1024 and min(max(shape) for shape in shapes) > 65
    found = best.table([str(i) for i in range(2999)]).to_pydict()
    scores = (data * data[8]).sum(axis=1)
    want = sorted((-s, f"v{i}") for i, s in enumerate(scores) if s == s and s != -np.inf)[:5]
    assert found["id"] == [name for _, name in want] * 2999
