"""The pipeline against its stages done by plain Python, and the registered queries."""

import hashlib
import os
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare
from docweave.llm import bpe
from docweave.llm.queries import QUERIES
from docweave.llm.sql import ORACLE
from tests.llm.conftest import DOCS
from tests.llm.test_groups_and_mixing import plain_groups, plain_targets
from tests.llm.test_lines_and_rules import plain_dedup

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    verdict = compare(spark, SF_DIR, QUERIES[name], ORACLE.get(name))
    assert verdict.startswith("ok"), verdict


def order_hash(doc_id):
    return hashlib.md5(f"1:{doc_id}".encode()).hexdigest()[:15]


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_mix(rows):
    """(id, text, source) as often as the mix takes them."""
    sizes, by = {}, {}
    for i, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
        by.setdefault(source, []).append((order_hash(i), i, text))
    order = sorted((s for s in by if s is not None)) + [s for s in by if s is None]
    weights = {s: (5.0, 2.0, 1.0)[n % 3] for n, s in enumerate(order)}
    targets = plain_targets(sizes, weights, 1.5 * sum(sizes.values()), 2)
    out = []
    for source, own in by.items():
        whole = int(targets[source] // sizes[source]) if sizes[source] else 0
        rest, done = targets[source] - whole * sizes[source], 0
        for _, i, text in sorted(own):
            done += size_of(text)
            more = rest > 0 and done - size_of(text) / 2 <= rest
            out += [(i, text)] * (whole + more)
    return out


@needs_tables
def test_pipeline_matches_plain_stages(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = corpus_pipeline.toxicity_stage(spark, table, SF_DIR)
    assert clean.columns == table.columns
    rows = [(r["doc_id"], r["text"], r["source"]) for r in clean.orderBy("doc_id").collect()]
    sources = {i: s for i, _, s in rows}
    rows = [(i, text) for i, text, *_ in plain_dedup([(i, t) for i, t, _ in rows])]
    groups = plain_groups(rows, 5, 80, 100)
    rows = [(i, t, sources[i]) for i, t in rows if groups[i][2]]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    want = []
    for i, text in plain_mix(rows):
        ids = library.encode_ordinary(text)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    assert sorted(got) == sorted(want)


@needs_tables
def test_toxicity_stage_drops_toxic_documents_only(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    left = corpus_pipeline.toxicity_stage(spark, table, SF_DIR).join(labels, "doc_id").groupBy().agg(
        F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    clean = labels.where("toxic = 0").count()
    assert left["clean"] >= 0.98 * clean and left["toxic"] <= 0.3 * labels.where("toxic = 1").count()


def test_stages_of_odd_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    wide = DOCS + ", score string, repeats int, h1 long, missing string, ids_sha256 string"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "a b c d e f", "en", "a", 11),
            (4, "a b c d e f", "en", "b", 11), (4, "a b c d e f", "en", "b", 11), (None, "other words", "de", None, 1)]
    docs = spark.createDataFrame([(*r, "s", 1, 2, "m", "i") for r in rows], wide)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= 2 * table.count()
