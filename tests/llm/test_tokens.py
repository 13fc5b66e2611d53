"""Token ids and counts against the tokenizer libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from docweave.llm import bpe
from docweave.llm.queries import QUERIES
from docweave.llm.unigram_count import Counter, count_tokens, read_pieces
from tests.llm.conftest import documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

random_ = random.Random(5)
LETTERS = "aeénrstÄ日本🙂 \n\t'0.ß▁ <0x>"
TEXTS = [None, "", " ", "\n\n", "a", "  two  blanks ", "it's we'll I'd", "line one\nline two\n\nline three",
         "a" * 3000, "ab" * 2000, "<|endoftext|> <s> <0x0A>", "tab\tand\rreturn\x1c\x85", "word " * 500,
         *["".join(random_.choice(LETTERS) for _ in range(random_.randint(0, 120))) for _ in range(400)]]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_replay_matches_the_library(library):
    want = [library.encode_ordinary(t or "") for t in TEXTS]
    for limits in ({}, {"known_words": 20, "block_chars": 100}):
        coder = bpe.Coder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN, **limits)
        assert list(coder.encode(TEXTS)) == want


def test_merges_of_lower_rank_come_first(monkeypatch):
    # "bc" makes a pair of lower rank with what stands before it; overlapping places too.
    tokens = [bytes([b]) for b in range(256)]
    tokens += [b"abc", b"bc", b"aa", b"aaa", b"cab", b"abcabc", b"ab"]
    ranks = {t: i for i, t in enumerate(tokens)}
    library = tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    words = ["".join(random_.choice("abc") for _ in range(random_.randint(1, 12))) for _ in range(3000)]
    want = [library.encode_ordinary(w) for w in words]
    for many in (1, 48, 10**9):
        monkeypatch.setattr(bpe, "MANY", many)
        assert bpe.Replay(ranks).encode([w.encode() for w in words]) == want


def test_digests_and_round_trip(spark, library):
    docs = documents(spark, TEXTS)
    out = bpe.token_digests(docs, RANKS, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    for row, text in zip(out, TEXTS, strict=True):
        ids = library.encode_ordinary(text or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(coded, RANKS).where(~F.coalesce("text", F.lit("")).eqNullSafe(F.col("decoded").cast("string")))
    assert back.count() == 0


def test_digests_keep_other_columns(spark, empty):
    docs = documents(spark, ["one", "one"]).withColumn("n_tokens", F.lit("old")).withColumn("0", F.lit(3))
    out = bpe.token_digests(docs, RANKS, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "0", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert [r["n_tokens"] for r in out.collect()] == [1, 1]
    assert bpe.token_digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_digests_without_texts(spark, empty):
    # Texts in the result of the tasks' Python are a second copy of each batch.
    docs = documents(spark, TEXTS).select("lang", "text", "doc_id")
    whole = bpe.token_digests(docs, RANKS, public_tokenizers.PATTERN)
    out = bpe.token_digests(docs, RANKS, public_tokenizers.PATTERN, keep_text=False)
    assert out.columns == ["lang", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(out.collect()) == sorted(whole.select(*out.columns).collect())
    assert bpe.token_digests(empty, RANKS, public_tokenizers.PATTERN, keep_text=False).count() == 0
    only = bpe.token_digests(docs.select("text"), RANKS, public_tokenizers.PATTERN, key="text", keep_text=False)
    assert only.columns == ["n_tokens", "ids_sha256", "decoded_sha256"] and only.count() == len(TEXTS)


def from_python(made):
    """Types of the columns that come back from the Python of each map step."""
    plan, steps = made._jdf.queryExecution().analyzed(), []
    while plan.children().nonEmpty():
        if "MapInArrow" in plan.nodeName():
            steps.append([plan.output().apply(i).dataType().simpleString() for i in range(plan.output().size())])
        plan = plan.children().head()
    return steps


def test_token_queries_get_no_texts_from_python(spark, tmp_path):
    docs = documents(spark, ["one two", None, "three"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for made in (QUERIES["op6_byte_bpe"](spark, str(tmp_path)), corpus_pipeline.token_stage(spark, docs, str(tmp_path))):
        assert from_python(made) == [["bigint", "bigint", "string", "string"]]
        assert made.count() == 3


def reference(pieces, by_bytes, split=True):
    made = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=by_bytes))
    made.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=split)
    return lambda text: len(made.encode(text, add_special_tokens=False).ids)


def test_counts_match_the_library():
    pieces = read_pieces(PIECES)
    tied = [(piece, float(round(score))) for piece, score in pieces]
    for vocabulary, by_bytes in ((pieces, True), (tied, True), ([("<unk>", 0.0), *tied[400:6000]], False)):
        count, counter = reference(vocabulary, by_bytes), Counter(vocabulary, known_words=30)
        for text in TEXTS:
            assert counter.count(text) == (count(text) if text else 0), text


def test_runs_of_blanks_match_the_library(spark):
    pieces = read_pieces(PIECES)
    assert any(piece.startswith("▁▁") for piece, _ in pieces)
    code = ["def f(x):\n    if x:\n        return  x\n", "a" + " " * 16 + "b", " " * 5, "    a", "a   ", " ▁ x", "a  " * 200]
    across = [*pieces, ("e▁t", -3.0), ("▁two▁▁b", -4.0)]
    no_mark = [("<unk>", 0.0), *[(p, s) for p, s in pieces[400:6000] if "▁" not in p]]
    for vocabulary, by_bytes in ((pieces, True), (across, True), (no_mark, False)):
        count, counter = reference(vocabulary, by_bytes, False), Counter(vocabulary, known_words=30, split=False)
        for text in TEXTS + code:
            assert counter.count(text) == (count(text) if text else 0), text
    count = reference(pieces, True, False)
    got = count_tokens(documents(spark, code), pieces, split=False).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == [count(t) for t in code]


def test_counts_in_spark(spark, empty):
    pieces = read_pieces(PIECES)
    count = reference(pieces, True)
    docs = documents(spark, TEXTS)
    got = [r["n_tokens"] for r in count_tokens(docs, pieces).orderBy("doc_id").collect()]
    assert got == [count(t) if t else 0 for t in TEXTS]
    assert count_tokens(docs.withColumn("n_tokens", F.lit("x")), pieces).schema["n_tokens"].dataType.typeName() == "long"
    assert count_tokens(empty, pieces).count() == 0
