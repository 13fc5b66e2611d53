import hashlib
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from docweave.operators.chunking import chunk_documents, text_splitter
from docweave.operators.embedding import embed_rows, embed_text, hashing_model


def piece_by_piece(text, size, overlap, marks=("\n\n", "\n", " ")):
    """The splitting rule spelled out: every piece is looked at, one at a time."""
    out = []

    def join(pieces):
        window = []
        for piece in pieces:
            if window and sum(map(len, window)) + len(piece) > size:
                out.append("".join(window))
                while window and (sum(map(len, window)) > overlap
                                  or sum(map(len, window)) + len(piece) > size):
                    window.pop(0)
            window.append(piece)
        out.append("".join(window))

    def split(part, marks):
        marks = [m for i, m in enumerate(marks) if any(x in part for x in marks[:i + 1])]
        if marks:
            cuts = [m.start() for m in re.finditer(re.escape(marks[0]), part) if m.start()]
            pieces = [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])]
        else:
            pieces = list(part)
        good = []
        for piece in pieces:
            if len(piece) < size or not marks:
                good.append(piece)
            else:
                join(good)
                good = []
                split(piece, marks[1:])
        join(good)

    split(text, marks)
    return [chunk for chunk in map(str.strip, out) if chunk]


TEXTS = st.text(alphabet="abé́ \n", max_size=80) | st.lists(
    st.sampled_from(["word", " ", "\n", "\n\n", "x" * 15, "漢"]), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(2, 14), st.data())
def test_splitter_follows_the_rule(text, size, data):
    overlap = data.draw(st.sampled_from([0, 0, 1, size // 2, size - 1]))
    assert text_splitter(size, overlap)(text) == piece_by_piece(text, size, overlap)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 14))
def test_chunks_fit_and_lose_nothing(text, size):
    chunks = text_splitter(size)(text)
    assert all(0 < len(c) <= size for c in chunks)
    assert re.sub(r"\s", "", "".join(chunks)) == re.sub(r"\s", "", text)
    if len(text) <= size and text.strip():
        assert chunks == [text.strip()]


def test_blank_lines_break_first():
    text = "a" * 6 + "\n\n" + "b" * 6 + "\n" + "c" * 6
    # A separator counts with the piece it opens.
    assert text_splitter(15)(text) == ["a" * 6, "b" * 6 + "\n" + "c" * 6]
    assert text_splitter(14)(text) == ["a" * 6, "b" * 6, "c" * 6]


def test_splitter_arguments():
    for size, overlap in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            text_splitter(size, overlap)


def test_chunk_documents_keeps_rows_and_reports_errors(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b", "bad"), ("c", "   ")], "id string, content string")

    def splitter(text):
        if text == "bad":
            raise RuntimeError("no")
        return text.split()

    found = rows(chunk_documents(docs, splitter=splitter))
    assert found == [("a", 0, "one", None), ("a", 1, "two", None), ("b", 0, None, "RuntimeError: no")]


def slow_hash(text, dim):
    values = [0.0] * dim
    for word in re.findall("[a-z0-9]+", text.lower()):
        values[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim] += 1
    norm = math.sqrt(sum(v * v for v in values))
    return [v / norm for v in values] if norm else values


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_hashing_model(texts):
    got = hashing_model(16)()(texts)
    assert np.allclose(got, [slow_hash(t, 16) for t in texts])


def test_embedding_isolates_failures_and_checks_length(spark):
    def factory():
        def model(texts):
            if any(t == "bad" for t in texts):
                raise RuntimeError("no")
            return np.ones((len(texts), 3 if "long" not in texts else 4))
        return model

    docs = spark.createDataFrame([(1, "x"), (2, "bad"), (3, None), (4, "long")], "id int, text string")
    found = {r.id: r for r in embed_rows(docs, "text", factory, dim=3).collect()}
    assert list(found[1].embedding) == [1.0, 1.0, 1.0] and found[1].embedding_error is None
    assert found[2].embedding is None and found[2].embedding_error == "RuntimeError: no"
    assert found[3].embedding_error == "text is null"
    assert "shape" in found[4].embedding_error


def test_model_is_loaded_once_per_task(spark, tmp_path):
    marks = str(tmp_path)

    def factory():
        import tempfile
        tempfile.mkstemp(dir=marks)
        return lambda texts: np.zeros((len(texts), 2))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        embed_rows(spark.range(0, 100, 1, 2).selectExpr("string(id) text"), "text", factory, 2, 5).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(list(tmp_path.iterdir())) == 2


def test_query_text_matches_row_embedding(spark):
    row = embed_rows(spark.createDataFrame([("The cat",)], "t string"), "t", dim=32).first()
    assert list(row.embedding) == embed_text("the CAT!", dim=32)
