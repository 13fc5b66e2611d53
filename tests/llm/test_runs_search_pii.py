"""Periodic runs, ranked search and personal data against plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from docweave.llm import pii
from docweave.llm.lexical_search import ROUNDS, build_index, search
from docweave.llm.periodic_runs import collapse_runs, find_runs, words_of
from docweave.llm.queries import with_repeats
from tests.llm.conftest import documents


def plain_runs(words, min_length=24, min_periods=3):
    """Every period tried on its own; of one stretch the smallest period counts."""
    n, found = len(words), {}
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(min_length, min_periods * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def odd_words(rng):
    letters, words = rng.choice([1, 2, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.6:
            period = [rng.randrange(letters) for _ in range(rng.randint(1, 40))]
            if rng.random() < 0.4:  # a period that is nearly periodic itself
                period = (period[:rng.randint(1, 5)] * 30)[:rng.randint(4, 40)] + period[:2]
            words += (period * 200)[:rng.randint(1, 120)]
        else:
            words += [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
    return [b"%d" % w for w in words]


def test_runs_of_random_words():
    rng = random.Random(11)
    for _ in range(150):
        texts = [odd_words(rng) for _ in range(rng.randint(0, 5))]
        texts += texts[:rng.randint(0, 2)]  # copies side by side
        assert find_runs(texts) == [plain_runs(t) for t in texts]


def test_runs_of_a_long_text():
    # 60,000 words of one period, one word, and a period within a period.
    words = [b"%d" % (i % 700) for i in range(60_000)] + [b"x"] * 5_000 + [b"a", b"a", b"b"] * 4_000
    assert find_runs([words]) == [[(0, 60_000, 700), (60_000, 5_000, 1), (65_000, 12_000, 3)]]


def test_collapsed_texts(spark, empty):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a b\tc " * 10 + "\u00a0end"), (5, "a b c " * 7), (6, "p " * 23 + "q"), (6, "p " * 24)]
    docs = documents(spark, rows).selectExpr("*", "'mine' as n_runs", "1 as `0`")
    out = {(r["doc_id"], r["collapsed"]): r for r in collapse_runs(docs).collect()}
    # 21 words of three periods and more are too few for a run.
    assert set(out) == {(1, ""), (2, ""), (3, ""), (4, "a b c \u00a0end"), (5, " ".join(["a b c"] * 7)),
                        (6, "p " * 23 + "q"), (6, "p")}
    assert out[4, "a b c \u00a0end"]["strongest"].asDict() == {"start": 0, "length": 30, "period": 3}
    assert out[6, "p"]["n_runs"] == 1 and out[6, "p"]["runs"][0]["length"] == 24
    assert [r["n_runs"] for (i, _), r in out.items() if i in (1, 2, 3)] == [0, 0, 0]
    assert collapse_runs(empty).count() == 0


def test_planted_repeats(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randint(0, 90))) for _ in range(120)] + [None]
    got = {r["doc_id"]: r["text"] for r in with_repeats(documents(spark, texts)).collect()}
    changed = 0
    for i, text in enumerate(texts):
        h = zlib.crc32(str(i).encode())
        words = (text or "").split()
        if h % 10 or not words:
            assert (got[i] or "") == (text or "")
            continue
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert got[i].split() == [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        changed += 1
    assert changed > 3


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, k=10):
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, all_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, c in counts:
            if i is None or not c:
                continue
            m = 25 + (75 * c.total() * n_docs) // all_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in asked.items() if c[t])
            if score > 0:
                scores.append((-score, i))
        out += [(item, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_search_equals_scoring_all(spark):
    rng = random.Random(7)
    words = [f"wörd{j}" if j % 3 else f"W{j}" for j in range(300)]

    def text(n):
        return rng.choice([" ", ", ", "-"]).join(rng.choice(words[:rng.choice([5, 40, 300])]) for _ in range(n))

    rows = [(i, text(rng.choice([0, 1, 5, 30, 200]))) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # equal scores beyond the first round
    rows += [(2000, None), (2001, "..."), (None, rows[7][1]), (3, text(40)), (3, text(40)), (2002, "w1 " * 5000 + text(4000))]
    items = [(j, text(rng.randint(1, 40))) for j in range(12)] + [(50, None), (51, "?!"), (52, "nowhere"), (53, rows[7][1])]
    docs, asked = documents(spark, rows), spark.createDataFrame(items, "item_id int, text string")
    got = sorted(tuple(r) for r in search(docs, asked).select("item_id", "rank", "doc_id", "score").collect())
    assert got == plain_search(rows, items)
    few = sorted(tuple(r) for r in search(docs, asked, k=3, rounds=(1, 2)).select("item_id", "rank", "doc_id", "score").collect())
    assert few == plain_search(rows, items, 3)


def test_searches_of_blocks(spark, monkeypatch):
    from docweave.llm import lexical_search

    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 3)
    rows = [(i, f"a{i % 5} b{i % 3} c") for i in range(30)]
    items = [("x", "a1 b1"), ("x", "a2 c"), ("y", "a0 a1 a2 a3 b0"), ("z", "c")]
    docs, asked = documents(spark, rows), spark.createDataFrame(items, "item_id string, text string")
    got = sorted(tuple(r) for r in search(docs, asked, k=4).select("item_id", "rank", "doc_id", "score").collect())
    assert got == sorted(plain_search(rows, items, 4))


def test_terms_of_queries_are_counted_while_the_index_is_built(spark, monkeypatch):
    from docweave.llm import lexical_search

    rows = [(i, f"a{i % 5} b{i % 3} É{i % 4} c" + " a1" * (i % 7 == 0)) for i in range(40)]
    rows += [(None, "a1 a1 c"), (3, "A3-b0_c"), (3, "A3-b0_c"), (90, None), (91, ""), (92, "\x00 \x7f\u00a0?\u2028 b1")]
    items = [("x", "A1 b1 a1"), ("x", "É2 É2 nowhere"), ("y", None), (None, "c\u00a0 b2"), ("z", "\u00a0?"), ("z", "a3,b0")]
    docs, asked = documents(spark, rows), spark.createDataFrame(items, "item_id string, text string")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def found(**more):
        got = search(docs.mapInArrow(counted, docs.schema), asked, k=4, **more)
        return sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str)

    want = sorted(plain_search(rows, [i for i in items if i[0]], 4) + [
        (None, *r[1:]) for r in plain_search(rows, [("none", items[3][1])], 4)], key=str)
    # The index and the exact scores read the documents, one pass each; nothing is left after the first round.
    assert found() == want and read.value == 2 * len(rows)
    index = build_index(docs)
    assert index.columns == ["d", "n_terms", "width", "sketch"] and found(index=index) == want
    monkeypatch.setattr(lexical_search, "HELD_TERMS", 3)
    monkeypatch.setattr(lexical_search, "FOLDED", 7)
    assert found() == want


def test_searches_of_nothing(spark, empty):
    asked = spark.createDataFrame([(1, "a")], "item_id int, text string")
    docs = documents(spark, ["a b", "b"])
    assert search(empty, asked).count() == 0
    assert search(docs, asked.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in search(docs.selectExpr("*", "1 as d", "2 as q", "3 as item"), asked).collect()] == [(1, 1, 0)]
    assert {r["n_terms"] for r in build_index(docs).collect()} == {1, 2} and ROUNDS[0] >= 10


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plain_base(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c not in " -"][::-1]
        if 13 <= len(digits) <= 19 and sum(sum(divmod(2 * d, 10)) if j % 2 else d for j, d in enumerate(digits)) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return sorted(out)


def test_base_spans():
    rng = random.Random(2)
    for _ in range(30_000):
        text = "".join(rng.choice("0123+()-.. @ab%12é٣\n") for _ in range(rng.randint(0, 60)))
        assert pii.find_base(text) == plain_base(text), text
    long_ = "7" * 200_000 + "a" * 200_000 + "@" + "1." * 50_000 + " 4111 1111 1111 1111 x@y.de"
    assert [long_[s:e] for k, s, e in pii.find_base(long_) if k in (0, 2)][-2:] == ["x@y.de", "4111 1111 1111 1111"]


def test_estimates_tell_labelers_apart():
    rng, counts = random.Random(1), Counter()
    right = (0.95, 0.9, 0.6, 0.85, 0.5)  # the last one guesses
    truth = Counter()
    for _ in range(6000):
        y = rng.random() < 0.7
        votes = tuple((1 if (rng.random() < r) == y else -1) if rng.random() < 0.8 else 0 for r in right)
        counts[votes] += 1
        truth[votes, y] += 1
    p = pii.estimate(counts)
    hits = sum(n for (votes, y), n in truth.items() if (p[votes] >= 0.5) == y)
    assert hits / 6000 > 0.93
    assert p[1, 1, 0, 1, -1] > 0.9 and p[-1, -1, 0, -1, 1] < 0.1


@pytest.fixture(scope="module")
def taught(spark):
    rng = random.Random(9)

    def phone():
        return f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"

    def card():
        head = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
        return next(head + str(d) for d in range(10) if pii.passes_luhn(head + str(d)))

    texts = [f"word {rng.choice(['and', 'of'])} {phone()} more" for _ in range(80)]
    texts += [f"word of {card()} more. Write to ann.{i}@mail.example.com from 10.2.{i}.4 now" for i in range(80)]
    texts += [f'token = "ab{rng.randrange(10**14, 10**15)}cd" is none' for _ in range(30)]
    fused, held = f"und {phone()} {card()} ende", card()
    texts += [fused, f"{held} 27.65.93.188 da"]
    docs = documents(spark, texts)
    return docs, pii.fit(docs), texts


def test_added_spans(taught):
    docs, model, texts = taught
    out = {r["doc_id"]: r for r in pii.mark(docs, model).collect()}
    fused = out[len(texts) - 2]
    assert fused["base_spans"] == [] and [s["kind"] for s in fused["spans"]] == ["card", "phone"]
    assert fused["redacted"] == "und [PHONE] [CARD] ende"
    assert out[len(texts) - 1]["redacted"] == "[CARD] [IP] da"
    for i, text in enumerate(texts):
        base = [(pii.KINDS[k], s, e) for k, s, e in plain_base(text)]
        assert [tuple(s) for s in out[i]["base_spans"]] == base
        assert set(base) <= {tuple(s) for s in out[i]["spans"]}
        if text.startswith("token"):
            assert out[i]["spans"] == out[i]["base_spans"]


def test_marks_equal_plain_scores(taught):
    """Spans by a plain reading of the model: best candidates first, none over another."""
    docs, model, texts = taught
    out = {r["doc_id"]: sorted((pii.KINDS.index(s[0]), s[1], s[2]) for s in r["spans"]) for r in pii.mark(docs, model).collect()}
    for i, text in enumerate(texts):
        taken = plain_base(text)
        ranked = sorted((-1 / (1 + math.exp(-sum(model.weights[f] for f in pii.describe(text, c, set(plain_base(text)))[1]) - model.bias)), c)
                        for c in pii.find_candidates(text, plain_base(text)))
        for score, c in ranked:
            if -score >= 0.5 and c not in taken and not any(s < c[2] and c[1] < e for _, s, e in taken):
                taken.append(c)
        assert out[i] == sorted(taken)


def test_personal_data_of_odd_rows(spark, empty):
    docs = documents(spark, [(1, None), (2, ""), (None, "x@y.org"), (2, "call x(at)y.org"), (2, "call x(at)y.org")]).selectExpr(
        "*", "'mine' as spans", "7 as `1`")
    model = pii.fit(docs)
    out = pii.mark(docs, model).collect()
    assert len(out) == 5 and {r["redacted"] for r in out if r["doc_id"] == 1} == {None}
    assert [r["redacted"] for r in out if r["doc_id"] is None] == ["[EMAIL]"]
    assert pii.fit(empty) is None and pii.mark(empty, None).count() == 0
    assert pii.mark(docs, None).where("size(spans) > 0").count() == 1


def test_words_are_split_at_six_blanks():
    assert words_of("a b \x1c c\x0bd\x85e") == ["a b".encode(), b"\x1c", b"c", "d\x85e".encode()]
