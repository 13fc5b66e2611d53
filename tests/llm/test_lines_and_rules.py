"""Line dedup, quality rules and url rules against plain Python."""

import re

from pyspark.sql import functions as F

from docweave.llm.line_dedup import dedup_lines
from docweave.llm.quality_rules import BASE, Rule, apply_rules
from docweave.llm.url_filter import filter_urls
from tests.llm.conftest import documents

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_dedup(rows, min_chars=10, min_docs=2):
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if i is not None and len(key) >= min_chars:
                held.setdefault(key, set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if not (
            i is not None and len(held.get(k := x.strip(BLANKS).translate(LOWER), ())) >= min_docs
            and i > min(held[k]))]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


LINES = [
    (1, "A shared line here\nown line of the first\n\nshort"),
    (2, "  a SHARED line here\t\nown line of the second\nshort"),
    (3, "x\na shared line here\na shared line here\ny"),
    (4, None), (5, ""), (6, "\n\n"), (7, "a shared line here"),
    (8, "é shared line hère\nÉ shared line hère"), (9, "É shared line hère"),
    (9, "another text under nine\nA shared line here"), (1, "A shared line here\nown line of the first\n\nshort"),
    (None, "a shared line here"), (11, "ten chars!"), (12, "ten chars!"), (13, "nine chrs"), (14, "nine chrs"),
]


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()], key=str)


def test_lines_match_plain_python(spark):
    docs = spark.createDataFrame(LINES, "doc_id long, text string")
    assert got(dedup_lines(docs)) == plain_dedup(LINES)


def test_lines_with_other_thresholds(spark):
    docs = spark.createDataFrame(LINES, "doc_id long, text string")
    assert got(dedup_lines(docs, min_docs=3)) == plain_dedup(LINES, min_docs=3)
    assert got(dedup_lines(docs, min_chars=3)) == plain_dedup(LINES, min_chars=3)


def test_long_text_keeps_its_order(spark):
    rows = [(1, "\n".join(f"line number {i}" for i in range(0, 20000, 2))),
            (2, "\n".join(f"line number {i}" for i in range(20000)))]
    out = {r["doc_id"]: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2]["text"] == "\n".join(f"line number {i}" for i in range(1, 20000, 2))
    assert (out[2]["n_lines"], out[2]["n_dropped"]) == (20000, 10000)


def test_lines_pass_clashing_columns_through(spark, empty):
    docs = spark.createDataFrame(
        [(1, "a shared line here", "k", 5, 7), (2, "a shared line here", "k", 5, 8)],
        "doc_id long, text string, h1 string, line_gone int, n_lines int")
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "h1", "line_gone", "n_lines", "n_dropped"]
    assert sorted(map(tuple, out.collect())) == [(1, "a shared line here", "k", 5, 1, 0), (2, "", "k", 5, 1, 1)]
    assert dedup_lines(empty).count() == 0


def plain_metrics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " \n\t ", "one", "a a a a", "a b c x a b c", "a b c a b c a b c", "A b c a b c",
    "# $ % <x> |\n|| *\n", "same\nsame\n \n \nsame ", "wörter größer naïve été", "a b\x0bc\x0cd\re",
    "the cat and the dog " * 30, " ".join(f"w{i}" for i in range(5000)) + " the of w1 w2 w3",
]


def test_metrics_match_plain_python(spark):
    out = apply_rules(documents(spark, TEXTS)).orderBy("doc_id").select(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    for row, text in zip(out, TEXTS, strict=True):
        want = plain_metrics(text)
        assert tuple(row)[:5] == want, text
        assert row["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_rules_are_a_table(spark, empty):
    docs = documents(spark, TEXTS)
    only = apply_rules(docs, base=(), rules=(Rule("n_words", None, 2, 10),)).orderBy("doc_id").collect()
    assert [r["kept"] for r in only] == [2 <= plain_metrics(t)[0] <= 10 for t in TEXTS]
    assert {tuple(r["failed"]) for r in only} == {(), ("n_words",)}
    clash = docs.withColumn("n_words", F.lit("old")).withColumn("m", F.lit(1)).unionAll(
        docs.withColumn("n_words", F.lit("old")).withColumn("m", F.lit(1)))
    assert apply_rules(clash).select("m", "n_words").count() == 2 * len(TEXTS)
    assert apply_rules(empty, base=BASE).count() == 0


def test_rules_are_one_projection(spark):
    from tests.conftest import plan
    shown = plan(apply_rules(documents(spark, TEXTS))).split("== Physical Plan ==")[1]
    assert "Exchange" not in shown and "Python" not in shown


URLS = [
    None, "", "no scheme", "http://example.com", "http://example.com/", "HTTP://WWW.Example.com/en/1?x#y",
    "https://example.com/en/", "https://example.com/en", "https://a.b.example.com/en/x", "https://notexample.com/en/",
    "ftp://x.net/es/1", "http://net/fr/", "http://netx/fr/", "a://b://c.com/en/", "http://com?x=/", "http://.com/",
    "http://www.example.com/EN/", "http://xéÄ.com/é", "http://x.net/es/1",
]


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        after = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", after)[0]
        path = re.match(r"[^?#]*", after[len(host):])[0]
        host = host.translate(LOWER)
    fits = [(len(h) + len(p), len(h), h + p, a) for h, p, a in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"), ("example.com", "/e", "allow"), ("b", "", "block")]


def judged(spark, rules, **more):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    given = spark.createDataFrame(rules, "host string, path string, action string")
    rows = filter_urls(pages, given, **more).orderBy("page_id").collect()
    return [tuple(r[n] for n in ("host", "path", "rule", "verdict")) for r in rows]


def test_urls_match_plain_python(spark):
    want = [plain_verdict(u, RULES) for u in URLS]
    assert judged(spark, RULES) == want
    # The way for rule tables that are too large to send.
    assert judged(spark, RULES, rule_bytes=0) == want


def test_urls_with_odd_rules(spark):
    assert judged(spark, [], default="block") == [plain_verdict(u, [], "block") for u in URLS]
    twice = [("com", "/", "allow"), ("com", "/", "block"), (None, "/", "block"), ("com", "/", "block")]
    assert judged(spark, twice) == [plain_verdict(u, [("com", "/", "block")]) for u in URLS]


def test_urls_pass_columns_through(spark):
    pages = spark.createDataFrame([(1, "http://x.com/", "a", "b"), (1, "http://x.com/", "a", "b")],
                                  "page_id long, url string, host string, url_best string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    out = filter_urls(pages, rules)
    assert out.columns == ["page_id", "url", "url_best", "host", "path", "rule", "verdict"]
    assert out.count() == 2
    assert filter_urls(pages.limit(0), rules).count() == 0


def test_clashing_columns_keep_their_values(spark):
    import corpus_pipeline

    docs = documents(spark, [(1, "a b c d e f"), (2, "g h i j k l")]).selectExpr(
        "*", "'q' as quality_rules__", "7 as size", "8 as Target", "9 as repeats", "10 as n_lines", "11 as n_dropped", "12 as mix_copy")
    assert {r["quality_rules__"] for r in apply_rules(docs).collect()} == {"q"}
    for stage in (corpus_pipeline.line_dedup_stage, corpus_pipeline.mixing_stage):
        out = stage(spark, docs, None)
        assert out.columns == docs.columns
        assert {tuple(r)[6:] for r in out.collect()} <= {(7, 8, 9, 10, 11, 12)}
