"""Drop lines that several documents share, except in the first of them.

Lines are compared by a key: blanks stripped at both ends, A-Z lower-cased. Only
128-bit hashes of keys are shuffled; a hash that many documents hold is counted by
partial aggregation, and the join that finds its lines can be split by adaptive
execution. The texts themselves move once, to meet the positions they lose.

Defined cases: a null or empty text is one empty line; keys shorter than `min_chars`
are never dropped; rows with the same doc_id are one document; a document without
doc_id is compared with nothing and keeps its lines; an empty table gives an empty
table; other columns pass through unchanged, whatever their names.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.columns import BLANKS, ascii_lower, free_name, let
from docweave.session import stage


def line_key(line):
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def lines_of(text):
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs, doc_id, text, min_chars):
    """One row per eligible line: d, t (hash of the text), pos, h1, h2."""
    lines = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("d"), F.xxhash64(F.col(text)).alias("t"),
        F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
    keyed = lines.select("d", "t", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "d", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


def shared_lines(hashes, min_docs):
    """Hashes held by at least `min_docs` documents, with the smallest of these.

    Two documents hold a line exactly if its smallest and largest document differ,
    so the usual case needs no distinct count.
    """
    if min_docs <= 1:
        found = hashes.groupBy("h1", "h2").agg(F.min("d").alias("first"))
    elif min_docs == 2:
        found = hashes.groupBy("h1", "h2").agg(F.min("d").alias("first"), F.max("d").alias("last"))
        found = found.where("first < last")
    else:
        held = hashes.groupBy("h1", "h2", "d").agg(F.lit(1).alias("one"))
        found = held.groupBy("h1", "h2").agg(F.min("d").alias("first"), F.count("one").alias("n"))
        found = found.where(F.col("n") >= min_docs)
    return found.select("h1", "h2", "first")


def dedup_lines(docs: DataFrame, doc_id="doc_id", text="text", min_chars=10, min_docs=2,
                lines="n_lines", dropped="n_dropped") -> DataFrame:
    """`docs` with the shared lines taken out of `text`, and two counts: lines before
    dropping, lines dropped."""
    hashes = line_hashes(docs, doc_id, text, min_chars)
    # Written: only a join of two plain shuffles can be split where a line is frequent,
    # and a small table can be sent to the tasks instead.
    shared = stage(shared_lines(hashes, min_docs), "shared-lines")
    lost = (hashes.join(shared, ["h1", "h2"]).where("d > first")
            # A document holds a position once, and repeated rows hold the same ones.
            .groupBy("d", "t").agg(F.collect_set("pos").alias("gone")))
    names = docs.columns
    key, print_, gone, d, t = (free_name(n, names) for n in ("line_doc", "line_text", "line_gone", "line_d", "line_t"))
    keyed = docs.withColumns({key: F.col(doc_id), print_: F.xxhash64(F.col(text))})
    lost = lost.select(F.col("d").alias(d), F.col("t").alias(t), F.col("gone").alias(gone))
    met = keyed.join(lost, (F.col(key) == F.col(d)) & (F.col(print_) == F.col(t)), "left")
    parts = lines_of(F.col(text))
    count = F.size(parts)
    stay = F.array_except(F.sequence(F.lit(0), count - 1), F.col(gone))
    # array_except looks up hashes: the work is linear in the lines, however many go.
    kept = let(parts, lambda p: F.array_join(F.transform(stay, lambda i: F.element_at(p, i + 1)), "\n"))
    out = met.withColumn(lines, count.cast("bigint")).withColumn(
        dropped, F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("bigint"))
    new_text = F.when(F.col(gone).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(kept)
    return out.withColumn(text, new_text).select(
        *names, *[c for c in (lines, dropped) if c not in names])
