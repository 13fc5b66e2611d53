"""The queries op1_* to op13_*: each operator over its whole table."""

from pyspark.sql import functions as F


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id="doc_id"):
    """One of five folds, by the id as text: its labels are never learnt from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0


def learnable(labels, doc_id="doc_id"):
    return labels.where(~held_out(doc_id))


def op2_toxicity(spark, sf_dir):
    from docweave.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_quality_cotraining(spark, sf_dir):
    from docweave.llm import quality_cotrain

    docs = table(spark, sf_dir, "documents")
    scored = quality_cotrain.score(docs, learnable(table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "text_score", "meta_score", "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         (F.col("score") >= 0.5).alias("kept"))


def op7_minhash_near_dedup(spark, sf_dir):
    from docweave.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op1_ann_forest(spark, sf_dir):
    from docweave.llm.ann_forest import search

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(rows, rows.where("vec_id % 20 = 0"))


#: host, path, action: longest match decides.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op4_url_filter(spark, sf_dir):
    from docweave.llm.url_filter import filter_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_line_dedup(spark, sf_dir):
    from docweave.llm.line_dedup import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from docweave.llm.bpe import token_digests

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = token_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                         keep_text=False)
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def source_weights(docs):
    """Weights 5, 2, 1 in turn for the sources in order, null last."""
    from docweave.operators.batching import number_rows

    sources = docs.select("source").distinct().withColumn("missing", F.col("source").isNull())
    place = number_rows(sources, ["missing", "source"])
    weight = F.element_at(F.array(F.lit(5.0), F.lit(2.0), F.lit(1.0)), (F.col("row_no") % 3 + 1).cast("int"))
    return place.select("source", weight.alias("weight"))


def op8_mixing(spark, sf_dir):
    from docweave.llm.mixing import mix

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix(docs, source_weights(docs), share=1.5, max_epochs=2)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("repeats")).alias("taken"))


def op9_quality_rules(spark, sf_dir):
    from docweave.llm.quality_rules import apply_rules

    judged = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op10_unigram_count(spark, sf_dir):
    import public_tokenizers

    from docweave.llm.unigram_count import count_tokens, read_pieces

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return count_tokens(docs, pieces, split=False).select("doc_id", "n_tokens")


def with_repeats(docs, doc_id="doc_id", text="text"):
    """The texts of operator 11: in one of ten documents, by a hash of the id, the words
    from some place on go over and over the first of them."""
    from docweave.llm.columns import let

    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeat(w):
        n = F.size(w)

        def from_place(a):
            p = 1 + F.floor((n - a) / (3 + g % 8))
            return let(p, lambda p: F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(
                w, (F.when(i < a, i).otherwise(a + (i - a) % p) + 1).cast("int"))), " "))

        return F.when(n > 0, let((g % n).cast("int"), from_place)).otherwise(F.lit(""))

    return docs.withColumn(text, F.when(h % 10 == 0, let(words, repeat)).otherwise(F.col(text)))


def op11_periodic_runs(spark, sf_dir):
    from docweave.llm.periodic_runs import collapse_runs

    found = collapse_runs(with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    best = F.col("strongest")
    return found.select(
        "doc_id", "n_runs", best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_lexical_search(spark, sf_dir):
    from docweave.llm.lexical_search import search

    return search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                  table(spark, sf_dir, "benchmark").select("item_id", "text")).select("item_id", "rank", "doc_id", "score")


def op13_personal_data(spark, sf_dir):
    from docweave.llm import pii

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = pii.mark(docs, pii.fit(docs))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return marked.select("doc_id", *[count(kind) for kind in pii.KINDS],
                         F.sha2(listed("base_spans"), 256).alias("base_sha256"), listed("spans").alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_ann_forest, op2_toxicity, op3_quality_cotraining, op4_url_filter, op5_line_dedup, op6_byte_bpe,
    op7_minhash_near_dedup, op8_mixing, op9_quality_rules, op10_unigram_count,
    op11_periodic_runs, op12_lexical_search, op13_personal_data)}
