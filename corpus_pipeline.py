"""A corpus pipeline of five stages: each reads what the one before has kept.

toxicity -> line dedup -> near duplicates -> mixing -> tokens. The first four return the
columns of `documents`; the last returns doc_id, n_tokens, ids_sha256 and decoded_sha256
for each row that is left. A row that the mix takes twice is there twice.

Null texts, empty tables and further columns are treated as in the stages' operators.
"""

import uuid

from pyspark.sql import functions as F

#: A document goes if its toxicity score is at least this.
TOXIC = 0.5


def toxicity_stage(spark, docs, sf_dir):
    """Documents that score below TOXIC; the model is learnt from labels of four folds."""
    from docweave.llm import toxicity
    from docweave.llm.columns import free_name
    from docweave.llm.queries import learnable, table

    model = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels")))
    score = free_name("toxicity", docs.columns)
    return toxicity.score(docs, model, out=score).where(F.col(score) < TOXIC).select(*docs.columns)


def line_dedup_stage(spark, docs, sf_dir):
    """Lines that several documents share stay in the first of them only."""
    from docweave.llm.columns import free_name
    from docweave.llm.line_dedup import dedup_lines

    lines, dropped = (free_name(name, docs.columns) for name in ("lines_before", "lines_dropped"))
    kept = dedup_lines(docs, lines=lines, dropped=dropped).select(*docs.columns)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def near_dedup_stage(spark, docs, sf_dir):
    """One document of each group of texts whose sets of five-word shingles agree to 0.8."""
    from docweave.llm.minhash import drop_near_duplicates

    return drop_near_duplicates(docs, words=5, numerator=80, denominator=100)


def mixing_stage(spark, docs, sf_dir):
    """Sources mixed by weight to half as much again as all words, none more than twice."""
    from docweave.llm.columns import free_name
    from docweave.llm.mixing import mix, repeat_rows
    from docweave.llm.queries import source_weights

    # Columns of the documents that are named like those of the mix step aside.
    taken = [c for c in docs.columns if c.lower() in ("size", "source_size", "target", "repeats")]
    aside = {c: free_name(f"own_{c}", docs.columns) for c in taken}
    moved = docs.withColumnsRenamed(aside)
    mixed = mix(moved, source_weights(docs), share=1.5, max_epochs=2)
    return repeat_rows(mixed, moved.columns).withColumnsRenamed({new: old for old, new in aside.items()})


def token_stage(spark, docs, sf_dir):
    """Byte-level BPE ids of each text, and the text decoded from them, as digests."""
    import public_tokenizers

    from docweave.llm.bpe import token_digests

    # The executors still hold the memory that the stages before have taken.
    made = token_digests(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN, known_words=80_000, block_chars=250_000, keep_text=False)
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The toxicity score is not expressible in SQL; tests hold run() against the stages
#: done by plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages over `documents`, each written as Parquet and read again by the next."""
    from docweave.session import staging_root

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = f"{staging_root(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for name, function in STAGES:
        function(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return docs
