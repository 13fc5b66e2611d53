"""Ranked lexical search over hashed max-sketches, with exact scores.

Terms are maximal runs of letters (and of all that is not ASCII) with A-Z lower-cased.
A document's impact for a term grows with the term's count and falls with the
document's length; a score sums weight times impact over the terms of a query.

1. `build_index`: one pass folds each document's counts into ROWS hashed sketches, each
   holding in a coordinate the greatest count of the terms that fall there. For a given
   document greater counts are greater impacts, so these are coordinatewise maxima of its
   impacts. A sketch is FACTOR to 2 * FACTOR coordinates wide for each distinct term, so
   long documents are told off as well as short ones. Counts are kept in one byte, exact
   up to 200 and rounded up beyond.
2. Weights need the documents that hold a term. The pass that folds the documents also
   notes which of the queries' terms each holds; for an index made before, or more than
   HELD_TERMS terms, an exact pass of its own counts them.
3. `search` looks the terms of a block of queries up in the sketches of many documents at
   once. The least of a term's ROWS coordinates bounds its count from above, and the sum
   of weighted impacts bounds the score. The documents of greatest bounds are scored
   exactly on their whole texts, in rounds of growing size; the k-th best exact score so
   far is the threshold, and what is bounded below it is left out. The last round scores
   all that is left, so results are exact, ties included.

Queries go in blocks of at most BLOCK_TERMS terms (or one query), so what is sent to the
tasks is bounded. Any number of documents may stay a candidate.

Defined cases: null, empty and termless texts hold nothing and are not counted; a query
without terms, or whose terms occur nowhere, has no rows; queries of one id are one query
each by text, repeated rows of one text are one; documents without an id count in the
statistics but are not ranked; rows of the same doc_id are ranked each; an empty table of
either kind gives an empty table.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docweave.llm.columns import ascii_lower
from docweave.session import spread_if_few, stage

# What is no term, the letters that are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same on UTF-8, where bytes from 0x80 on belong to terms: what is no term is a blank.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

ROWS = 3
FACTOR = 4
LEAST_WIDTH = 64
#: Queries are looked up in blocks of so many terms.
BLOCK_TERMS = 8_192
#: The index pass looks for so many terms of queries at most.
HELD_TERMS = 32_768
#: Documents folded at once.
FOLDED = 2_000
#: Documents scored exactly for each query in the first rounds; the last takes the rest.
ROUNDS = (16, 256)
#: Documents whose bounds are computed at once: so many numbers.
CELLS = 4_000_000

# One byte for a count, never below it.
_COUNTS = np.concatenate([np.arange(201), np.ceil(200 * 2 ** (np.arange(1, 54) / 4)), [np.inf]])
_SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def terms_of(text):
    """The terms of a text in order, as bytes."""
    return text.encode("utf-8").translate(_TERM_BYTES).split() if text else []


def _hashes(terms):
    """ROWS hashes of each term, the same in every process."""
    import xxhash

    base = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))
    out = []
    for salt in _SALTS[:ROWS]:
        x = (base ^ np.uint64(salt)) * np.uint64(salt | 1)
        out.append(x ^ (x >> np.uint64(32)))
    return out


def _fold(shared=None):
    """d, text -> d, n_terms, width, sketch, and with terms to look for also held."""
    def run(batches):
        place = shared.value if shared else None
        for batch in batches:
            for first in range(0, batch.num_rows, FOLDED):
                yield _folded(batch.slice(first, FOLDED), place)
    return run


def _folded(batch, place):
    lengths, widths, sketches, held = [], [], [], []
    for value in batch.column(1):
        counts = Counter(terms_of(value.as_py()))
        lengths.append(counts.total())
        if place is not None:
            held.append([place[term] for term in counts if term in place])
        if not counts:
            widths.append(0)
            sketches.append(b"")
            continue
        width = max(LEAST_WIDTH, 1 << (FACTOR * len(counts) - 1).bit_length())
        codes = np.searchsorted(_COUNTS, np.fromiter(counts.values(), np.int64, len(counts))).astype(np.uint8)
        order = np.argsort(codes, kind="stable")  # the greatest count is written last
        sketch = np.zeros((ROWS, width), dtype=np.uint8)
        for row, hashes in enumerate(_hashes(counts)):
            sketch[row, (hashes[order] & np.uint64(width - 1)).astype(np.int64)] = codes[order]
        widths.append(width)
        sketches.append(sketch.tobytes())
    made = {"d": batch.column(0), "n_terms": pa.array(lengths, pa.int64()), "width": pa.array(widths, pa.int64()),
            "sketch": pa.array(sketches, pa.binary())}
    if place is not None:
        made["held"] = pa.array(held, pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([*made.values()], names=[*made])


def build_index(docs: DataFrame, doc_id="doc_id", text="text", terms=None) -> DataFrame:
    """d, n_terms, width and sketch of every document; write it once, search it often.

    With a list of `terms` also `held`: the places in it of the terms a document holds."""
    source = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text"))
    made = f"d {source.schema['d'].dataType.simpleString()}, n_terms long, width long, sketch binary"
    if terms is None:
        return spread_if_few(source, "d").mapInArrow(_fold(), made)
    place = docs.sparkSession.sparkContext.broadcast({term.encode("utf-8"): i for i, term in enumerate(terms)})
    return spread_if_few(source, "d").mapInArrow(_fold(place), f"{made}, held array<int>")


def _terms(text):
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def _split(queries):
    """q, term, times: the terms of each query, counted."""
    return stage(queries.select("q", F.explode(_terms(F.col("query"))).alias("term")).groupBy("q", "term").agg(
        F.count("*").alias("times")), "lexical-terms")


def _document_counts(split, docs, text, index, terms):
    """term, df: the documents that hold each term of the queries."""
    if terms is not None:
        named = docs.sparkSession.createDataFrame(list(enumerate(terms)), "at int, term string")
        counted = index.select(F.explode("held").alias("at")).groupBy("at").agg(F.count("*").alias("df"))
        return counted.join(named, "at").select("term", "df")
    asked = split.select("term").distinct()
    # Only the terms of queries are counted: Spark sends them to the texts if they are few.
    held = docs.select(F.explode(F.array_distinct(_terms(F.col(text)))).alias("term")).join(asked, "term", "left_semi")
    return held.groupBy("term").agg(F.count("*").alias("df"))


def _weights(split, counts, n_docs):
    """q, term, weight: the weight of each term of each query, repeats included."""
    counted = stage(counts, "lexical-df")
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1)))
    return stage(split.join(counted, "term").select("q", "term", (F.col("times") * weight).alias("weight")),
                 "lexical-weights")


def _impact(counts, m):
    """(1000000000 * tf) div (1000 * tf + 8 * m); the limit for a count that is not known."""
    known = np.where(np.isinf(counts), 0, counts).astype(np.int64)
    return np.where(np.isinf(counts), 1_000_000, 1_000_000_000 * known // (1000 * known + 8 * m))


def _length_part(n_terms, n_docs, all_terms):
    return 100 - 75 + (75 * n_terms * n_docs) // all_terms


class _Block:
    """Queries with their terms, for the tasks."""

    def __init__(self, rows, n_docs, all_terms):
        self.queries = sorted({r["q"] for r in rows})
        place = {q: i for i, q in enumerate(self.queries)}
        self.terms = sorted({r["term"].encode("utf-8") for r in rows})
        at = {t: i for i, t in enumerate(self.terms)}
        self.hashes = _hashes(self.terms)
        self.of = {q: {} for q in self.queries}
        self.weights = np.zeros((len(self.terms), len(self.queries)))
        for r in rows:
            term = r["term"].encode("utf-8")
            self.weights[at[term], place[r["q"]]] = r["weight"]
            self.of[r["q"]][term] = r["weight"]
        self.n_docs, self.all_terms = n_docs, all_terms

    def bounds(self, width, n_terms, sketches):
        """Upper bounds (documents, queries) of documents with sketches of one width."""
        least = None
        for row, hashes in enumerate(self.hashes):
            codes = sketches[:, row * width + (hashes & np.uint64(width - 1)).astype(np.int64)]
            least = codes if least is None else np.minimum(least, codes)
        m = _length_part(n_terms, self.n_docs, self.all_terms)
        # All sums are whole numbers far below 2^53, so doubles are exact.
        out, some = np.zeros(least.shape), least > 0
        of = np.nonzero(some)[0]
        out[some] = _impact(_COUNTS[least[some]], m[of])
        return out @ self.weights

    def score(self, query, counts, n_terms):
        m = _length_part(n_terms, self.n_docs, self.all_terms)
        return sum(w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                   for term, w in self.of[query].items() if (tf := counts.get(term)))


def _bound_parts(shared, batches):
    """(ids, bounds) of runs of documents of one sketch width."""
    block = shared.value
    for batch in batches:
        n_terms, widths = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for width in np.unique(widths[widths > 0]).tolist():
            rows = np.flatnonzero(widths == width)
            step = max(1, CELLS // max(len(block.terms), ROWS * width))
            for first in range(0, len(rows), step):
                part = rows[first:first + step]
                held = batch.column(3).take(pa.array(part))
                sketches = np.stack([np.frombuffer(s.as_buffer(), dtype=np.uint8) for s in held])
                yield batch.column(0).take(pa.array(part)), block.bounds(width, n_terms[part], sketches)


def _greatest(shared, k, schema):
    """The k documents of greatest bounds, for each query and task."""
    def run(batches):
        block, best = shared.value, None
        for ids, bounds in _bound_parts(shared, batches):
            query, at = [], []
            for j in range(len(block.queries)):
                top = np.argpartition(-bounds[:, j], k)[:k] if len(bounds) > k else np.arange(len(bounds))
                at.append(top)
                query.append(np.full(len(top), j))
            at, query = np.concatenate(at), np.concatenate(query)
            new = pa.table({"j": query, "d": ids.take(pa.array(at)), "bound": bounds[at, query]})
            best = new if best is None else pa.concat_tables([best, new])
            if best.num_rows > 8 * k * len(block.queries):
                best = _leading(best, k)
        if best is not None:
            yield _named(_leading(best, k), block, schema)
    return run


def _leading(table, k):
    j, bound = table.column("j").to_numpy(), table.column("bound").to_numpy()
    order = np.lexsort((-bound, j))
    turn = np.arange(len(j)) - np.searchsorted(j[order], j[order])
    keep = order[(turn < k) & (bound[order] > 0)]
    return table.take(pa.array(keep))


def _named(table, block, schema):
    q = pa.array(np.array(block.queries, dtype=np.int64)[table.column("j").to_numpy()])
    return pa.RecordBatch.from_arrays(
        [q, *[pa.concat_arrays(table.column(c).chunks).cast(t) if table.num_rows else pa.array([], t)
              for c, t in zip(("d", "bound"), schema, strict=True)]], names=["q", "d", "bound"])


def _at_least(shared, thresholds, schema):
    """Documents whose bounds reach the thresholds."""
    def run(batches):
        block = shared.value
        least = np.array([max(thresholds.get(q, 0), 1) for q in block.queries])
        for ids, bounds in _bound_parts(shared, batches):
            at, j = np.nonzero(bounds >= least)
            if len(at):
                yield _named(pa.table({"j": j, "d": ids.take(pa.array(at)), "bound": bounds[at, j]}), block, schema)
    return run


def _rescore(shared):
    """d, text, queries -> q, d, score on the whole text."""
    def run(batches):
        block = shared.value
        for batch in batches:
            q, at, scores = [], [], []
            for i, (text, queries) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                counts = Counter(terms_of(text.as_py()))
                n_terms = counts.total()
                for query in queries.as_py():
                    score = block.score(query, counts, n_terms) if n_terms else 0
                    if score > 0:
                        q.append(query)
                        at.append(i)
                        scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), batch.column(0).take(pa.array(at, pa.int64())), pa.array(scores, pa.int64())],
                names=["q", "d", "score"])
    return run


def _best(scores, k):
    """The k best rows of each query: rank, q, d, score."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "d")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(index, docs, block, k, rounds):
    spark, id_type = docs.sparkSession, docs.schema["d"].dataType
    shared = spark.sparkContext.broadcast(block)  # at most BLOCK_TERMS terms, or one query's
    arrow = (to_arrow_type(id_type), pa.float64())
    made = f"q long, d {id_type.simpleString()}, bound double"
    by_bound = Window.partitionBy("q").orderBy(F.col("bound").desc(), "d")

    def exact(pairs):
        # A document is read and split once for all queries that ask for it.
        asked = stage(pairs.groupBy("d").agg(F.collect_set("q").alias("queries")), "lexical-asked")
        return stage(docs.join(asked, "d").select("d", "text", "queries").mapInArrow(
            _rescore(shared), f"q long, d {id_type.simpleString()}, score long"), "lexical-scores")

    first = index.mapInArrow(_greatest(shared, rounds[0], arrow), made)
    turn = F.row_number().over(by_bound)
    seen = stage(first.withColumn("turn", turn).where(F.col("turn") <= rounds[0]).select("q", "d"), "lexical-first")
    scores = exact(seen)

    def thresholds():
        rows = _best(scores, k).where(F.col("rank") == k).select("q", "score").collect()  # one row a query of the block
        return {r["q"]: r["score"] for r in rows}

    left = stage(index.mapInArrow(_at_least(shared, thresholds(), arrow), made), "lexical-left")
    for size in (*rounds[1:], None):
        open_ = left.join(seen, ["q", "d"], "left_anti")
        now = thresholds()
        if now:
            lines = spark.createDataFrame(list(now.items()), "q long, least long")
            open_ = open_.join(F.broadcast(lines), "q", "left").where(
                F.col("least").isNull() | (F.col("bound") >= F.col("least"))).drop("least")
        if size:
            open_ = open_.withColumn("turn", turn).where(F.col("turn") <= size)
        pairs = stage(open_.select("q", "d").distinct(), "lexical-next")
        if pairs.isEmpty():
            break
        scores, seen = scores.union(exact(pairs)), seen.union(pairs)
    return _best(scores, k)


def _blocks(weights):
    """Ids of queries, in blocks of at most BLOCK_TERMS terms."""
    block, size = [], 0
    for row in weights.groupBy("q").agg(F.count("*").alias("n")).orderBy("q").toLocalIterator():
        if block and size + row["n"] > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append(row["q"])
        size += row["n"]
    if block:
        yield block


def search(docs: DataFrame, queries: DataFrame, k=10, index: DataFrame = None, doc_id="doc_id", text="text",
           item_id="item_id", query="text", rounds=ROUNDS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of each query.

    `index` is `build_index(docs)`, read from where it was written; without it one is
    built and staged."""
    named = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text"))
    # Queries are numbered: their ids may be anything, or repeat.
    asked = queries.select(F.col(item_id).alias("item"), F.col(query).alias("query")).distinct()
    asked = stage(asked.withColumn("q", F.monotonically_increasing_id()), "lexical-queries")
    split, terms = _split(asked), None
    if index is None:
        some = split.select("term").distinct().limit(HELD_TERMS + 1).collect()
        if len(some) <= HELD_TERMS:
            terms = sorted(r["term"] for r in some)
        index = stage(build_index(docs, doc_id, text, terms), "lexical-index")
    n_docs, all_terms = index.where("n_terms > 0").agg(F.count("*"), F.sum("n_terms")).first()
    found = None
    if n_docs:
        weights = _weights(split, _document_counts(split, docs, text, index, terms), n_docs)
        ranked = index.where("n_terms > 0 and d is not null").select("d", "n_terms", "width", "sketch")
        for ids in _blocks(weights):
            low, high = ids[0], ids[-1]
            rows = weights.where(F.col("q").between(low, high)).collect()  # at most BLOCK_TERMS, or one query's
            best = _search_block(ranked, named, _Block(rows, n_docs, all_terms), k, rounds)
            found = best if found is None else found.union(best)
    if found is None:
        none = f"q long, d {named.schema['d'].dataType.simpleString()}, score long, rank int"
        found = docs.sparkSession.createDataFrame([], none)
    return found.join(asked.select("q", "item"), "q").select(
        F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("d").alias(doc_id), "score")
