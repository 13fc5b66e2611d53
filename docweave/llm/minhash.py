"""Near duplicates by MinHash: bands, signature check, confirmation, components.

1. One pass over the texts makes, for each, the number of its distinct shingles, a
   128-bit hash of its word sequence, and the minima of many universal hashes.
2. Texts of one sequence are one class. Only classes go on.
3. Classes that share the minima of a band meet in a bucket. The number of bands is set
   so that a pair at the threshold is missed with a chance of at most `miss`.
4. A bucket is not expanded into pairs. Every member meets the bucket's pivot (first the
   smallest pivot of all its buckets, then those that are not in its component yet): pairs
   whose signatures agree too little are dropped (seven standard deviations off), the
   rest is confirmed on the full sets. Confirmed links make components. A pair that is not
   tested then lies in a bucket of three or more classes that holds several components.
   If such buckets have few pairs, all are tested. Else each member outside its bucket's
   largest component meets some of that component, and then the members
   are paired by prefixes: two sets that are alike enough
   share one of their rarest shingles, |A| - ceil(t * |A|) + 1 of each (any one order of
   shingles will do; rare is what few of these sets hold). The shingles of a common
   passage are frequent and in no prefix, so unlike texts that share it do not meet.
   Large sets are cut into pieces by bits of the shingles: two sets that are alike enough
   have a piece in which they are, so all this holds for pieces. Places tell more pairs
   off: from the first shared shingle on, enough must be left of both pieces. So do
   parities: each shingle flips one of 1024 bits of its piece, and two pieces differ in at
   least as many shingles as in bits. Variants of one text that are not quite alike share
   prefixes, but few such pairs leave the join. A pair leaves it where it first shares a
   shingle, not at all others, of which a long prefix has hundreds. No pair that is alike
   is lost here.
5. Components by alternating large-star and small-star.

Defined cases: a text without words is linked with nothing; a text of fewer words than
a shingle has its whole sequence as one; rows with the same doc_id are linked only if
their texts are; a null doc_id takes no part: its component is null and it is kept;
an empty table gives an empty table.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.components import connected_components
from docweave.llm.shingles import mix, sequence_hashes, shingle_runs, slices, word_hashes
from docweave.session import spread_if_few, stage

MISS = 1e-7
#: Pairs in open buckets, per class in a bucket, up to which all of them are tested.
LEFT_PER_CLASS = 0.5
#: Otherwise members first meet so many of their bucket's largest component, in so many rounds.
STARS = 16
STAR_ROUNDS = 1
#: The largest component of a bucket counts for this if the bucket holds so many of it.
LARGE = 32
#: Ids up to which they are sent to the tasks that read the texts again (8 bytes each);
#: beyond, both are shuffled.
SENT_IDS = 1_000_000
#: Bits of a shingle that say by which counter its frequency is known.
COUNTER_BITS = 17
#: Shingles of a piece, about; a power of two. Larger sets are cut into so many more pieces.
PIECE = 512
#: The lowest bit of a shingle that says into which piece it goes.
PIECE_SHIFT = 16
#: Longs of a piece's parities.
PARITIES = 16
#: Shingles before a row's, among which one that is shared shows that the row's is not the first.
BEFORE = 8


def bands_for(threshold, miss=MISS):
    """(rows, bands): longer bands for higher thresholds keep unlike texts apart."""
    rows = max(1, round(math.log(0.36) / math.log(threshold))) if threshold < 1 else 8
    rows = min(rows, 8)
    chance = threshold ** rows
    return rows, 1 if chance >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-chance)))


def least_agreement(threshold, n):
    """Minima that must agree: below, a pair at the threshold lies with less than 1e-11."""
    return max(0, math.floor(n * threshold - 7 * math.sqrt(n * threshold * (1 - threshold))))


def _signatures(k, rows, bands, seed):
    """d, text -> d, n_shingles, s1, s2, signature (null without words), keys of bands."""
    rng = np.random.default_rng(seed)
    n = rows * bands
    # Universal by multiplication and addition modulo 2^64, of which the top half counts.
    a = rng.integers(1, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, size=n, dtype=np.uint64)
    places = rng.integers(1, 2**63, size=rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for batch in batches:
            texts = [value.as_py() for value in batch.column(1)]
            count, first, second, minima = [], [], [], []
            for _, part in slices(texts):
                words, bounds = word_hashes(part)
                found, cuts = shingle_runs(words, bounds, k)
                one, two = sequence_hashes(words, bounds)
                first.append(one)
                second.append(two)
                count += [len(np.unique(found[cuts[i]:cuts[i + 1]])) for i in range(len(part))]
                best = np.zeros((len(part), n), dtype=np.uint64)
                held = np.flatnonzero(np.diff(cuts))
                if len(held):
                    work = np.empty_like(found)
                    for h in range(n):
                        np.multiply(found, a[h], out=work)
                        np.add(work, b[h], out=work)
                        best[held, h] = np.minimum.reduceat(work, cuts[held])
                minima.append((best >> np.uint64(32)).astype(np.uint32))
            if not texts:
                continue
            count = np.array(count, dtype=np.int64)
            top = np.concatenate(minima)
            none = count == 0
            grouped = top.reshape(len(texts), bands, rows).astype(np.uint64)
            keys = mix((grouped * places).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))
            offsets = pa.array(np.arange(len(texts) + 1) * n, pa.int32())
            # Eight bits of each minimum: unlike ones agree by chance once in 256, which
            # drops no pair.
            signature = pa.ListArray.from_arrays(offsets, pa.array(top.astype(np.uint8).view(np.int8).ravel()))
            key_offsets = pa.array(np.arange(len(texts) + 1) * bands, pa.int32())
            key_lists = pa.ListArray.from_arrays(key_offsets, pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count), pa.array(np.concatenate(first).view(np.int64)),
                 pa.array(np.concatenate(second).view(np.int64)), signature, key_lists, pa.array(none)],
                names=["d", "n_shingles", "s1", "s2", "signature", "keys", "none"])
    return run


def _keyed_sets(k):
    """d, text -> d, sequence hashes, distinct shingle hashes."""
    def run(batches):
        for batch in batches:
            texts = [value.as_py() for value in batch.column(1)]
            lists, first, second = [], [], []
            for _, part in slices(texts):
                words, bounds = word_hashes(part)
                found, cuts = shingle_runs(words, bounds, k)
                one, two = sequence_hashes(words, bounds)
                first.append(one)
                second.append(two)
                lists += [np.unique(found[cuts[i]:cuts[i + 1]]).view(np.int64) for i in range(len(part))]
            if not texts:
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(first).view(np.int64)),
                 pa.array(np.concatenate(second).view(np.int64)), pa.array(lists, pa.list_(pa.int64()))],
                names=["d", "s1", "s2", "shingles"])
    return run


class _Links:
    """Confirms pairs of classes."""

    def __init__(self, signatures, sets, numerator, denominator, least):
        self.signatures, self.sets, self.least = signatures, sets, least
        self.numerator, self.denominator = numerator, denominator

    def _meet(self, pairs, side, frame, column):
        right = frame.select(F.col("c").alias(side), F.col(column).alias(f"{column}_{side}"))
        return pairs.join(right, side)

    def confirm(self, pairs):
        """Pairs (u, v) that are alike enough."""
        near = self._meet(self._meet(pairs, "u", self.signatures, "signature"), "v", self.signatures, "signature")
        agree = F.size(F.filter(F.zip_with("signature_u", "signature_v", lambda x, y: x == y), lambda same: same))
        near = near.where(agree >= self.least).select("u", "v")
        full = self._meet(self._meet(near, "u", self.sets, "shingles"), "v", self.sets, "shingles")
        common = F.size(F.array_intersect("shingles_u", "shingles_v")).cast("bigint")
        union = F.size("shingles_u") + F.size("shingles_v") - common
        return full.where(common * F.lit(self.denominator) >= union * F.lit(self.numerator)).select("u", "v")


def _with_component(buckets, found):
    tied = buckets.join(found.withColumnRenamed("node", "c"), "c", "left")
    return tied.withColumn("component", F.coalesce("component", "c"))


def _apart(buckets, found):
    """Pairs (pivot, c) of a bucket that lie in different components."""
    pairs = buckets.where("c <> pivot").select("pivot", "c").distinct()
    if found is None:
        return pairs
    other = found.select(F.col("node").alias("pivot"), F.col("component").alias("at_pivot"))
    tied = _with_component(pairs, found).join(other, "pivot", "left")
    return tied.where(F.col("component") != F.coalesce("at_pivot", "pivot")).select("pivot", "c")


def _star_pairs(left, found, seed):
    """Members of open buckets by some members of the bucket's largest component, as
    (pivot, c). Each class meets at most STARS of a component, however many buckets they
    share."""
    tied = stage(_with_component(left, found), "minhash-tied")
    parts = tied.groupBy("key", "component").agg(F.count("c").alias("n"))
    mains = parts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("most"))
    asked = tied.join(stage(mains.where(F.col("most") >= LARGE), "minhash-mains"), "key").where("component <> main").select("c", "main").distinct()
    turn = F.row_number().over(Window.partitionBy("component").orderBy(F.xxhash64("c", F.lit(seed)), "c"))
    stars = tied.select("component", "c").distinct().withColumn("turn", turn).where(F.col("turn") <= STARS)
    return stage(asked, "minhash-asked").join(stars.select(F.col("component").alias("main"), F.col("c").alias("pivot")), "main").select(
        "pivot", "c").distinct()


def _halvings(n):
    """How often a set of n shingles is halved until no half is expected to exceed PIECE."""
    return max(0, (n - 1).bit_length() - (PIECE - 1).bit_length())


def _pieces(held, numerator, denominator):
    """A set's pieces, as (number, whether it is cut by its own size, shingles): cut as its
    size asks for, and as that of each larger set asks for that may be alike."""
    own = _halvings(len(held))
    for halvings in range(own, _halvings(len(held) * denominator // numerator) + 1):
        # Other bits than those that choose a counter or a parity.
        at = (held >> np.uint64(PIECE_SHIFT)) & np.uint64((1 << halvings) - 1)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange((1 << halvings) + 1, dtype=np.uint64))
        for i in np.flatnonzero(np.diff(cuts)):
            yield (1 << halvings) + int(i), halvings == own, held[order[cuts[i]:cuts[i + 1]]]


def _rarest(counters, numerator, denominator):
    """c, component, shingles -> the rarest shingles of each piece, with their places."""
    def run(batches):
        often = counters.value
        shift = np.uint64(64 - COUNTER_BITS)
        for batch in batches:
            parts, places, sizes, pieces, owns, of = [], [], [], [], [], []
            for at, row in enumerate(batch.column(2)):
                for piece, own, held in _pieces(row.values.to_numpy().view(np.uint64), numerator, denominator):
                    n = len(held) - (numerator * len(held) + denominator - 1) // denominator + 1
                    parts.append(held[np.lexsort((held, often[(held >> shift).astype(np.int64)]))[:n]])
                    places.append(np.arange(len(parts[-1])))
                    sizes.append(len(held))
                    pieces.append(piece)
                    owns.append(own)
                    of.append(at)
            if not parts:
                continue
            counts = [len(part) for part in parts]
            rows = pa.array(np.repeat(of, counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts).view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(np.repeat(pieces, counts)), pa.array(np.repeat(owns, counts)),
                 pa.array(np.concatenate(places)), pa.array(np.repeat(sizes, counts))],
                names=["shingle", "c", "component", "piece", "own", "place", "size"])
    return run


def _parities(numerator, denominator):
    """c, shingles -> c, piece, and for each bit whether an odd number of the piece's
    shingles falls on it."""
    bits = 64 * PARITIES

    def run(batches):
        for batch in batches:
            odd, pieces, of = [], [], []
            for at, row in enumerate(batch.column(1)):
                for piece, _, held in _pieces(row.values.to_numpy().view(np.uint64), numerator, denominator):
                    fell = (held % np.uint64(bits)).astype(np.int64)
                    odd.append(np.packbits((np.bincount(fell, minlength=bits) & 1).astype(np.uint8)).view(np.int64))
                    pieces.append(piece)
                    of.append(at)
            if not odd:
                continue
            packed = np.stack(odd)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of)), pa.array(pieces), *(pa.array(packed[:, i].copy()) for i in range(PARITIES))],
                names=["c", "piece", *(f"bits{i}" for i in range(PARITIES))])
    return run


def _prefix_meetings(sets, found, numerator, denominator):
    """Pairs of different components that may be alike, by their rarest shingles: nearly
    always once for each piece of theirs that may be alike."""
    spark = sets.sparkSession
    counters = F.transform("shingles", lambda s: F.shiftrightunsigned(s, 64 - COUNTER_BITS))
    counts = sets.select(F.explode(counters).alias("at")).groupBy("at").count()
    often = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    for row in counts.toLocalIterator():  # one row a counter
        often[row["at"]] = row["count"]
    counters = spark.sparkContext.broadcast(often)
    tied = _with_component(sets, found) if found is not None else sets.withColumn("component", F.col("c"))
    rows = stage(tied.select("c", "component", "shingles").mapInArrow(
        _rarest(counters, numerator, denominator),
        "shingle long, c long, component long, piece long, own boolean, place long, size long"), "minhash-prefixes")

    def enough(common, sizes):
        return common * (numerator + denominator) >= sizes * numerator

    # The largest component of a shingle is not paired with itself.
    parts = rows.groupBy("shingle", "piece", "component").agg(F.count("*").alias("n"), F.min("size").alias("least"))
    mains = parts.groupBy("shingle", "piece").agg(
        F.count("*").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main"), F.min("least").alias("least"))
    mains = stage(mains.where("parts > 1").select("shingle", "piece", "main", "least"), "minhash-mains")
    # The first shingle that two pieces share is followed by all others. Where a row's cannot
    # be the first shared even with the smallest piece, the row meets none.
    met = rows.join(mains, ["shingle", "piece"]).where(
        enough(F.col("size") - F.col("place"), F.col("size") + F.col("least"))).drop("least")
    before = Window.partitionBy("c", "piece").orderBy("place").rowsBetween(-BEFORE, -1)
    met = met.withColumn("before", F.collect_list("shingle").over(before))
    bits = [f"bits{i}" for i in range(PARITIES)]
    parities = sets.select("c", "shingles").mapInArrow(
        _parities(numerator, denominator), ", ".join(["c long", "piece long", *(f"{name} long" for name in bits)]))
    all_ = stage(met.join(stage(parities, "minhash-parities"), ["c", "piece"]), "minhash-met")
    some = all_.where("component <> main").select(
        "shingle", "piece", *[F.col(x).alias(f"{x}_") for x in ("c", "component", "own", "place", "size", "before", *bits)])
    # Pairs outside the main component come from either side: one is enough.
    once = (F.col("component") == F.col("main")) | (F.col("c") < F.col("c_"))
    # Two sets meet in the pieces that the larger one asks for.
    larger = F.col("own") | F.col("own_")
    sizes = F.col("size") + F.col("size_")
    behind = F.least(F.col("size") - F.col("place"), F.col("size_") - F.col("place_"))
    # An odd number of shingles of just one of the pieces falls on each bit that differs.
    differ = sum(F.bit_count(F.col(name).bitwiseXOR(F.col(f"{name}_"))) for name in bits)
    close = differ * (numerator + denominator) <= sizes * (denominator - numerator)
    # Where the pieces have shared a shingle shortly before, this is not their first.
    first = ~F.arrays_overlap("before", "before_")
    pairs = all_.join(some, ["shingle", "piece"]).where(
        (F.col("component") != F.col("component_")) & once & larger & enough(behind, sizes) & close & first)
    return pairs.select(F.least("c", "c_").alias("u"), F.greatest("c", "c_").alias("v"))


def _prefix_pairs(sets, found, numerator, denominator):
    """The pairs of `_prefix_meetings`, each once."""
    return _prefix_meetings(sets, found, numerator, denominator).distinct()


def near_duplicates(docs: DataFrame, words=3, numerator=85, denominator=100, doc_id="doc_id", text="text",
                    miss=MISS, seed=3) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, for every row of `docs`.

    Texts are linked if denominator * common >= numerator * all shingles of both.
    """
    judged = _judged(docs, words, numerator, denominator, doc_id, text, miss, seed)
    return judged.select(F.col("d").alias(doc_id), "n_shingles", "component_id", "kept")


def _judged(docs, words, numerator, denominator, doc_id="doc_id", text="text", miss=MISS, seed=3):
    """d, n_shingles, s1, s2, component_id and kept: rows of equal d, s1 and s2 share the rest."""
    rows, bands = bands_for(numerator / denominator, miss)
    source = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text"))
    id_type = source.schema["d"].dataType.simpleString()
    made = stage(spread_if_few(source, "d").mapInArrow(
        _signatures(words, rows, bands, seed),
        f"d {id_type}, n_shingles long, s1 long, s2 long, signature array<tinyint>, keys array<long>, none boolean"),
        "minhash-texts")
    # A class is the texts of one word sequence. Its number is written down with it.
    # Small sets have small numbers, so that a bucket's pivot is its smallest set: of texts
    # around one passage it is the one that all those link with that are alike at all.
    grouped = made.where("d is not null and not none").groupBy("s1", "s2").agg(
        F.min("d").alias("first"), F.min("n_shingles").alias("n"))
    classes = stage(grouped.orderBy("n", "first").withColumn("c", F.monotonically_increasing_id()).drop("n"), "minhash-classes")
    # One row of each class carries what its members share.
    head = classes.select("c", F.col("first").alias("d"), "s1", "s2")
    heads = made.where("not none").join(head, ["d", "s1", "s2"])
    keyed = heads.select("c", F.explode("keys").alias("key")).select("key", "c")
    held = keyed.groupBy("key").agg(F.min("c").alias("pivot"), F.max("c").alias("last"), F.count("c").alias("n")).where("pivot <> last")
    # Written: only a join of two plain shuffles can be split where a bucket is large.
    held = stage(held.select("key", "pivot", "n"), "minhash-held")
    buckets = stage(keyed.join(held, "key").distinct(), "minhash-buckets")
    members = stage(buckets.select("c").distinct(), "minhash-members")
    signatures = stage(heads.select("c", "signature").join(members, "c", "left_semi").dropDuplicates(["c"]),
                       "minhash-signatures")
    # Texts are read again only for classes that met another.
    needed = stage(head.join(members, "c", "left_semi"), "minhash-needed")
    ids = needed.select("d").distinct()
    # Numbers have a size that is known; ids of text are left to Spark.
    if id_type in ("bigint", "int", "smallint", "tinyint") and needed.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    again = source.join(ids, "d", "left_semi").mapInArrow(
        _keyed_sets(words), f"d {id_type}, s1 long, s2 long, shingles array<long>")
    sets = stage(again.join(needed, ["d", "s1", "s2"]).dropDuplicates(["c"]).select("c", "shingles"), "minhash-sets")

    alike = _Links(signatures, sets, numerator, denominator, least_agreement(numerator / denominator, rows * bands))
    found = None

    def settle(pairs):
        nonlocal found
        more = stage(alike.confirm(pairs.select(F.col("pivot").alias("u"), F.col("c").alias("v"))), "minhash-links")
        if more.isEmpty():
            return False
        # The components so far stand for the links that made them.
        links = more if found is None else found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more)
        found = stage(connected_components(links), "minhash-components")
        return True

    settle(buckets.where("c <> pivot").groupBy("c").agg(F.min("pivot").alias("pivot")))
    settle(_apart(buckets, found))
    apart = stage(_apart(buckets.where("n > 2"), found), "minhash-apart")
    if not apart.isEmpty():
        open_ = stage(buckets.where("n > 2").join(apart, ["pivot", "c"], "left_semi").select("key", "n").distinct(), "minhash-open")
        left = stage(buckets.join(open_.select("key"), "key", "left_semi").select("key", "c"), "minhash-left")
        if open_.agg(F.sum(F.expr("n * (n - 1) / 2"))).first()[0] <= LEFT_PER_CLASS * members.count():
            other = left.select("key", F.col("c").alias("pivot"))
            settle(_apart(left.join(other, "key").where("pivot < c"), found))
        else:
            for turn in range(STAR_ROUNDS):
                if found is None or not settle(_star_pairs(left, found, turn)):
                    break
            open_sets = stage(sets.join(left.select("c").distinct(), "c", "left_semi"), "minhash-open-sets")
            pairs = _prefix_pairs(open_sets, found, numerator, denominator)
            settle(pairs.select(F.col("u").alias("pivot"), F.col("v").alias("c")))
    # A component is known by the smallest doc_id of its classes.
    numbered = _with_component(classes, found) if found is not None else classes.withColumn("component", F.col("c"))
    roots = numbered.groupBy("component").agg(F.min("first").alias("root"))
    resolved = stage(numbered.join(roots, "component").select(
        F.col("s1").alias("t1"), F.col("s2").alias("t2"), "root"), "minhash-resolved")
    out = made.select("d", "n_shingles", "s1", "s2", "none").join(
        resolved, (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")), "left")
    component = F.when(F.col("none") | F.col("d").isNull(), F.col("d")).otherwise(F.col("root"))
    return out.select("d", "n_shingles", "s1", "s2", component.alias("component_id"),
                      F.coalesce(F.col("d") == component, F.lit(True)).alias("kept"))


def _text_hashes(batches):
    """d, text -> d, text, sequence hashes."""
    for batch in batches:
        texts = [value.as_py() for value in batch.column(1)]
        for start, part in slices(texts):
            one, two = sequence_hashes(*word_hashes(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(part)), pa.array(part, pa.string()), pa.array(one.view(np.int64)),
                 pa.array(two.view(np.int64))], names=["d", "text", "s1", "s2"])


def drop_near_duplicates(docs: DataFrame, words=5, numerator=80, denominator=100, doc_id="doc_id", text="text",
                         **more) -> DataFrame:
    """`docs` with one document of each group: the rows that are not kept go.

    Most ids go or stay as a whole. Of an id with several texts, of which only some are
    kept, the rows with the texts of the others go.
    """
    judged = _judged(docs, words, numerator, denominator, doc_id, text, **more).where("d is not null")
    facts = judged.groupBy("d").agg(F.count_if("kept").alias("stay"), F.count_if(~F.col("kept")).alias("go"))
    gone = stage(facts.where("go > 0").select(F.col("d").alias("gone_id"), (F.col("stay") > 0).alias("partly")),
                 "minhash-gone")
    left = docs.join(gone.where("not partly"), docs[doc_id] == gone["gone_id"], "left_anti")
    partly = gone.where("partly").select(F.col("gone_id").alias("d"))
    if partly.isEmpty():
        return left
    classes = judged.where("not kept").join(partly, "d", "left_semi").select("d", "s1", "s2").distinct()
    source = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text"))
    schema = f"d {source.schema['d'].dataType.simpleString()}, text string, s1 long, s2 long"
    texts = source.join(partly, "d", "left_semi").distinct().mapInArrow(_text_hashes, schema)
    texts = stage(texts.join(classes, ["d", "s1", "s2"], "left_semi").select(
        F.col("d").alias("gone_id"), F.col("text").alias("gone_text")), "minhash-gone-texts")
    return left.join(texts, (docs[doc_id] == texts["gone_id"]) & (docs[text] == texts["gone_text"]), "left_anti")
