"""Mix sources to target weights, with a limit on how often a source repeats.

Targets by capped water-filling: the total is shared by weight; sources whose share
exceeds `max_epochs` times their size are clamped there, and the excess is shared
again by weight among the others, until none is above. Each round is one aggregate
over the table of sources, of which one row reaches the driver.

A target is met by whole passes over the source plus a seeded part of one more: its
documents in the order of a hash of the id, and of the text where ids repeat or are
missing, as far as the words come nearest to the target. The cut is found in two steps
for each hash, sums per hash range and then the one range that holds the cut, so no
source is sorted in one task, however large. Equal rows at the cut are numbered.

Defined cases: a null text has size 0, and a document of size 0 is taken as often as
whole passes say; a null source is a source of its own, last in order; a source of
size 0 has target 0; a source without weight, or with weight 0 or less, has target 0;
rows that repeat a doc_id (or have none) stand side by side in the order of their texts,
and it is not defined which of several rows of one id and text the cut leaves; an empty
table gives an empty table; result columns replace columns of the same names.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.columns import free_name
from docweave.session import stage

RANGES = 1024


def word_count(text):
    """Number of words: runs of anything but blank, tab, line feed to carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def water_fill(sources: DataFrame, total, max_epochs, max_rounds=None) -> DataFrame:
    """`sources` (source, source_size, weight) with `target`.

    The shares of those clamped are taken off the total before the next round. A
    round clamps at least one more source, so it ends.
    """
    room = F.col("source_size") * F.lit(float(max_epochs))
    weight = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    # Clamped: room no more than weight * level, for the level of the round.
    level, clamped = None, -1
    while True:
        above = F.lit(False) if level is None else room < weight * F.lit(level)
        facts = sources.agg(
            F.sum(F.when(above, room)).alias("given"), F.sum(F.when(~above, weight)).alias("weights"),
            F.count_if(above).alias("clamped")).first()
        if facts["clamped"] == clamped or not facts["weights"]:
            break
        clamped = facts["clamped"]
        # The level only rises: what is clamped stays so.
        level = max(level or 0.0, (total - (facts["given"] or 0.0)) / facts["weights"])
    if not facts["weights"]:
        level = float("inf") if level is not None else 0.0
    share = F.when(weight > 0, weight * F.lit(level)).otherwise(F.lit(0.0))
    return sources.withColumn("target", F.least(room, share))


def _order_hash(doc_id, seed):
    """A seeded hash as 15 hexadecimal digits: 60 bits, even over documents."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def _text_hash(text):
    """60 bits of a hash of the text."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 4)


def _source_join(left, right, how="inner"):
    right = right.withColumnRenamed("source", "j_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("j_source")), how).drop("j_source")


def _cut(rows, key, asked, ranges):
    """The key at which each source is cut: source, the key, words before it, its words and rows.

    `rows` has source, the key (60 bits) and words; `asked` has source, start and rest:
    the rows lie behind `start` words, and are cut where `rest` words are reached.
    """
    span = F.least(F.floor(F.col(key) / F.lit((1 << 60) // ranges)), F.lit(ranges - 1)).cast("int")
    holds = "before <= rest and rest < before + words"

    def placed(sums, by):
        running = F.sum("words").over(Window.partitionBy("source").orderBy(by))
        return _source_join(sums, asked).withColumn("before", F.col("start") + running - F.col("words")).where(holds)

    ranged = rows.withColumn("range", span)
    sums = ranged.groupBy("source", "range").agg(F.sum("words").alias("words"))
    cut = placed(sums, "range").select("source", F.col("range").alias("cut_range"), F.col("before").alias("start"), "rest")
    edge = _source_join(ranged, cut.select("source", "cut_range")).where("range = cut_range")
    asked = cut.select("source", "start", "rest")
    per_key = edge.groupBy("source", key).agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"))
    return placed(per_key, key).select("source", key, "before", "words", "n", "rest")


def mix(docs: DataFrame, weights: DataFrame, share, max_epochs, doc_id="doc_id", text="text", source="source",
        seed=1, ranges=RANGES) -> DataFrame:
    """`docs` with size, source_size, target and repeats (how often each is taken).

    `weights` has source and weight, one row per source, null included; the mix is
    `share` times all words.
    """
    names = docs.columns
    s, z, h, t = (free_name(n, names) for n in ("mix_source", "mix_size", "mix_hash", "mix_tie"))
    sized = docs.withColumns({s: F.col(source), z: word_count(F.col(text)), h: _order_hash(doc_id, seed),
                              t: _text_hash(F.col(text))})
    # Written without the texts, as it is read for each step of the cut.
    rows = stage(sized.select(F.col(s).alias("source"), F.col(z).alias("words"), F.col(h).alias("hash"),
                              F.col(t).alias("tie")), "mix-rows")
    sizes = stage(rows.groupBy("source").agg(F.sum("words").alias("source_size")), "mix-sizes")
    weighed = stage(sizes.alias("a").join(weights.select(
        F.col("source").alias("w_source"), F.col("weight").cast("double").alias("weight")),
        F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source"), "mix-sources")
    everything = weighed.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(weighed, everything * share, max_epochs)
    # Whole passes, and the words that one more must add.
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = stage(filled.withColumn("whole", whole.cast("int")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    # The hash at the cut, and the text at the cut among the rows of that hash.
    asked = plan.where("rest > 0").select("source", F.lit(0).cast("bigint").alias("start"), "rest")
    at = stage(_cut(rows.select("source", "hash", "words"), "hash", asked, ranges), "mix-cut")
    inner = _source_join(rows, at.select("source", F.col("hash").alias("cut_hash"))).where("hash = cut_hash")
    tied = _cut(inner.select("source", "tie", "words"), "tie", at.select("source", F.col("before").alias("start"), "rest"),
                ranges)
    # A row goes in if that comes nearer to the target: of one row, or of several equal ones.
    one = F.when(F.col("before") + F.col("words") / 2.0 <= F.col("rest"), 1).otherwise(0)
    several = F.floor((F.col("rest") - F.col("before")) * F.col("n") / F.col("words") + 0.5)
    taken = F.when(F.col("n") == 1, one).otherwise(F.least(several, F.col("n"))).cast("bigint")
    bounds = _source_join(at.select("source", "hash"), tied.select("source", "tie", "n", taken.alias("taken")))
    final = _source_join(plan.select("source", "source_size", "target", "whole"), bounds, "left")
    small = final.select(*[F.col(c).alias(f"m_{c}") for c in final.columns])
    fresh = {n: free_name(n, names + [s, z, h, t]) for n in small.columns}
    m = {n[2:]: F.col(c) for n, c in fresh.items()}
    # Written, so that its size is known: Catalyst sends it to the tasks if it is small.
    small = stage(small.withColumnsRenamed(fresh), "mix-plan")
    met = sized.join(small, F.col(s).eqNullSafe(m["source"]), "left")
    extra = free_name("mix_extra", met.columns)
    at_cut = (F.col(h) == m["hash"]) & (F.col(t) == m["tie"])
    inside = (F.col(h) < m["hash"]) | (F.col(h) == m["hash"]) & (F.col(t) < m["tie"]) | at_cut & (m["taken"] == m["n"])
    split = F.coalesce(at_cut & (m["taken"] > 0) & (m["taken"] < m["n"]), F.lit(False))
    if small.where((m["taken"] > 0) & (m["taken"] < m["n"])).isEmpty():
        met = met.withColumn(extra, F.when(inside, 1).otherwise(0))
    else:
        equal = _numbered(met.where(split), fresh["m_source"])
        met = met.where(~split).withColumn(extra, F.when(inside, 1).otherwise(0)).unionByName(
            equal.withColumn(extra, F.when(F.col(equal.columns[-1]) <= m["taken"], 1).otherwise(0)).drop(equal.columns[-1]))
    repeats = m["whole"] + F.col(extra)
    made = {"size": F.col(z), "source_size": m["source_size"], "target": m["target"],
            "repeats": repeats.cast("int")}
    return met.select(*[c for c in names if c not in made], *[v.alias(n) for n, v in made.items()])


def _numbered(rows, source):
    """`rows` with a last column that numbers those of a source from 1, by many tasks."""
    place, task, first = (free_name(n, rows.columns) for n in ("mix_place", "mix_task", "mix_first"))
    rows = stage(rows.withColumn(place, F.monotonically_increasing_id()).withColumn(
        task, F.shiftright(F.col(place), 33)), "mix-equal")
    counts = rows.groupBy(F.col(source).alias("c_source"), F.col(task).alias("c_task")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("c_source").orderBy("c_task")) - F.col("n")
    offsets = counts.select(F.col("c_source").alias(first + "_s"), F.col("c_task").alias(first + "_t"), before.alias(first))
    met = rows.join(offsets, F.col(source).eqNullSafe(F.col(first + "_s")) & (F.col(task) == F.col(first + "_t")))
    own = F.row_number().over(Window.partitionBy(source, task).orderBy(place))
    names = [c for c in rows.columns if c not in (place, task)]
    return met.select(*names, (own + F.col(first)).alias(place))


def repeat_rows(mixed: DataFrame, names) -> DataFrame:
    """Each row as often as the mix takes it, with the columns `names`."""
    copies = F.explode(F.array_repeat(F.lit(1), F.col("repeats")))
    return mixed.where("repeats > 0").select(*names, copies.alias(free_name("mix_copy", names))).select(*names)
