"""Near duplicates, components and mixing against plain Python."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from docweave.llm import minhash
from docweave.llm.components import connected_components
from docweave.llm.mixing import mix, repeat_rows
from docweave.llm.minhash import bands_for, drop_near_duplicates, near_duplicates
from docweave.session import stage
from tests.llm.conftest import documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2040)] + [(5, 5), (7, 3), (3, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = plain_components({x for e in edges for x in e}, edges)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {n: c for n, c in want.items() if n in linked}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) >= k:
        return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}
    return {tuple(words)} if words else set()


def plain_groups(rows, k, num, den):
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids = sorted(sets)
    edges = []
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                edges.append((a, b))
    found = plain_components(ids, edges)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in ids}


def near_copies():
    """A large group whose members are near the base, but less near each other; chains;
    copies; short texts."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for _ in range(60):
        copy = list(base)
        for at in rng.sample(range(120), 2):
            copy[at] = f"x{rng.randrange(10**6)}"
        rows.append(copy)
    rows.append(base)
    chain = [rng.choice(vocabulary) for _ in range(90)]
    for step in range(12):
        chain = list(chain)
        chain[step * 7] = f"y{step}"
        rows.append(chain)
    rows += [[rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] for _ in range(60)]
    texts = [" ".join(r) for r in rows]
    texts += [texts[3]] * 5 + ["Two Words", "two  words", "two words more", "one", "ONE", "", " \n", "É a", "é a"]
    rng.shuffle(texts)
    return list(enumerate(texts, start=10))


def test_unlike_texts_that_share_a_passage(spark, monkeypatch):
    """Two thousand texts with one passage in common: few pairs are made of them."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"v{rng.randrange(5000)}" for _ in range(rng.randint(25, 40))])) for i in range(2000)]
    rows += [(5000 + i, rows[i][1] + " end") for i in range(0, 300, 3)]
    made = []
    pairs = minhash._prefix_pairs

    def counted(*args):
        found = stage(pairs(*args), "test-pairs")
        made.append(found.count())
        return found

    monkeypatch.setattr(minhash, "_prefix_pairs", counted)
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r["doc_id"]: r["component_id"] for r in out}
    assert got == {i: i - 5000 if i >= 5000 else i for i, _ in rows}
    assert sum(made) < 4000


def test_near_duplicates_match_brute_force(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, num, den in ((3, 85, 100), (5, 80, 100)):
        out = near_duplicates(docs, words=k, numerator=num, denominator=den).collect()
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out}
        assert len(out) == len(rows)
        assert got == plain_groups(rows, k, num, den)


def test_buckets_are_settled_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LEFT_PER_CLASS", 0.01)
    rows = near_copies()
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {i: v[1] for i, v in plain_groups(rows, 3, 85, 100).items()}


def test_bands_miss_next_to_nothing():
    for threshold in (0.8, 0.85, 0.95):
        rows, bands = bands_for(threshold)
        assert (1 - threshold ** rows) ** bands <= 1e-7


def test_near_duplicates_of_odd_rows(spark, empty):
    docs = spark.createDataFrame(
        [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A B C D E F"), (3, None), (4, None),
         (5, "g h"), (5, "g h i j")], "doc_id long, text string")
    out = sorted([tuple(r) for r in near_duplicates(docs).collect()], key=str)
    assert out == sorted([(1, 4, 1, True), (1, 4, 1, True), (None, 4, None, True), (2, 4, 1, False), (3, 0, 3, True),
                          (4, 0, 4, True), (5, 1, 5, True), (5, 2, 5, True)], key=str)
    assert near_duplicates(empty).count() == 0
    more = docs.withColumns({"n_shingles": F.lit("x"), "c": F.lit(1), "key": F.lit(2), "gone_id": F.lit(3)})
    left = drop_near_duplicates(more)
    assert left.columns == more.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 1, 3, 4, 5, 5]


def test_an_id_with_several_texts_loses_only_the_near_copies(spark):
    shared, own = "a b c d e f g h", "one two three four five six"
    docs = spark.createDataFrame(
        [(1, shared, 0), (2, shared.upper(), 1), (2, own, 2), (2, own, 3), (3, own, 4), (4, shared, 5), (2, None, 6),
         (None, shared, 7), (2, "  " + shared, 8)], "doc_id long, text string, row int")
    # Id 2 is the root of the group of `own`: it stays though a copy of id 1 goes.
    assert sorted(r["row"] for r in drop_near_duplicates(docs).collect()) == [0, 2, 3, 6, 7]


def plain_targets(sizes, weights, total, epochs):
    target, open_ = {}, {s for s in sizes if weights.get(s, 0) > 0}
    while open_:
        level = (total - sum(target.values())) / sum(weights[s] for s in open_)
        above = {s for s in open_ if sizes[s] * epochs < weights[s] * level}
        if not above:
            return target | {s: weights[s] * level for s in open_} | {s: 0.0 for s in sizes if weights.get(s, 0) <= 0}
        target |= {s: sizes[s] * epochs for s in above}
        open_ -= above
    return target | {s: 0.0 for s in sizes if s not in target}


def mixed_rows(spark, rows, weights, share, epochs, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    given = spark.createDataFrame(weights, "source string, weight double")
    return docs, mix(docs, given, share, epochs, **more)


def test_mix_meets_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    rows += [(2000, None, "d"), (2001, "", "d"), (2002, "lone words here", "e")]
    weights = [("a", 1.0), ("b", 5.0), ("c", 2.0), (None, 1.0), ("d", 3.0), ("e", 0.5)]
    for share, ranges in ((1.5, 1024), (0.4, 7), (1.0, 1)):
        docs, out = mixed_rows(spark, rows, weights, share, 2, ranges=ranges)
        got = out.collect()
        sizes = defaultdict(int)
        for _, text, source in rows:
            sizes[source] += len((text or "").split())
        want = plain_targets(sizes, dict(weights), share * sum(sizes.values()), 2)
        taken = defaultdict(int)
        for r in got:
            assert r["size"] == len((r["text"] or "").split())
            assert r["source_size"] == sizes[r["source"]]
            assert abs(r["target"] - want[r["source"]]) < 1e-6
            assert 0 <= r["repeats"] <= 2
            taken[r["source"]] += r["size"] * r["repeats"]
        for source, target in want.items():
            assert abs(taken[source] - target) <= 15 or source == "e"
        again = mixed_rows(spark, rows[::-1], weights, share, 2, ranges=ranges)[1].collect()
        assert sorted((r["doc_id"], r["repeats"]) for r in got) == sorted((r["doc_id"], r["repeats"]) for r in again)
        assert repeat_rows(out, docs.columns).count() == sum(r["repeats"] for r in got)


def test_mix_of_odd_tables(spark, empty):
    docs, out = mixed_rows(spark, [(1, "a b", "x"), (2, "a", "y")], [("x", 0.0)], 1.5, 2)
    assert [(r["target"], r["repeats"]) for r in out.collect()] == [(0.0, 0), (0.0, 0)]
    weights = spark.createDataFrame([("src0", 1.0)], "source string, weight double")
    assert mix(empty, weights, 1.5, 2).count() == 0
    clash = documents(spark, ["a b c"]).withColumns({"size": F.lit("x"), "mix_hash": F.lit(1)})
    assert mix(clash, weights, 1.0, 2).columns == [
        "doc_id", "text", "lang", "source", "n_chars", "mix_hash", "size", "source_size", "target", "repeats"]
    same = spark.createDataFrame([(1, "a b", "src0")] * 4, "doc_id long, text string, source string")
    assert {r["repeats"] for r in mix(same, weights, 2.0, 2).collect()} == {2}


def test_mix_cuts_within_rows_of_one_id(spark):
    """Rows without an id, or of one id, with other texts or equal ones: the target is met."""
    rows = [(None, " ".join([f"w{i}"] * (1 + i % 3)), "a") for i in range(300)] + [(i, "x y", "a") for i in range(50)]
    rows += [(None, "same text", "b")] * 200 + [(7, "one more text", None)] * 90 + [(8, "lone", None)]
    weights = [("a", 1.0), ("b", 1.0), (None, 1.0)]
    for share, ranges in ((0.5, 1024), (0.3, 3), (1.2, 1)):
        _, out = mixed_rows(spark, rows, weights, share, 2, ranges=ranges)
        got = out.collect()
        assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(i), t) for i, t, _ in rows)
        for source in ("a", "b", None):
            own = [r for r in got if r["source"] == source]
            assert abs(sum(r["size"] * r["repeats"] for r in own) - own[0]["target"]) <= 1.5
            assert len({r["repeats"] for r in own}) <= 2


def test_prefix_pairs_share_enough(spark):
    import random

    from docweave.llm.minhash import _prefix_pairs
    rng = random.Random(4)
    # Variants of one set, alike by 0.5 to 1: near the threshold on both sides.
    base = [rng.getrandbits(62) for _ in range(60)]
    sets = [[x if rng.random() > 0.01 * (i % 20) else rng.getrandbits(62) for x in base] for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(sets)), "c long, shingles array<long>")
    got = {(r.u, r.v) for r in _prefix_pairs(frame, None, 85, 100).collect()}
    share = {(u, v): len(set(a) & set(b)) / len(set(a) | set(b))
             for u, a in enumerate(sets) for v, b in enumerate(sets) if u < v}
    alike = {pair for pair, s in share.items() if s >= 0.85}
    assert alike and alike <= got
    # One shared shingle of the prefixes is not enough to be tested.
    assert len(got) < 2 * len(alike)


def test_variants_that_are_not_quite_alike_make_no_pairs(spark):
    import random

    from docweave.llm.minhash import _prefix_pairs
    rng = random.Random(8)
    # Each has lost 7 of 148 shingles and gained 7: two of them share most of their prefixes,
    # but nearly all are a little less alike than asked for.
    base = [rng.getrandbits(63) for _ in range(148)]
    sets = [rng.sample(base, 141) + [rng.getrandbits(63) for _ in range(7)] for _ in range(150)]
    sets += [[*s[:-1], rng.getrandbits(63)] for s in sets[:20]]
    frame = spark.createDataFrame(list(enumerate(sets)), "c long, shingles array<long>")
    got = {(r.u, r.v) for r in _prefix_pairs(frame, None, 85, 100).collect()}
    alike = {(u, v) for u, a in enumerate(sets) for v, b in enumerate(sets)
             if u < v and 100 * len(set(a) & set(b)) >= 85 * len(set(a) | set(b))}
    assert alike and alike <= got
    assert len(got) < 5 * len(alike)


def test_prefix_pairs_of_sets_of_all_sizes(spark):
    import random

    from docweave.llm.minhash import _prefix_pairs
    rng = random.Random(5)
    # Parts of a few sets, with and without other shingles: just alike enough at other sizes.
    bases = [[rng.getrandbits(63) for _ in range(n)] for n in (1, 6, 7, 20, 100, 1300)]
    sets = [rng.sample(base, max(1, round(len(base) * rng.choice((1, 0.95, 0.9, 0.85, 0.8))))) + [
        rng.getrandbits(63) for _ in range(rng.choice((0, 0, len(base) // 20, len(base) // 10)))]
        for base in bases for _ in range(14)]
    frame = spark.createDataFrame(list(enumerate(sets)), "c long, shingles array<long>")
    # Components by threes: pairs inside of one need not be found.
    found = spark.createDataFrame([(c, c - c % 3) for c in range(0, len(sets), 2)], "node long, component long")
    of = {c: c - c % 3 if c % 2 == 0 else c for c in range(len(sets))}
    for numerator, denominator in ((85, 100), (80, 100), (1, 1), (1, 2)):
        alike = {(u, v) for u, a in enumerate(sets) for v, b in enumerate(sets)
                 if u < v and denominator * len(set(a) & set(b)) >= numerator * len(set(a) | set(b))}
        got = {(r.u, r.v) for r in _prefix_pairs(frame, None, numerator, denominator).collect()}
        assert alike and alike <= got
        apart = {(r.u, r.v) for r in _prefix_pairs(frame, found, numerator, denominator).collect()}
        assert {(u, v) for u, v in alike if of[u] != of[v]} <= apart
        assert all(of[u] != of[v] for u, v in apart)


def test_long_variants_that_are_not_quite_alike_make_few_pairs(spark):
    import random

    from docweave.llm.minhash import _prefix_pairs
    rng = random.Random(3)
    # Of 3,000 shingles each has lost 225 and gained 225: two of them differ in far more
    # places than one row of parities has bits to show.
    base = [rng.getrandbits(63) for _ in range(3000)]
    sets = [rng.sample(base, 2775) + [rng.getrandbits(63) for _ in range(225)] for _ in range(40)]
    sets += [[*s[:-100], *(rng.getrandbits(63) for _ in range(100))] for s in sets[:10]]
    frame = spark.createDataFrame(list(enumerate(sets)), "c long, shingles array<long>")
    got = {(r.u, r.v) for r in _prefix_pairs(frame, None, 85, 100).collect()}
    alike = {(u, v) for u, a in enumerate(sets) for v, b in enumerate(sets)
             if u < v and 100 * len(set(a) & set(b)) >= 85 * len(set(a) | set(b))}
    assert len(alike) == 10 and alike <= got
    assert len(got) < 5 * len(alike)


def test_long_variants_meet_at_their_first_shared_shingle(spark):
    import random

    from docweave.llm.minhash import _prefix_meetings
    rng = random.Random(2)
    base = [rng.getrandbits(63) for _ in range(2000)]
    sets = [rng.sample(base, 1980) + [rng.getrandbits(63) for _ in range(20)] for _ in range(20)]
    frame = spark.createDataFrame(list(enumerate(sets)), "c long, shingles array<long>")
    rows = _prefix_meetings(frame, None, 85, 100).collect()
    assert len({(r.u, r.v) for r in rows}) == 20 * 19 // 2
    # Once for each of the four pieces, not for each of some 300 shingles.
    assert len(rows) < 5 * (20 * 19 // 2)


def test_prefix_pairs_of_sets_cut_into_other_numbers_of_pieces(spark):
    import random

    from docweave.llm.minhash import PIECE, _prefix_pairs
    rng = random.Random(7)
    # A set of each size by those that are just alike enough, where one more cut begins.
    sets = []
    for edge in (PIECE, 2 * PIECE, 4 * PIECE):
        for size in (edge - 1, edge, edge + 1, edge + edge // 8):
            whole = [rng.getrandbits(63) for _ in range(size)]
            sets += [whole] + [rng.sample(whole, -(-size * part // 100)) for part in (85, 85, 90, 99)]
    frame = spark.createDataFrame(list(enumerate(sets)), "c long, shingles array<long>")
    sets = [set(s) for s in sets]
    for numerator, denominator in ((85, 100), (80, 100), (1, 2)):
        alike = {(u, v) for u, a in enumerate(sets) for v, b in enumerate(sets)
                 if u < v and denominator * len(a & b) >= numerator * len(a | b)}
        got = {(r.u, r.v) for r in _prefix_pairs(frame, None, numerator, denominator).collect()}
        assert len(alike) >= 48 and alike <= got
