"""Periodic runs of words, and texts with their repeats taken out.

A run is a stretch of words with smallest period q, of at least `min_length` words and
`min_periods` periods, that no neighbouring word extends. Runs are found by internal
pattern matching. The words of some texts are sorted into one suffix array by doubling,
which gives, for every block of 2^k words, the part of the array that holds its
occurrences. A run of period q holds a block of 2^k <= q words, starting at a multiple
of 2^k, that comes again q words later: among the starts from 2^k to 2^(k+1) words
after it. A wavelet tree over the suffix array answers which occurrence lies there first,
second and last (range successor). Occurrences in so narrow a window are one arithmetic
progression. Two at most are candidates themselves; of more the block is periodic, and
the candidates are the distances between the ends of the two periodic stretches. Periods
below 8 come from the next occurrence of blocks of 8 words. Each candidate is extended
both ways by comparing blocks of falling size, so only true runs are left, and all.

One pass over the texts, no shuffle; a task holds about SLICE characters of texts, or one
text that is longer (some 200 bytes a word).

Defined cases: a null or empty text, or one of blanks, has no words and no runs, and the
empty text is left; repeated rows are treated alike; an empty table gives an empty table;
other columns pass through (result columns replace columns of the same names).
"""

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docweave.llm.arrow import map_column
from docweave.session import spread_if_few

MIN_LENGTH = 24
MIN_PERIODS = 3
#: Blocks of 8 words lie whole in any run of 24 words and its next period up to 8.
BASE = 3
#: Characters of texts handled at once.
SLICE = 1_500_000

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
MADE = T.StructType([
    T.StructField("n_runs", T.LongType()), T.StructField("strongest", RUN),
    T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


def words_of(text):
    """Runs of other than \\x20 and \\x09-\\x0D, as bytes."""
    return text.encode("utf-8").split() if text else []


class _Wavelet:
    """Order statistics of values in ranges of a sequence."""

    def __init__(self, values, top):
        self.bits = max(1, int(top).bit_length())
        self.top, self.zeros = top, []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(low)]).astype(np.int32))
            values = np.concatenate([values[low], values[~low]])

    def below(self, lo, hi, value):
        """How many of lo..hi are less than value."""
        value, count = np.minimum(value, self.top), np.zeros(len(lo), dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            lo0, hi0 = zeros[lo], zeros[hi]
            count += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, zeros[-1] + lo - lo0, lo0), np.where(one, zeros[-1] + hi - hi0, hi0)
        return count

    def smallest(self, lo, hi, nth):
        """The nth smallest (from 0) of lo..hi."""
        value = np.zeros(len(lo), dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            lo0, hi0 = zeros[lo], zeros[hi]
            one = nth >= hi0 - lo0
            nth = np.where(one, nth - (hi0 - lo0), nth)
            value |= one.astype(np.int64) << (self.bits - 1 - level)
            lo, hi = np.where(one, zeros[-1] + lo - lo0, lo0), np.where(one, zeros[-1] + hi - hi0, hi0)
        return value


class _Blocks:
    """Suffix array of symbols that end with one found nowhere else, and for each block
    length 2^k the first place of each block in it."""

    def __init__(self, symbols):
        n = len(symbols)
        held = np.argsort(symbols, kind="stable")
        slots, keys = np.arange(n), symbols[held]
        self.array, rank = held.copy(), np.empty(n, dtype=np.int64)
        self.ranks, self.aligned, self.slots = [], [], None
        while True:
            # Equal keys are equal blocks.
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(cuts, len(keys)))
            first = np.repeat(slots[cuts], sizes)
            rank[held] = first
            self.ranks.append(rank.astype(np.int32))
            again = np.repeat(sizes > 1, sizes)
            level = len(self.ranks) - 1
            held, slots, first, last = held[again], slots[again], first[again], (first + np.repeat(sizes, sizes))[again]
            if level == BASE:
                self.slots = slots  # all that any later block can hold
            if level >= BASE:
                on = held % (1 << level) == 0
                self.aligned.append((level, held[on], first[on], last[on]))
            if not len(held):
                break
            # Blocks that occur again end before the last symbol.
            keys = rank[held] * n + rank[held + (1 << level)]
            order = np.argsort(keys, kind="stable")
            held, keys = held[order], keys[order]
            self.array[slots] = held

    def after(self, i, j):
        """How many symbols agree from i and j on."""
        count = np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.ranks) - 2, -1, -1):
            same = self.ranks[level][i + count] == self.ranks[level][j + count]
            count += same.astype(np.int64) << level
        return count

    def before(self, i, j):
        """How many symbols agree before i and j (i < j)."""
        count = np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.ranks) - 2, -1, -1):
            at = i - count - (1 << level)
            inside = np.maximum(at, 0)
            same = (at >= 0) & (self.ranks[level][inside] == self.ranks[level][inside + (j - i)])
            count += same.astype(np.int64) << level
        return count


def _candidates(blocks):
    """(block start, period) pairs that may lie in a run."""
    starts, periods = [], []

    def add(b, q, level):
        fits = (q >= (1 << level if level > BASE else 1)) & (q < 2 << level)
        starts.append(b[fits])
        periods.append(q[fits])

    tree = None
    for level, b, lo, hi in blocks.aligned:
        if not len(b):
            continue
        if tree is None:
            tree = _Wavelet(blocks.array[blocks.slots], len(blocks.array))
        lo, hi = np.searchsorted(blocks.slots, lo), np.searchsorted(blocks.slots, hi)
        if level == BASE:
            here = tree.below(lo, hi, b + 1)
            near = np.flatnonzero(here < hi - lo)
            add(b[near], tree.smallest(lo[near], hi[near], here[near]) - b[near], level)
        size = 1 << level
        from_, to = tree.below(lo, hi, b + size), tree.below(lo, hi, b + 2 * size)
        some = np.flatnonzero(to > from_)
        b, lo, hi, from_, n = b[some], lo[some], hi[some], from_[some], (to - from_)[some]
        one = tree.smallest(lo, hi, from_)
        few = n <= 2
        add(b[few], one[few] - b[few], level)
        two = np.flatnonzero(n > 1)
        b, one, n = b[two], one[two], n[two]
        next_ = tree.smallest(lo[two], hi[two], from_[two] + 1)
        few = n == 2
        add(b[few], next_[few] - b[few], level)
        b, one, r = b[~few], one[~few], (next_ - one)[~few]
        add(b, one - blocks.before(one, one + r) - b + blocks.before(b, b + r), level)
        add(b, one + blocks.after(one, one + r) - b - blocks.after(b, b + r), level)
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(texts, min_length=MIN_LENGTH, min_periods=MIN_PERIODS):
    """(start, length, period) of every run of each text (a list of words), by start,
    then period."""
    assert min_periods >= 3 and min_length >= 3 << BASE
    lengths = np.array([len(words) for words in texts], dtype=np.int64)
    ids = {}
    for words in texts:
        ids.update(dict.fromkeys(words))
    ids = dict(zip(ids, range(len(ids)), strict=True))
    # Each text ends with a symbol of its own: nothing repeats across it.
    bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
    symbols = np.empty(bounds[-1], dtype=np.int64)
    for at, words in enumerate(texts):
        symbols[bounds[at]:bounds[at + 1] - 1] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    symbols[bounds[1:] - 1] = len(ids) + np.arange(len(texts))
    out = [[] for _ in texts]
    blocks = _Blocks(symbols) if len(symbols) else None
    if blocks is None or not blocks.aligned:
        return out
    b, q = _candidates(blocks)
    start = b - blocks.before(b, b + q)
    length = b + q + blocks.after(b, b + q) - start
    long_ = length >= np.maximum(min_length, min_periods * q)
    # Multiples of a period have the same ends: the smallest counts.
    found = np.unique(np.stack([start[long_], length[long_], q[long_]], axis=1), axis=0)
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    of = np.searchsorted(bounds, found[:, 0], side="right") - 1
    for text, (s, n, p) in zip(of.tolist(), found.tolist(), strict=True):
        out[text].append((s - int(bounds[text]), n, p))
    return out


def collapse(words, runs):
    """The words that no run repeats: of each run its first period stays."""
    if not runs:
        return words
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    return [words[i] for i in np.flatnonzero(~gone)]


def _as_run(run):
    return None if run is None else dict(zip(("start", "length", "period"), run, strict=True))


def _collapse_texts(position, width, min_length, min_periods):
    run_type = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def part(texts):
        split = [words_of(text) for text in texts]
        found = find_runs(split, min_length, min_periods)
        for words, runs in zip(split, found, strict=True):
            best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
            yield len(runs), _as_run(best), [_as_run(r) for r in runs], b" ".join(collapse(words, runs)).decode("utf-8")

    def run(batches):
        for batch in batches:
            first = 0
            for texts in _slices(batch.column(position)):
                made = list(zip(*part(texts), strict=True))
                arrays = [batch.column(i).slice(first, len(texts)) for i in range(width)]
                arrays += [pa.array(made[0], pa.int64()), pa.array(made[1], run_type),
                           pa.array(made[2], pa.list_(run_type)), pa.array(made[3], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
                first += len(texts)
    return run


def _slices(column):
    run, size = [], 0
    for value in column:
        run.append(value.as_py())
        size += len(run[-1] or "")
        if size >= SLICE:
            yield run
            run, size = [], 0
    if run:
        yield run


def collapse_runs(docs: DataFrame, text="text", key="doc_id", min_length=MIN_LENGTH,
                  min_periods=MIN_PERIODS) -> DataFrame:
    """`docs` with n_runs, strongest (the run of most periods; of equal ones the first,
    then the one of the shorter period), runs (by start, then period) and collapsed
    (the text without the repeats, its words joined by one blank)."""
    return map_column(spread_if_few(docs, key), MADE, lambda at, n: _collapse_texts(at, n, min_length, min_periods), text)
