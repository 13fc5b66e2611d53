"""Word shingles of texts as 64-bit hashes, for whole batches at once."""

import numpy as np

# The blanks that part words, A-Z.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.default_rng(71)
_BYTE = _rng.integers(1, 2**63, size=256, dtype=np.uint64)
_BYTE[_BLANK] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bytes handled at once.
SLICE = 600_000


def mix(x):
    """A bijection of 64-bit words that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n):
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts):
    """Hashes of all words of the texts in order, and the first word of each text
    (with the end): words are runs of non-blanks, A-Z lower-cased."""
    encoded = [text.encode("utf-8") if text else b"" for text in texts]
    starts = np.cumsum([0] + [len(e) + 1 for e in encoded])
    raw = _LOWER[np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)]
    blank = _BLANK[raw]
    first = ~blank
    first[1:] &= blank[:-1]
    begins = np.flatnonzero(first)
    if not len(begins):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    place = np.arange(len(raw))
    place -= np.repeat(begins, np.diff(np.append(begins, len(raw)))) if begins[0] == 0 else np.concatenate(
        [place[:begins[0]], np.repeat(begins, np.diff(np.append(begins, len(raw))))])
    place[blank] = 0
    values = _BYTE[raw] * _powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(values, begins)), np.searchsorted(begins, starts)


def shingle_runs(words, bounds, k):
    """Shingle hashes of all texts in order, and the first of each (with the end). A
    text of fewer than k words has its whole sequence as one; one without words none."""
    counts = np.diff(bounds)
    n_shingles = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(n_shingles)])
    total = np.zeros(max(len(words) - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        total += words[j:len(words) - k + 1 + j] * _PLACE[j] if len(total) else total
    long_ = np.repeat(counts >= k, n_shingles)
    # Where the shingle starts among the words.
    start = np.repeat(bounds[:-1] - out_bounds[:-1], n_shingles) + np.arange(out_bounds[-1])
    out = np.zeros(int(out_bounds[-1]), dtype=np.uint64)
    out[long_] = total[start[long_]]
    for at in np.flatnonzero((counts > 0) & (counts < k)):
        own = words[bounds[at]:bounds[at + 1]]
        out[out_bounds[at]] = (own * _PLACE[:len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), out_bounds


def sequence_hashes(words, bounds):
    """Two hashes of each text's word sequence (0 for a text without words)."""
    counts = np.diff(bounds)
    out = []
    place = np.arange(len(words)) - np.repeat(bounds[:-1], counts)
    powers = _powers(int(counts.max(initial=0)) + 1)
    for salt in (np.uint64(0), np.uint64(0x5851F42D4C957F2D)):
        values = np.append(mix(words ^ salt) * powers[place] if len(words) else words, np.uint64(0))
        sums = np.add.reduceat(values, np.minimum(bounds[:-1], len(words)))
        sums[counts == 0] = 0
        out.append(mix(sums + counts.astype(np.uint64)))
    return out


def slices(texts):
    """Runs of texts of about SLICE bytes: (first, texts)."""
    first, run, size = 0, [], 0
    for at, text in enumerate(texts):
        run.append(text)
        size += len(text) if text else 0
        if size >= SLICE:
            yield first, run
            first, run, size = at + 1, [], 0
    if run:
        yield first, run
