"""Personal data in texts: labelers vote, their reliabilities are estimated, and a span
classifier is trained on the outcome.

1. Base spans follow fixed patterns (email, ip, card, phone) and always stand.
2. Candidates are looser: what stands at an @ or an "(at)", and cards, addresses and phone
   numbers inside longer stretches of digits, where a base pattern takes too much and fails.
3. Five labelers say yes, no or nothing of each candidate: the base pattern, the shape
   (check digit, ranges, lengths), gazetteers (domain endings, issuers, dial codes), the
   characters on either side, and cue words before it.
4. Votes are counted by kind and pattern over all documents; expectation-maximisation over
   these counts (at most 4 * 3^5 rows, whatever the corpus) estimates how often each
   labeler says what of true and of false candidates, and so a probability for each
   pattern.
5. A logistic regression on shape, sides, words before and votes learns these
   probabilities from at most `max_spans` candidates, by a hash of what they are.
6. `mark` adds candidates scored at least `threshold`, best first, that overlap no base
   span and none added before.

Fitting is one pass over the texts and marking another; neither moves texts.

Defined cases: null and empty texts have no spans; without candidates nothing is added;
repeated rows are marked alike (and count as often as they come when fitting); an empty
table gives an empty table; other columns pass through (result columns replace columns of
the same names). Places are code points, the end exclusive.
"""

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.arrow import map_column
from docweave.llm.toxicity import _fit_logistic
from docweave.session import spread_if_few, stage

KINDS = ("email", "ip", "card", "phone")
EMAIL, ADDRESS, CARD, PHONE = range(4)

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A digit run is tried from its start only: a later start in it can match no more.
_BASE = {
    ADDRESS: re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    CARD: re.compile(r"[0-9]([\x20-]?[0-9])+"),
    PHONE: re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}

# Where numbers can be: a match of any pattern above lies in one stretch.
_STRETCH = re.compile(r"[0-9+][0-9\x20().-]*")
_LOOSE = {
    ADDRESS: re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    CARD: re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])"),
    PHONE: re.compile(r"(?:\+[0-9]{1,3}[\x20.-]?)?\([0-9]{2,4}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"
                      r"|\+[0-9]{1,3}(?:[\x20.-]?[0-9]{2,4}){3}(?![0-9])"),
}
_AT = re.compile(r"[\[({]\x20?at\x20?[\])}]|@", re.IGNORECASE)
_BEFORE_AT = re.compile(r"[\w.%+-]{1,64}\x20?$")
_AFTER_AT = re.compile(r"\x20?[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\.)[A-Za-z0-9-]{1,63}){0,8}", re.IGNORECASE)

# Gazetteers and cue words.
DOMAIN_ENDINGS = frozenset(
    "com org net edu gov mil int info biz io dev app me tv eu de fr es it uk us ca au nl be ch at pt pl se no dk fi ie"
    " cz gr ro hu br mx ar cl co jp cn in kr ru tr za nz".split())
DIAL_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91"
    " 92 94 98 351 352 353 354 355 356 357 358 359 370 371 372 380 385 386 420 421".split())
_ISSUER = re.compile(r"4|5[1-5]|2(?:2[2-9]|[3-6]|7[01]|720)|3[47]|30[0-5]|3[689]|35|6011|64[4-9]|65|62")
CUES = (
    frozenset("mail email e-mail correo courriel contact kontakt contacto write".split()),
    frozenset("ip host server address adresse dirección ping".split()),
    frozenset("card visa mastercard amex credit karte tarjeta carte cb".split()),
    frozenset("tel phone telephone call fax mobile telefon teléfono téléphone handy móvil".split()),
)
COUNTER_CUES = frozenset("token key secret password passwd hash sha md5 version release license isbn issn uuid id build rev".split())
_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)?")

N_LABELERS = 5
MAX_SPANS = 20_000
FEATURES = 4_096
THRESHOLD = 0.5
SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def passes_luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = 2 * value - 9 if value > 4 else 2 * value
        total += value
    return total % 10 == 0


def _digits(text):
    return [c for c in text if "0" <= c <= "9"]


def _valid(kind, match):
    """What a base match must hold beside its pattern."""
    if kind == ADDRESS:
        # A part of more digits than 255 with its zeros is compared as a number too.
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in match.split("."))
    n = len(digits := _digits(match))
    return 13 <= n <= 19 and passes_luhn(digits) if kind == CARD else 9 <= n <= 15


def _base_emails(text):
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield EMAIL, start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _stretches(text):
    for found in _STRETCH.finditer(text):
        if found.end() - found.start() > 6:
            yield found.start(), found.group()


def find_base(text):
    """(kind, start, end) of the base spans, by kind, then start."""
    found = list(_base_emails(text))
    for first, stretch in _stretches(text):
        for kind, pattern in _BASE.items():
            found += [(kind, first + m.start(), first + m.end()) for m in pattern.finditer(stretch) if _valid(kind, m.group())]
    return sorted(found)


def find_candidates(text, base):
    """Distinct (kind, start, end): looser spans, and the base ones."""
    found = set(base)
    for at in _AT.finditer(text):
        before, after = _BEFORE_AT.search(text, max(0, at.start() - 65), at.start()), _AFTER_AT.match(text, at.end())
        if before and after:
            found.add((EMAIL, before.start(), after.end()))
    for first, stretch in _stretches(text):
        # A bracket before the first digit belongs to a phone number.
        lead = 1 if first and text[first - 1] == "(" else 0
        stretch = text[first - lead:first + len(stretch)]
        for kind, pattern in _LOOSE.items():
            found.update((kind, first - lead + m.start(), first - lead + m.end()) for m in pattern.finditer(stretch))
    return sorted(found)


def _shape_vote(kind, span, digits):
    if kind == EMAIL:
        return 1 if re.search(r"\.[A-Za-z]{2,}$", span) else -1
    if kind == ADDRESS:
        return 1 if all(part == "0" or part[0] != "0" and int(part) <= 255 for part in span.split(".")) else -1
    if kind == CARD:
        return 1 if passes_luhn(digits) else -1
    return 1 if 9 <= len(digits) <= 13 else -1


def _gazetteer_vote(kind, span, digits):
    if kind == EMAIL:
        return 1 if re.split(r"[^A-Za-z0-9-]+", span)[-1].lower() in DOMAIN_ENDINGS else -1
    if kind == ADDRESS:
        return -1 if span.split(".")[0] in ("0", "127", "255") else 0
    if kind == CARD:
        return 1 if _ISSUER.match("".join(digits)) else -1
    code = re.match(r"\+([0-9]{1,3})", span)
    return 0 if not code else 1 if any(code[1][:n] in DIAL_CODES for n in (1, 2, 3)) else -1


def _side(char):
    return "edge" if not char else "blank" if char.isspace() else "digit" if char.isdigit() else "letter" if char.isalpha() else char


def describe(text, candidate, base):
    """(votes, features) of a candidate."""
    kind, start, end = candidate
    span = text[start:end]
    digits = _digits(span)
    left, right = _side(text[start - 1:start]), _side(text[end:end + 1])
    words = [w.lower() for w in _WORD.findall(text[max(0, start - 40):start])][-3:]
    joined = {"digit", "letter", "_", "=", "/", "\\"}
    boundary = -1 if left in joined or right in joined else 1 if left in ("edge", "blank") else 0
    # An address that goes on in dots is a longer number.
    if kind == ADDRESS and right == "." and text[end + 1:end + 2].isdigit():
        boundary = -1
    cue = -1 if any(w in COUNTER_CUES for w in words) else 1 if any(w in CUES[kind] for w in words) else 0
    votes = (1 if candidate in base else 0, _shape_vote(kind, span, digits), _gazetteer_vote(kind, span, digits), boundary, cue)
    shape = re.sub(r"([9a])\1{3,}", r"\1+", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", span)))[:40]
    named = [f"kind={kind}", f"shape={kind}{shape}", f"left={kind}{left}", f"right={kind}{right}", f"digits={kind},{len(digits)}",
             *(f"word={kind}{w}" for w in words), *(f"vote={kind},{j},{v}" for j, v in enumerate(votes))]
    return votes, sorted({zlib.crc32(f.encode()) % FEATURES for f in named})


def estimate(counts, steps=50):
    """P(true) of each vote pattern, {votes: count} of one kind, by expectation-maximisation.

    Labelers are taken as independent given the truth. They start out, and are held by a
    weight of eight candidates, at saying the right thing six times in ten and the wrong
    one once."""
    patterns = np.array(list(counts), dtype=int) + 1
    weight = np.array(list(counts.values()), dtype=float)
    start = np.array([[0.6, 0.3, 0.1], [0.1, 0.3, 0.6]])
    said, prior = np.repeat(start[:, None], N_LABELERS, axis=1), 0.5
    for _ in range(steps):
        no, yes = (np.log(said[y][np.arange(N_LABELERS), patterns]).sum(axis=1) for y in (0, 1))
        true = 1 / (1 + np.exp(np.clip(np.log((1 - prior) / prior) + no - yes, -500, 500)))
        for y, share in ((0, (1 - true) * weight), (1, true * weight)):
            for j in range(N_LABELERS):
                seen = np.bincount(patterns[:, j], weights=share, minlength=3) + 8 * start[y]
                said[y, j] = seen / seen.sum()
        prior = (float((true * weight).sum()) + 4) / (weight.sum() + 8)
    return dict(zip(counts, true.tolist(), strict=True))


@dataclass
class Model:
    """Weights of hashed features, and what the labelers came to for each vote pattern."""

    weights: np.ndarray
    bias: float
    patterns: dict

    def score(self, features):
        return 1 / (1 + np.exp(-np.clip(self.weights[features].sum() + self.bias, -500, 500)))


def _described(batches):
    for batch in batches:
        kinds, votes, features, marks = [], [], [], []
        for value in batch.column(0):
            text = value.as_py() or ""
            base = find_base(text)
            held = set(base)
            for candidate in find_candidates(text, base):
                said, named = describe(text, candidate, held)
                kinds.append(candidate[0])
                votes.append(said)
                features.append(named)
                marks.append(zlib.crc32(repr((candidate, text[candidate[1]:candidate[2]])).encode()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(votes, pa.list_(pa.int32())), pa.array(features, pa.list_(pa.int32())),
             pa.array(marks, pa.int64())], names=["kind", "votes", "features", "mark"])


def fit(docs: DataFrame, text="text", key="doc_id", max_spans=MAX_SPANS) -> Model | None:
    """A model of the candidates of all texts; None without candidates."""
    rows = spread_if_few(docs.select(key, text), key).select(text).mapInArrow(
        _described, "kind int, votes array<int>, features array<int>, mark long")
    rows = stage(rows, "pii-candidates")
    counts = [{} for _ in KINDS]
    # At most 3^5 patterns of votes for each kind.
    for r in rows.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect():
        counts[r["kind"]][tuple(r["votes"])] = r["n"]
    total = sum(n for held in counts for n in held.values())
    if not total:
        return None
    patterns = {(kind, votes): p for kind, held in enumerate(counts) if held for votes, p in estimate(held).items()}
    chosen = rows if total <= max_spans else rows.where(F.pmod("mark", F.lit(1_000_000)) < int(1_000_000 * max_spans / total))
    # About max_spans rows at most; copies are one.
    sample = chosen.select("kind", "votes", "features").distinct().toArrow().to_pylist()
    sample.sort(key=lambda r: (r["kind"], r["votes"], r["features"]))
    of = np.concatenate([np.full(len(r["features"]), i) for i, r in enumerate(sample)]) if sample else np.zeros(0, int)
    cols = np.array([f for r in sample for f in r["features"]], dtype=np.int64)
    target = np.array([patterns[r["kind"], tuple(r["votes"])] for r in sample])
    weights, bias = _fit_logistic(of, cols, np.ones(len(cols)), len(sample), FEATURES, target)
    return Model(weights, float(bias), patterns)


def add_spans(text, base, model, threshold=THRESHOLD):
    """Base spans and the candidates that the model takes, by kind, then start."""
    if model is None:
        return base
    held, taken, scored = set(base), list(base), []
    candidates = [c for c in find_candidates(text, base) if c not in held]
    if not candidates:
        return base
    covered = bytearray(len(text))
    for _, start, end in base:
        covered[start:end] = b"\1" * (end - start)
    for candidate in candidates:
        if not any(covered[candidate[1]:candidate[2]]):
            scored.append((-model.score(describe(text, candidate, held)[1]), candidate))
    for score, (kind, start, end) in sorted(scored):
        if -score >= threshold and not any(covered[start:end]):
            taken.append((kind, start, end))
            covered[start:end] = b"\1" * (end - start)
    return sorted(taken)


def redact(text, spans):
    """The text with each span as [KIND]; of overlapping spans the first."""
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def _mark(shared, position, width, threshold):
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def as_rows(spans):
        return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]

    def run(batches):
        model = shared.value
        for batch in batches:
            base, spans, clean = [], [], []
            for value in batch.column(position):
                text = value.as_py()
                own = find_base(text or "")
                all_ = add_spans(text or "", own, model, threshold)
                base.append(as_rows(own))
                spans.append(as_rows(all_))
                clean.append(redact(text, all_) if all_ else text)
            arrays = [batch.column(i) for i in range(width)]
            arrays += [pa.array(base, kind_type), pa.array(spans, kind_type), pa.array(clean, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
    return run


def mark(docs: DataFrame, model, text="text", key="doc_id", threshold=THRESHOLD) -> DataFrame:
    """`docs` with base_spans, spans (arrays of kind, start, end) and redacted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers, 4 * 3^5 patterns
    made = T.StructType([T.StructField("base_spans", T.ArrayType(SPAN)), T.StructField("spans", T.ArrayType(SPAN)),
                         T.StructField("redacted", T.StringType())])
    return map_column(spread_if_few(docs, key), made, lambda at, n: _mark(shared, at, n, threshold), text)
