"""Rules on text statistics, given as a table and compiled into one projection.

A rule bounds a metric, or the ratio of two metrics: low * per <= metric <= high * per.
All metrics come from built-in functions of the text alone, so the whole step is one
projection over the scan, without a shuffle; `let` makes each row's words and window
hashes once.

Defined cases: a null or empty text has no words and fails the base rules; ratios are
compared as products, so nothing is divided by zero; repeated rows and other columns
pass through unchanged (result columns replace columns of the same names); an empty
table gives an empty table.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.columns import let, free_name

# Fixed values.
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "are", "this", "from", "at", "on", "as", "be",
    "it", "was", "by", "a", "an", "or", "not", "have",
    # German
    "der", "die", "das", "und", "zu", "den", "des", "ist", "mit", "von", "für", "dem", "ein", "eine", "auf",
    "nicht", "sich", "im",
    # French
    "le", "la", "les", "de", "du", "et", "un", "une", "en", "que", "qui", "pour", "dans", "pas", "par", "sur",
    "au", "avec",
    # Spanish
    "el", "los", "las", "y", "del", "se", "por", "con", "para", "una", "su", "al", "no", "lo",
)


class Rule(NamedTuple):
    """low * per <= metric <= high * per, or plain bounds without `per`; None: no bound."""

    metric: str
    per: str | None
    low: float | None
    high: float | None


#: Failing one of these is `base_failed`.
BASE = (Rule("n_words", None, 50, None), Rule("n_repeat_words", "n_words", None, 0.5))

#: The further rules; a text is kept if it passes these and the base.
RULES = (
    Rule("word_chars", "n_words", 2, 15),
    Rule("n_symbols", "n_words", None, 0.1),
    Rule("n_dup_lines", "n_lines", None, 0.5),
    Rule("n_same_words", "n_words", None, 0.2),
    Rule("n_upper", "n_letters", None, 0.4),
    Rule("n_stop_words", None, 2, None),
    Rule("n_exclaimed", "n_words", None, 0.2),
)


def _words(text):
    return F.array_remove(F.split(text, WORD_BREAK), "")


def _repeat_words(words):
    """Words in windows of three that are found at least twice, each word once."""
    n = F.size(words)
    starts = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(
        F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))

    def covered(placed):
        """Sorted by hash: equal windows are neighbours."""
        m = F.size(placed)
        twice = F.filter(placed, lambda x, i: (
            F.when(i > 0, F.get(placed, i - 1)["h"] == x["h"]).otherwise(False)
            | F.when(i + 1 < m, F.get(placed, i + 1)["h"] == x["h"]).otherwise(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(
            twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    def count(all_):
        placed = F.array_sort(F.transform(all_, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(all_)) == F.size(all_), 0).otherwise(let(placed, covered))

    return let(hashes, count)


def _same_words(words):
    """Words equal to the word before them."""
    n = F.size(words)
    return F.size(F.filter(words, lambda w, i: F.when(i > 0, F.get(words, i - 1) == w).otherwise(False)))


def metrics(text):
    """A struct of all metrics of a text, as long integers."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    by_line = let(lines, lambda x: F.struct(
        F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    by_word = let(_words(text), lambda w: F.struct(
        F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words"), _same_words(w).alias("n_same_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).alias("n_stop_words"),
        F.size(F.filter(w, lambda x: x.endswith("!!"))).alias("n_exclaimed")))

    def left(pattern):
        return F.char_length(F.regexp_replace(text, pattern, ""))

    made = {"word_chars": left(WORD_BREAK), "n_symbols": left(f"[^{SYMBOLS}]+"),
            "n_upper": left(r"\P{Lu}+"), "n_letters": left(r"\P{L}+")}

    def join(parts):
        fields = [parts["w"][n] for n in ("n_words", "n_repeat_words", "n_same_words", "n_stop_words", "n_exclaimed")]
        names = ["n_words", "n_repeat_words", "n_same_words", "n_stop_words", "n_exclaimed"]
        both = list(zip(names, fields, strict=True)) + [(n, parts["l"][n]) for n in ("n_lines", "n_dup_lines")]
        return F.struct(*[v.cast("bigint").alias(n) for n, v in both + list(made.items())])

    return let(F.struct(by_word.alias("w"), by_line.alias("l")), join)


def passes(rule: Rule, found):
    """The rule as a condition on a struct of metrics."""
    value = found[rule.metric]
    per = F.lit(1) if rule.per is None else found[rule.per]
    tests = []
    if rule.low is not None:
        tests.append(value >= F.lit(rule.low) * per)
    if rule.high is not None:
        tests.append(value <= F.lit(rule.high) * per)
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def apply_rules(docs: DataFrame, text="text", base=BASE, rules=RULES) -> DataFrame:
    """`docs` with the metrics, base_failed, failed (names of the metrics whose rule
    failed) and kept."""
    def judge(found):
        bad = [F.when(~passes(r, found), F.lit(r.metric if r.per is None else f"{r.metric}/{r.per}"))
               for r in (*base, *rules)]
        base_ok = F.lit(True)
        for rule in base:
            base_ok = base_ok & passes(rule, found)
        return F.struct(found.alias("m"), (~base_ok).alias("base_failed"),
                        F.filter(F.array(*bad), lambda x: x.isNotNull()).alias("failed"))

    names = [c for c in docs.columns]
    result = let(metrics(F.col(text)), judge)
    made = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_words",
            "n_upper", "n_letters", "n_stop_words", "n_exclaimed")
    out_names = (*made, "base_failed", "failed", "kept")
    keep = [F.col(c) for c in names if c not in out_names]
    judged = free_name("quality_rules", names)
    return docs.select(*keep, result.alias(judged)).select(
        *keep, *[F.col(f"{judged}.m.{n}").alias(n) for n in made],
        F.col(f"{judged}.base_failed"), F.col(f"{judged}.failed"),
        (F.size(f"{judged}.failed") == 0).alias("kept"))
