"""Judge urls by rules on hosts and paths.

A url is expanded into expressions: each suffix of its host (by labels) with each
prefix of its path that a rule could name. Expressions meet rules through an
equi-join on the first four bytes of their SHA-256; the full digest confirms a match,
and the longest matching rule decides.

Expansion is bounded by the rules, without loss: no more labels than the longest rule
host has, no paths longer than the longest rule path, and path prefixes that do not
end in "/" only in the lengths that rules have.

Defined cases: a null url or one without "://" has an empty host and path; a path that
is empty fits no rule with a path; equal lengths go to the longer host; a rule given
twice counts once, and if it is given with several actions, block wins; repeated urls
and rows get a result each; an empty table, or no rules, is fine; other columns pass
through unchanged (result columns replace columns of the same names).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.columns import UPPER, free_name, let
from docweave.session import stage

RULE_BYTES = 32 * 1024 * 1024
PREFIX_HEX = 8


def url_host(url):
    """Host after the first "://", A-Z lower-cased; "" if there is none."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(after, F.lit("")), UPPER, UPPER.lower())


def url_path(url):
    """Path after the host, up to "?" or "#"; "" if there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host, max_labels):
    """Suffixes of at most `max_labels` labels, each starting after a dot or at the start."""
    def cut(labels):
        n = F.size(labels)
        lengths = F.sequence(F.lit(1), F.least(n, F.lit(max_labels)))
        return F.transform(lengths, lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    return let(F.split(host, r"\."), cut)


def path_prefixes(path, max_chars, lengths):
    """Prefixes ending in "/" of at most `max_chars` characters, and those of `lengths`."""
    def cut(head):
        ends = F.filter(F.sequence(F.lit(1), F.greatest(F.char_length(head), F.lit(1))),
                        lambda i: F.substring(head, i, 1) == "/")
        fixed = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"),
                         lambda n: n <= F.char_length(head))
        return F.transform(F.array_distinct(F.concat(ends, fixed)), lambda n: F.substring(head, F.lit(1), n))
    return let(F.substring(path, 1, max_chars), cut)


def compile_rules(rules):
    """Distinct rules with digest and prefix: host, path, rule, action, digest, prefix."""
    host = F.translate(F.col("host"), UPPER, UPPER.lower())
    named = rules.where("host is not null and path is not null and action is not null").select(
        host.alias("host"), "path", "action")
    # "block" comes after "allow".
    one = named.groupBy("host", "path").agg(F.max("action").alias("action"))
    digest = F.sha2(F.concat("host", "path"), 256)
    return one.select("host", "path", F.concat("host", "path").alias("rule"), "action",
                      digest.alias("digest"), F.substring(digest, 1, PREFIX_HEX).alias("prefix"))


def filter_urls(pages: DataFrame, rules: DataFrame, url="url", default="allow", rule_bytes=RULE_BYTES) -> DataFrame:
    """`pages` with host, path, rule and verdict.

    `rules` has host, path and action (allow or block). Rules measured at no more than
    `rule_bytes` are sent to the tasks; more are shuffled with the distinct
    expressions, and adaptive execution splits what is hot.
    """
    ready = compile_rules(rules)
    size = F.sum(F.octet_length("rule") * 2 + 120)
    ends = F.col("path").endswith("/")
    facts = ready.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"), F.max(F.char_length("path")).alias("chars"),
        F.collect_set(F.when(~ends, F.char_length("path"))).alias("lengths"), size.alias("bytes")).first()
    names = pages.columns
    u = free_name("url_key", names)
    keyed = pages.withColumn(u, F.col(url))
    found = pages.where(F.col(url).isNotNull()).select(F.col(url).alias(u)).distinct()
    if facts["labels"] is None:
        best = found.select(u, F.lit(None).cast("struct<rule:string,action:string>").alias("best")).where("false")
    else:
        expressions = found.select(
            u, F.explode(host_suffixes(url_host(F.col(u)), facts["labels"])).alias("h"))
        expressions = expressions.select(
            u, "h", F.explode(path_prefixes(url_path(F.col(u)), facts["chars"], sorted(facts["lengths"]))).alias("p"))
        digest = F.sha2(F.concat("h", "p"), 256)
        expressions = expressions.select(
            u, digest.alias("full"), F.substring(digest, 1, PREFIX_HEX).alias("prefix"), "h", "p")
        if facts["bytes"] <= rule_bytes:
            ready = F.broadcast(ready)
        hits = expressions.join(ready, "prefix").where(
            "full = digest and h = host and p = path")
        best = hits.groupBy(u).agg(F.max_by(
            F.struct("rule", "action"),
            F.struct(F.char_length("rule"), F.char_length("host"))).alias("best"))
    # Written: only a join of two plain shuffles can be split where a url is frequent.
    best = stage(best, "url-verdicts")
    b = free_name("url_best", names + [u])
    met = keyed.join(best.withColumnRenamed("best", b), u, "left")
    made = {"host": url_host(F.col(u)), "path": url_path(F.col(u)), "rule": F.col(b)["rule"],
            "verdict": F.coalesce(F.col(b)["action"], F.lit(default))}
    kept = [c for c in names if c not in made]
    return met.select(*kept, *[value.alias(name) for name, value in made.items()])
