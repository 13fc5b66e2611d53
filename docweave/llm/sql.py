"""The queries that SQL can express, as DuckDB SQL over the supplied tables."""

from docweave.llm.quality_rules import STOP_WORDS

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') ELSE '' END AS raw,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail
  FROM pages),
named AS (
  SELECT page_id, {_LOWER.format("raw")} AS host,
    regexp_extract(substr(tail, length(raw) + 1), '^[^?#]*') AS path FROM parts),
rules(rhost, rpath, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
hits AS (
  SELECT page_id, host, path, max(CASE WHEN starts_with(path, rpath) AND (host = rhost OR ends_with(host, '.' || rhost))
    THEN printf('%05d', length(rhost) + length(rpath)) || rhost || rpath || chr(1) || action END) AS best
  FROM named, rules GROUP BY ALL)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
  split_part(substr(best, 6), chr(1), 1) AS rule, coalesce(split_part(best, chr(1), 2), 'allow') AS verdict FROM hits
"""

OP5 = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, {_LOWER.format(f"regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g')")} AS key FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, coalesce(k.doc_id > s.first, false) AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP8 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
    md5('1:' || coalesce(doc_id::VARCHAR, '')) AS mark FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
total AS (SELECT sum(source_size) * 1.5::DOUBLE AS t FROM sources),
-- Sources fill up in the order of room by weight; the level of the others follows.
filling AS (
  SELECT *, 2.0::DOUBLE * source_size AS room,
    coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS given, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights
  FROM sources WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min((t - given) / weights, room / weight) FILTER (room / weight >= (t - given) / weights) AS level
  FROM filling, total),
plan AS (SELECT source, source_size, least(room, coalesce(weight * level, room)) AS target FROM filling, level),
ordered AS (
  SELECT s.doc_id, s.source, s.size, p.source_size, p.target,
    CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size) ELSE 0 END AS whole,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY substr(s.mark, 1, 15) ROWS UNBOUNDED PRECEDING) AS done
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 6) AS target,
  (size * (whole + (CASE WHEN target > whole * source_size AND done - size / 2.0 <= target - whole * source_size
    THEN 1 ELSE 0 END)))::BIGINT AS taken
FROM ordered
"""

_STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)

OP9 = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
placed AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM base),
windows AS (
  SELECT doc_id, i, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
counted AS (SELECT *, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM windows WHERE z IS NOT NULL),
repeats AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM counted WHERE n > 1) GROUP BY doc_id),
found AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '{_BLANK}+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(list_zip(w[2:], w[:-2]), lambda p: p[1] = p[2]))::BIGINT AS n_same_words,
    length(regexp_replace(text, '\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper,
    length(regexp_replace(text, '\P{{L}}+', '', 'g'))::BIGINT AS n_letters,
    len(list_filter(w, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop_words,
    len(list_filter(w, lambda x: ends_with(x, '!!')))::BIGINT AS n_exclaimed
  FROM base LEFT JOIN repeats r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AND n_symbols <= 0.1 * n_words
    AND n_dup_lines <= 0.5 * n_lines AND n_same_words <= 0.2 * n_words AND n_upper <= 0.4 * n_letters
    AND n_stop_words >= 2 AND n_exclaimed <= 0.2 * n_words AS kept
FROM found
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*)::BIGINT AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS all_terms FROM lengths),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) AS term FROM benchmark)
  GROUP BY ALL),
held AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM words SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, totals GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // all_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY ALL HAVING score > 0),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {"op4_url_filter": OP4, "op5_line_dedup": OP5, "op8_mixing": OP8, "op9_quality_rules": OP9,
          "op12_lexical_search": OP12}
