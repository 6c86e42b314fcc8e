"""DuckDB SQL of the queries that SQL can express."""

_SPACE = r"[\x20\x09-\x0D]"
_STRIPPED = r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (SELECT doc_id, place, line, {_ASCII_LOWER.format(_STRIPPED)} AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.place, k.line, (r.key IS NOT NULL AND k.doc_id <> r.last_doc) AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

EXACT_DEDUP = f"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}+', ' ', 'g') AS content FROM documents),
g AS (SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY content)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.content) AS text_sha256
FROM n JOIN g ON n.content = g.content
"""

_RULE_FAILS = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_full_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}
_RATES = ", ".join(
    f"""(f_{r} + mean_{r} * weight_{r}) / (n + weight_{r}) AS rate_{r}""" for r in _RULE_FAILS
)
_PRIORS = ", ".join(
    f"""mean_{r}, least(greatest(CASE WHEN room_{r} > 0 AND spread_{r} > mean_{r} * (1 - mean_{r}) * (hosts - 1)
        THEN room_{r} / (spread_{r} - mean_{r} * (1 - mean_{r}) * (hosts - 1)) - 1 ELSE 10000.0 END, 10.0), 10000.0) AS weight_{r}"""
    for r in _RULE_FAILS
)
_SPREADS = ", ".join(
    f"""f_{r} / total AS mean_{r}, q_{r} - f_{r} * f_{r} / total AS spread_{r},
        (f_{r} / total) * (1 - f_{r} / total) * (total - squares / total - (hosts - 1)) AS room_{r}"""
    for r in _RULE_FAILS
)

QUALITY_RULES = f"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
windows AS (
  SELECT k, unnest(generate_series(1, len(w) - 7)) AS i, w FROM words WHERE len(w) >= 8),
keyed AS (SELECT k, i, md5(array_to_string(list_slice(w, i, i + 7), ' ')) AS key FROM windows),
again AS (SELECT k, key FROM keyed GROUP BY k, key HAVING count(*) > 1),
covered AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT k, unnest(generate_series(i, i + 7)) AS p FROM keyed JOIN again USING (k, key)) c GROUP BY k),
lines AS (
  SELECT k, line, count(*) AS n FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM texts) l
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k, line),
line_counts AS (SELECT k, sum(n) AS n_full_lines, sum(n) - count(*) AS n_dup_lines FROM lines GROUP BY k),
measured AS (
  SELECT doc_id, source, cast(len(w) AS bigint) AS n_words, cast(length(array_to_string(w, '')) AS bigint) AS word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
         cast(coalesce(n_dup_lines, 0) AS bigint) AS n_dup_lines, cast(coalesce(n_repeat_words, 0) AS bigint) AS n_repeat_words,
         coalesce(n_full_lines, 0) AS n_full_lines
  FROM words LEFT JOIN line_counts USING (k) LEFT JOIN covered USING (k)),
hosts AS (
  SELECT source, cast(count(*) AS double) AS n,
         {", ".join(f"cast(count(*) FILTER (WHERE {e}) AS double) AS f_{r}" for r, e in _RULE_FAILS.items())}
  FROM measured WHERE source <> '' GROUP BY source),
sums AS (
  SELECT cast(count(*) AS double) AS hosts, sum(n) AS total, sum(n * n) AS squares,
         {", ".join(f"sum(f_{r}) AS f_{r}, sum(f_{r} * f_{r} / n) AS q_{r}" for r in _RULE_FAILS)} FROM hosts),
spreads AS (SELECT hosts, {_SPREADS} FROM sums),
priors AS (SELECT {_PRIORS} FROM spreads),
rates AS (SELECT source, {_RATES} FROM hosts, priors),
rejected AS (SELECT source FROM rates WHERE greatest({", ".join(f"rate_{r}" for r in _RULE_FAILS)}) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND (source IS NULL OR source NOT IN (SELECT source FROM rejected)) AS kept
FROM measured
"""

_TERMS = f"""regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")},
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

LEXICAL_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS terms FROM documents),
lengths AS (
  SELECT k, doc_id, len(terms) AS n, (SELECT count(*) FROM docs WHERE len(terms) > 0) AS all_docs,
         (SELECT cast(sum(len(terms)) AS bigint) FROM docs) AS all_terms FROM docs WHERE len(terms) > 0),
postings AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM docs) t GROUP BY k, term),
spread AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
weights AS (
  SELECT term, cast(floor(1000 * ln(cast(2 * (SELECT count(*) FROM lengths) + 2 AS double) / (2 * df + 1))) AS bigint) AS w
  FROM spread),
items AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * all_docs) // all_terms)))) AS bigint) AS score
  FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (k) GROUP BY item_id, k, doc_id),
ranked AS (
  SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS int) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": LINE_DEDUP, "op9_exact_dedup": EXACT_DEDUP, "op11_quality_rules": QUALITY_RULES, "op12_lexical_search": LEXICAL_SEARCH}
