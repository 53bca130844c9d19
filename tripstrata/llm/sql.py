"""Text queries in DuckDB SQL, written from what they return rather than how."""

from __future__ import annotations

from tripstrata.llm import decontaminate, licenses, quality_rules, secret_scan

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

BENCHMARK_WINDOWS = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
patterns AS (
  SELECT DISTINCT item, w[i : i + {decontaminate.WINDOW - 1}] AS p
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {decontaminate.WINDOW - 1}, 1) + 1)) AS i
        FROM items WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT len(p) AS size FROM patterns),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, size, i, w[i : i + size - 1] AS p
  FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM docs JOIN lengths ON len(w) >= size)
),
hits AS (SELECT doc_id, size, i, item FROM places JOIN patterns USING (p)),
words_hit AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
),
items_hit AS (
  SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(words_hit.n, 0) AS n_hit, coalesce(items_hit.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(words_hit.n, 0) > 0 AND {decontaminate.HIT_DIVISOR} * coalesce(words_hit.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)"""


def quality_rules_sql(risk: float = quality_rules.RISK, error: float = quality_rules.ERROR) -> str:
    rules = {
        "symbols": "n_symbols / nullif(n_words, 0)",
        "capitals": "n_capitals / greatest(word_chars, 1)",
        "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeated_words": "n_repeat_words / nullif(n_words, 0)",
        "long_words": "word_chars / nullif(n_words, 0)",
    }
    grid = ", ".join(f"('{rule}', {cut}::DOUBLE)" for rule, (_, cuts) in quality_rules.RULES.items() for cut in cuts)
    values = " UNION ALL ".join(
        f"SELECT doc_id, stratum, '{rule}' AS rule, coalesce(CAST({value} AS DOUBLE), 0) AS value FROM measured"
        for rule, value in rules.items()
    )
    p = risk / len(rules)
    term = f"exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({p}) + (n - j) * ln(1 - {p}))"
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i : i + 4]) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) >= 5)
),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM windows WHERE times > 1) GROUP BY doc_id
),
measured AS (
  SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN repeated USING (doc_id)
),
rated AS ({values}),
known AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
grid(rule, cutoff) AS (VALUES {grid}),
tests AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (WHERE good) AS n,
         count(*) FILTER (WHERE good AND value > cutoff) AS k,
         count(*) FILTER (WHERE NOT good AND value > cutoff) AS caught
  FROM rated JOIN known USING (doc_id) JOIN grid USING (rule) GROUP BY ALL
),
proven AS (
  SELECT *, CASE WHEN k < n * {p} THEN list_sum(list_transform(range(0, k + 1), lambda j: {term})) ELSE 1 END AS tail
  FROM tests
),
chosen AS (
  SELECT stratum, rule, arg_max(cutoff, caught - k + cutoff * 1e-6) AS cutoff
  FROM proven WHERE tail <= {error} / (SELECT count(*) FROM tests) AND caught > k GROUP BY ALL
),
rejected AS (SELECT DISTINCT doc_id FROM rated JOIN chosen USING (stratum, rule) WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM measured"""


def secrets_sql() -> str:
    def found(name: str, pattern: str, kind: int, group: int) -> str:
        literal = pattern.replace("'", "''")
        return f"""
{name} AS (
  SELECT doc_id, {kind} AS kind, list_sum(list_transform(gaps[1 : i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(whole[1 : i - 1], lambda x: length(x))), 0) AS start,
         length(whole[i]) AS size, parts[i] AS value
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i
        FROM (SELECT doc_id, string_split_regex(text, '{literal}') AS gaps, regexp_extract_all(text, '{literal}', 0) AS whole,
                     regexp_extract_all(text, '{literal}', {group}) AS parts FROM docs))
)"""

    kinds = ", ".join(f"'{kind}'" for kind in secret_scan.KINDS)
    listed = f"string_agg(([{kinds}])[kind + 1] || ':' || start || ':' || (start + size), ',' ORDER BY start, kind)"
    placeholders = secret_scan.PLACEHOLDERS.replace("'", "''")
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS repository,
         coalesce(split_part(source, '/', 1), '') AS owner FROM documents
),
{found("assign", secret_scan.ASSIGN, 0, 2)},
{found("access", secret_scan.ACCESS, 1, 0)},
{found("hex", secret_scan.HEX, 2, 0)},
{found("opaque", secret_scan.OPAQUE, 3, 0)},
base AS (
  SELECT * FROM assign WHERE length(value) >= {secret_scan.VALUE_LENGTH}
  UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex
),
every AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM opaque o
  WHERE regexp_matches(value, '[0-9].*[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND b.start < o.start + o.size AND o.start < b.start + b.size)
),
held AS (SELECT value, count(DISTINCT owner) AS owners FROM every JOIN docs USING (doc_id) GROUP BY value),
judged AS (
  SELECT every.*, owners >= {secret_scan.WIDE_OWNERS} AS wide,
         len(list_distinct(string_split(value, ''))) >= {secret_scan.LIVE_CHARACTERS}
           AND NOT regexp_matches(value, '{placeholders}') AS live
  FROM every JOIN held USING (value)
),
kept AS (SELECT * FROM judged WHERE kind < 3 OR (live AND NOT wide)),
spans AS (
  SELECT doc_id, {listed} AS spans, count(*) FILTER (WHERE live AND NOT wide) AS n_live, count(*) FILTER (WHERE wide) AS n_shared
  FROM kept GROUP BY doc_id
),
bases AS (
  SELECT doc_id, {listed} AS listed, count(*) FILTER (WHERE kind = 0) AS n_assign,
         count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex
  FROM base GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(listed, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared
FROM docs LEFT JOIN bases USING (doc_id) LEFT JOIN spans USING (doc_id)"""


def crc32_sql(text: str) -> str:
    """The checksum of an ASCII string, bit by bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda acc, x: {step}), 4294967295::BIGINT)"


PERIODIC_RUNS = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents
),
tails AS (
  SELECT doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AND len(w) > 0 AS tail, h // 10 AS g, (h // 10) % nullif(len(w), 0) AS a
  FROM docs
),
texts AS (
  SELECT doc_id, n, CASE WHEN tail THEN list_transform(range(n), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE w END AS w
  FROM tails
),
words AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
pairs AS (
  SELECT doc_id, x.i AS i, y.i - x.i AS q FROM words x JOIN words y USING (doc_id, word)
  WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length
),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id
),
best AS (
  SELECT r.* FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (
      o.length * r.period > r.length * o.period
      OR o.length * r.period = r.length * o.period AND (o.start, o.period) < (r.start, r.period)))
),
gone AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM runs)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256, n AS n_words
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""

# A node is the list of its turns; subtrees come from comparing lists.
CONVERSATION_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, count(*) AS own, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h, conv_id - (conv_id % 5 + 5) % 5 AS base
  FROM turns GROUP BY conv_id
),
rebuilt AS (
  SELECT c.conv_id, t.pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.own, 0)), role, text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN convs b ON b.conv_id = c.base
),
paths AS (
  SELECT conv_id, coalesce(path, []) AS path FROM convs LEFT JOIN (
    SELECT conv_id, list(length(role) || ':' || role || text ORDER BY pos) AS path FROM rebuilt GROUP BY conv_id) USING (conv_id)
),
bytes AS (SELECT length(role) || ':' || role || text AS last, any_value(strlen(text)) AS n FROM rebuilt GROUP BY 1),
members AS (SELECT conv_id, d AS depth, path[1 : d] AS node FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs FROM members GROUP BY depth, node),
weighed AS (
  SELECT depth, node, nodes.conv_id, n_convs, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * bytes.n END AS weight,
         (SELECT count(*) FROM nodes c WHERE c.depth = nodes.depth + 1 AND c.node[1 : nodes.depth] = nodes.node) AS n_children
  FROM nodes LEFT JOIN bytes ON bytes.last = nodes.node[-1]
),
subtrees AS (
  SELECT a.depth, a.node, sum(b.weight)::BIGINT AS saved_tokens, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves
  FROM weighed a JOIN weighed b ON b.depth >= a.depth AND b.node[1 : a.depth] = a.node GROUP BY a.depth, a.node
),
ends AS (SELECT path AS node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM paths GROUP BY path)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM weighed w JOIN subtrees s ON s.depth = w.depth AND s.node = w.node
LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.node = w.node[1 : w.depth - 1]
LEFT JOIN ends e ON e.node = w.node"""


ORACLE: dict[str, str] = {
    "op1_secret_scan": secrets_sql(),
    "op4_benchmark_decontamination": BENCHMARK_WINDOWS,
    "op7_quality_rules": quality_rules_sql(),
    "op8_license_scan": licenses.oracle_sql(),
    "op11_periodic_runs": PERIODIC_RUNS,
    "op13_conversation_trie": CONVERSATION_TRIE,
}
