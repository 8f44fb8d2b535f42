"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from shelfcast.llm import decontamination, line_rules, reply_trees, substring

# Words of a text, as in the operators; a missing text has none.
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_PLAIN = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


def _masked(words: str, at: str, mask: str) -> str:
    """The words under a mask's ones, joined; positions count from 0."""
    return " || ' ' || ".join(f"{words}[{at} + {k + 1}]" for k, bit in enumerate(mask) if bit == "1")


def _seeds(words: str, at: str) -> str:
    parts = [
        f"CASE WHEN {at} + {len(mask)} <= len({words}) THEN '{n}:' || {_masked(words, at, mask)} END"
        for n, mask in enumerate(decontamination.MASKS)
    ]
    return f"[{', '.join(parts)}]"


_SPAN = max(map(len, decontamination.MASKS))
_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
i AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
dp AS (SELECT doc_id, w, unnest(range(len(w))) AS p FROM d),
ip AS (SELECT item_id, w, unnest(range(len(w))) AS q FROM i),
ds AS (SELECT doc_id, w, p, unnest({_seeds("w", "p")}) AS seed FROM dp),
s AS (SELECT item_id, w, q, unnest({_seeds("w", "q")}) AS seed FROM ip),
hit AS (
  SELECT doc_id, item_id, ds.w AS dw, s.w AS iw, p - q AS shift,
    greatest(0, q - {decontamination.CONTEXT}, q - p) AS low,
    least(len(s.w), q + {_SPAN + decontamination.CONTEXT}, len(ds.w) - (p - q)) AS high
  FROM ds JOIN s USING (seed)),
compared AS (
  SELECT *, len(list_filter(range(low, high), lambda j: dw[j + shift + 1] = iw[j + 1])) AS same
  FROM hit WHERE high - low >= least({decontamination.MIN_OVERLAP}, len(iw)))
SELECT doc_id, item_id, count(*) AS n_hits, max(same)::BIGINT AS equal_words,
  min(low + shift)::BIGINT AS first_word, max(high + shift)::BIGINT AS end_word
FROM compared WHERE same >= {decontamination.MIN_EQUAL}::DOUBLE * (high - low) GROUP BY doc_id, item_id
"""

_LIMITS = line_rules.PRODUCTION
_QUALITY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) > 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(5) AS o(k) GROUP BY doc_id),
l AS (SELECT doc_id, source, t, line, trim(regexp_replace(lower(line), '[\x09-\x0D\x20[:punct:]0-9]+', ' ', 'g'), ' ') AS plain
  FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
per_doc AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup, sum(length(line)) AS chars FROM l GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
common AS (
  SELECT source, plain FROM (SELECT source, plain, count(DISTINCT t) AS n FROM l WHERE plain <> '' GROUP BY source, plain) c
  JOIN hosts h USING (source) WHERE c.n > {_LIMITS.max_documents} AND c.n > {_LIMITS.max_share} * h.n),
lost AS (SELECT doc_id, sum(length(line)) AS chars FROM l JOIN common USING (source, plain) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(per_doc.n_dup, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost.chars, 0) AS lost_chars, coalesce(per_doc.chars, 0) AS chars
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN per_doc USING (doc_id) LEFT JOIN lost USING (doc_id)),
v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    lost_chars > {_LIMITS.max_lost}::DOUBLE * chars AS depleted FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  lost_chars::BIGINT AS lost_chars, depleted, NOT base_failed AND NOT depleted AS kept
FROM v
"""

_CONTROL = "|".join(c.replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for c in reply_trees.CONTROLS)


def _escaped(column: str, newline: str = "0") -> str:
    """Length of an escaped text."""
    slashes = rf"length({column}) - length(replace({column}, '\', ''))"
    return rf"length({column}) + {slashes} + 2 * len(regexp_extract_all({column}, '{_CONTROL}')) + {newline}"


_SAID = "</s>[INST] ok [/INST]"
_CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_SAID}' UNION ALL SELECT -1, 1, 'assistant', '{_SAID}'),
m AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = '{reply_trees.TRAINED}'), '') AS loss,
    sum({len(reply_trees.OPEN) + len(reply_trees.CLOSE) + 2} + ({_escaped("role", "length(role) - length(replace(role, chr(10), ''))")})
      + ({_escaped("text")})) AS chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  chars::BIGINT AS formatted_chars
FROM m
"""

_SUBSTRING = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, sha256(array_to_string(w[i : i + {substring.WINDOW - 1}], ' ')) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substring.WINDOW - 2})) AS i FROM d WHERE len(w) >= {substring.WINDOW})),
f AS (SELECT gram, min(doc_id) AS first_doc FROM g GROUP BY gram HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM g JOIN f USING (gram), range({substring.WINDOW}) AS o(k) WHERE first_doc < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body, count(*) AS n
  FROM (SELECT * FROM words ANTI JOIN gone USING (doc_id, i)) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# CRC-32 of a number's decimal text, bit by bit.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
  lambda crc, b: list_reduce(range(8),
    lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END, xor(crc, b)), 4294967295::BIGINT))"""

_TRIE = f"""
WITH c AS (
  SELECT conv_id, turn, md5(md5(coalesce(role, '')) || coalesce(text, '')) AS digest, strlen(coalesce(text, ''))::BIGINT AS size
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({{'digest': digest, 'size': size}} ORDER BY turn NULLS FIRST, digest) AS t FROM c GROUP BY conv_id),
h AS (SELECT conv_id, t, {_CRC32} % 9 AS h FROM l),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.t[1 : h.h], []), h.t[h.h + 1 :]) AS t
  FROM h LEFT JOIN l AS b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (
  SELECT conv_id, len(t) AS n, d, array_to_string(list_transform(t[1 : d], lambda x: x.digest), '') AS key,
    CASE WHEN d > 0 THEN array_to_string(list_transform(t[1 : d - 1], lambda x: x.digest), '') END AS parent,
    CASE WHEN d > 0 THEN t[d].size ELSE 0 END AS size
  FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM r)),
node AS (
  SELECT key, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM p GROUP BY key),
kids AS (SELECT parent AS key, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (key)),
below AS (
  SELECT left(key, 32 * d::INTEGER) AS key, sum((n_convs - 1) * size) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT key, n_convs, size, n_children, unnest(range(depth + 1)) AS d FROM full_) GROUP BY 1)
SELECT f.conv_id, f.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, f.n_convs, f.n_children, leaves AS n_leaves,
  saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_ f JOIN below USING (key) LEFT JOIN full_ a ON a.key = f.parent
"""

CHECKS = {
    "op1_benchmark_decontamination": _DECONTAMINATION,
    "op3_quality_rules": _QUALITY,
    "op5_chat_formatting": _CHAT,
    "op10_substring_dedup": _SUBSTRING,
    "op13_prefix_trie": _TRIE,
}
