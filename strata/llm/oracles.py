"""DuckDB SQL for the operator queries that SQL can express."""

from __future__ import annotations

from strata.llm import license_scan as ls
from strata.llm import quality_rules as qr

_LADDER = ", ".join(str((i, *cuts)) for i, cuts in enumerate(qr.LADDER, 1))
_RULE_CTES = rf"""
d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(t, '{qr.SPACE_RUN}'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, lang, len(words) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals
  FROM w LEFT JOIN repeats USING (doc_id)),
verdict AS (
  SELECT *, n_words < {qr.MIN_WORDS} OR 100 * n_repeat_words > {qr.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         coalesce(lang, '{qr.OTHER}') AS tongue,
         {", ".join(f"CASE WHEN {whole} > 0 THEN 1000 * {part} // {whole} ELSE 0 END AS {m}"
                    for m, (part, whole) in qr.METRICS.items())}
  FROM counts),
ladder AS (SELECT * FROM (VALUES {_LADDER}) x(rung, {", ".join(f"c_{m}" for m in qr.METRICS)})),
clean AS (
  SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(toxic) = 0),
trials AS (
  SELECT t, min(tongue) AS tongue, {", ".join(f"min({m}) AS {m}" for m in qr.METRICS)}
  FROM verdict JOIN clean USING (doc_id) JOIN (SELECT doc_id, t FROM d) USING (doc_id)
  WHERE NOT base_failed GROUP BY t),
strata AS (
  SELECT tongue FROM trials WHERE tongue <> '{qr.OTHER}' GROUP BY tongue
  HAVING count(*) >= {qr.MIN_TEXTS} AND 1000 * count(*) >= (SELECT count(*) FROM trials)),
tests AS (
  SELECT CASE WHEN tongue IN (FROM strata) THEN tongue ELSE '{qr.OTHER}' END AS stratum, rung, count(*) AS n,
         count(*) FILTER (WHERE {" OR ".join(f"{m} > c_{m}" for m in qr.METRICS)}) AS k
  FROM trials, ladder GROUP BY ALL),
reached AS (
  SELECT stratum, max(rung) AS rung FROM tests
  WHERE k < {qr.STRATUM_RISK} * n
    AND list_sum(list_transform(range(0, k + 1), lambda j: exp(
          lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
          + j * ln({qr.STRATUM_RISK}) + (n - j) * ln(1 - {qr.STRATUM_RISK}))))
        <= {qr.DELTA} / (1 + (SELECT count(*) FROM strata))
  GROUP BY ALL),
rejected AS (
  SELECT doc_id FROM verdict
  JOIN reached ON stratum = CASE WHEN tongue IN (FROM strata) THEN tongue ELSE '{qr.OTHER}' END
  JOIN ladder USING (rung)
  WHERE {" OR ".join(f"{m} > c_{m}" for m in qr.METRICS)})
"""



def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_TEMPLATES = ", ".join(
    f"({i}, '{t.label}', {str(t.base).lower()}, {_list(t.key)}, {t.key_at}, {_list(t.words)})"
    for i, t in enumerate(ls.TEMPLATES))

_LICENSES = rf"""WITH t(k, label, base, phrase, key_at, words) AS (VALUES {_TEMPLATES}),
d AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '{ls.SEPARATORS}'), lambda x: x <> '') AS w
  FROM documents),
starts AS (
  SELECT doc_id, k, unnest(list_filter(range(1, len(w) + 1),
           lambda i: w[i] = phrase[1] AND w[i : i + len(phrase) - 1] = phrase)) AS pos
  FROM d, t WHERE list_has_all(w, phrase)),
met AS (
  SELECT doc_id, label, base, pos - 1 AS pos,
         len(list_filter(range(1, len(words) + 1),
             lambda j: starts.pos - key_at + j - 1 >= 1 AND w[starts.pos - key_at + j - 1] = words[j])) / len(words) AS cover
  FROM starts JOIN t USING (k) JOIN d USING (doc_id)),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(pos) FILTER (WHERE base) AS first_word,
         max(pos) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
  FROM met GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN per_doc USING (doc_id)"""

_PERSPECTIVES = """WITH c AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM c WHERE role <> 'system'),
s AS (
  SELECT c.conv_id, perspective, turn, role, body, role = perspective AS own,
         CASE WHEN role = perspective THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
              ELSE '<|user name=' || role || '|>' END || chr(10) AS head,
         head || body || '<|end|>' || chr(10) AS segment
  FROM c JOIN p ON c.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (
  SELECT *, row_number() OVER w - 1 AS position,
         coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, body))
SELECT conv_id, perspective, position, segment, CAST(start AS BIGINT) AS start,
       CASE WHEN own THEN CAST(start + length(head) AS BIGINT) END AS mask_start,
       CASE WHEN own THEN CAST(start + length(segment) - 1 AS BIGINT) END AS mask_end
FROM o"""

_FILL_IN_MIDDLE = r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, len(w) AS n,
         CAST('0x' || s[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || s[9:16] AS BIGINT) % (n + 1) AS b,
         CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4
  FROM d),
p AS (
  SELECT *, array_to_string(w[1 : least(a, b)], '') AS prefix,
         array_to_string(w[least(a, b) + 1 : greatest(a, b)], '') AS middle,
         array_to_string(w[greatest(a, b) + 1 :], '') AS suffix,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""

_JACCARD = r"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach AS (
  SELECT doc_id AS v, doc_id AS r FROM d
  UNION
  SELECT b, r FROM reach JOIN links ON a = v)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY v) USING (doc_id)"""

# CRC-32 of a decimal id, bit by bit: its reversed polynomial is 3988292384.
_TRIE = r"""WITH o AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS x
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, x, xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda c: CAST(ord(c) AS BIGINT)),
           lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda z, k: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384) ELSE z >> 1 END)), 4294967295) % 6 AS h
  FROM o),
b AS (
  SELECT h.conv_id, coalesce(p.x[1 : h.h], []) || h.x[h.h + 1 :] AS x
  FROM h LEFT JOIN o p ON p.conv_id = h.conv_id - h.conv_id % 100),
m AS (
  SELECT conv_id, d, x[1 : d] AS k, len(x) = d AS ends, CASE WHEN d > 0 THEN length(x[d].t) ELSE 0 END AS c
  FROM (SELECT conv_id, x, unnest(range(0, len(x) + 1)) AS d FROM b)),
n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(c) AS c,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM m GROUP BY k, d),
p AS (SELECT m.conv_id AS member, d, n.conv_id AS node FROM m JOIN n USING (k, d)),
kids AS (SELECT p.node, p.d, count(*) AS c FROM n JOIN p ON p.member = n.conv_id AND p.d = n.d - 1 GROUP BY ALL),
sub AS (
  SELECT p.node, p.d, sum((n.n_convs - 1) * n.c) AS saved, count(*) FILTER (WHERE kids.c IS NULL) AS leaves
  FROM n JOIN p ON p.member = n.conv_id AND p.d <= n.d LEFT JOIN kids ON kids.node = n.conv_id AND kids.d = n.d
  GROUP BY p.node, p.d)
SELECT n.conv_id, n.d AS depth, up.node AS parent_conv_id, n_convs, coalesce(kids.c, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM n LEFT JOIN p up ON up.member = n.conv_id AND up.d = n.d - 1 LEFT JOIN kids ON kids.node = n.conv_id AND kids.d = n.d
JOIN sub ON sub.node = n.conv_id AND sub.d = n.d"""

ORACLE: dict[str, str] = {
    "op13_prefix_trie": _TRIE,
    "op12_ngram_jaccard": _JACCARD,
    "op11_fill_in_middle": _FILL_IN_MIDDLE,
    "op3_license_scan": _LICENSES,
    "op4_chat_formatting": _PERSPECTIVES,
    "op10_quality_rules": f"""WITH {_RULE_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM verdict""",
}
