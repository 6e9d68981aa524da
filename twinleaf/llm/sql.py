"""DuckDB renderings of the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))) END AS sh
  FROM words),
classes AS (SELECT md5(array_to_string(sh, chr(10))) AS cls, min(doc_id) AS rep, any_value(sh) AS sh FROM sets WHERE len(sh) > 0 GROUP BY 1),
flat AS (SELECT rep, len(sh) AS n, unnest(sh) AS s FROM classes),
common AS (SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS c FROM flat a JOIN flat b ON a.s = b.s AND a.rep < b.rep GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS x, rep AS y FROM classes UNION SELECT r.x, l.b FROM reach r JOIN both_ways l ON r.y = l.a),
comp AS (SELECT x AS rep, min(y) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(p.component_id, s.doc_id) AS component_id, s.doc_id = coalesce(p.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN classes c ON len(s.sh) > 0 AND c.cls = md5(array_to_string(s.sh, chr(10))) LEFT JOIN comp p ON p.rep = c.rep
"""


_RULES = ["symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share"]
_LADDER = [0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5]
_P = "(0.05 / 5)"
_LEVEL = f"(0.05 / (strata * {len(_RULES) * len(_LADDER)}))"


def _tail(x: str) -> str:
    return f"list_sum(list_transform(range(0, CAST({x} AS BIGINT) + 1), lambda k: exp(lgamma(n + 1.0) - lgamma(k + 1.0) - lgamma(n - k + 1.0) + k * ln({_P}) + (n - k) * ln(1 - {_P}))))"


def _choice(r: str) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN {r}_{k} < n * {_P} AND {_tail(f'{r}_{k}')} <= {_LEVEL} THEN {c} END" for k, c in enumerate(_LADDER)) + f") AS cut_{r}"


QUALITY_RULES = rf"""
WITH parts AS (
  SELECT doc_id, coalesce(lang, chr(1)) AS stratum, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM parts WHERE len(ws) >= 5)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM twice) GROUP BY 1),
counts AS (
  SELECT doc_id, stratum, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
    coalesce(n, 0) AS n_repeat_words, length(t) - length(translate(t, '{UPPER}', '')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_bang
  FROM parts LEFT JOIN covered USING (doc_id)),
features AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_share, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_share,
    coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_share, coalesce(n_upper / nullif(word_chars, 0), 0) AS upper_share, coalesce(n_bang / nullif(word_chars, 0), 0) AS bang_share
  FROM counts),
good AS (SELECT * FROM features WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
counted AS (
  SELECT stratum, CAST(count(*) AS DOUBLE) AS n, count(*) OVER () AS strata, {", ".join(f"count(*) FILTER (WHERE {r} > {c}) AS {r}_{k}" for r in _RULES for k, c in enumerate(_LADDER))}
  FROM good GROUP BY stratum),
chosen AS (SELECT stratum, {", ".join(map(_choice, _RULES))} FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(f"NOT coalesce({r} > cut_{r}, false)" for r in _RULES)} AS kept, {", ".join(_RULES)}
FROM features LEFT JOIN chosen USING (stratum)
"""

SQL = {"op1_minhash": NEAR_DUPLICATES, "op7_quality_rules": QUALITY_RULES}
