"""DuckDB renderings of the registered queries."""

LEMMAS = {"widget": "part", "bolt": "part", "ring": "part", "red": "colour", "blue": "colour", "small": "size", "large": "size", "the": "a"}

_W = r"[\p{L}\p{N}_]"
_STOP = "['and', 'de', 'die', 'example', 'la', 'of', 'the']"


def _lemmas(text: str) -> str:
    """The content tokens of a text (identity lemmatiser)."""
    found = rf"regexp_extract_all(translate(lower({text}), 'ёЁ', 'еЕ'), '[\p{{L}}\p{{N}}]+(?:-[\p{{L}}\p{{N}}]+)*')"
    return rf"list_filter({found}, lambda x: NOT list_contains({_STOP}, x) AND length(x) >= 2 AND NOT regexp_matches(x, '^[\p{{Nd}}²³¹⁰⁴-⁹₀-₉]+$'))"


def _has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


_COMPANY, _ORG = rf"(^|[^\p{{L}}\p{{N}}_])com($|[^\p{{L}}\p{{N}}_])", rf"(^|[^\p{{L}}\p{{N}}_])org($|[^\p{{L}}\p{{N}}_])"
_INNER = rf"(^|[^\p{{L}}\p{{N}}_])(in{_W}*\s+th{_W}*|into($|[^\p{{L}}\p{{N}}_]))"


def _labels(t: str) -> str:
    return f"list_filter([CASE WHEN {_has(t, _COMPANY)} THEN 'company' END, CASE WHEN {_has(t, _INNER)} THEN 'inner' END, CASE WHEN {_has(t, _ORG)} THEN 'organisation' END], lambda x: x IS NOT NULL)"


def _markers(t: str) -> str:
    t = f"lower({t})"
    return " + ".join(f"CAST({_has(t, rf'(^|[^\p{{L}}\p{{N}}_]){p}')} AS INTEGER)" for p in (r"https($|[^\p{L}\p{N}_])", "spam", r"ads($|[^\p{L}\p{N}_])"))


_RECORDS = r"""
records AS (
  SELECT id, section, trim(name) AS name, pos FROM (
    SELECT CAST(page_id AS VARCHAR) AS id, page_id AS pos, regexp_extract(html, '<title>([^<]*)</title>', 1) AS name,
      regexp_extract(url, '^([a-z]+)://', 1) || ' / ' || regexp_extract(regexp_extract(url, '://([^/?#]*)', 1), '([^.]+\.[^.]+)$', 1) || ' / ' || regexp_extract(url, '://[^/?#]*/([^/?#]*)', 1) AS section
    FROM pages) WHERE trim(name) <> ''),
parsed AS (SELECT *, list_filter(list_transform(string_split(section, ' / '), lambda x: trim(x)), lambda x: x <> '') AS segments FROM records)"""
_SECTIONS = rf"""{_RECORDS},
sect0 AS (SELECT DISTINCT section, {_lemmas("section")} AS ls FROM records),
sect1 AS (SELECT section, {_labels("array_to_string(ls, ' ')")} AS types, {_markers("array_to_string(ls, ' ')")} AS score FROM sect0),
sect AS (
  SELECT section AS section_path, types, score,
    CASE WHEN len(types) > 0 AND score > 0 THEN 'mixed' WHEN len(types) > 0 THEN 'transfer-type' WHEN score > 0 THEN 'feature' ELSE 'unknown' END AS category,
    CASE WHEN len(types) > 0 AND score > 0 THEN 0.55 WHEN len(types) > 0 OR score > 0 THEN 0.9 ELSE 0.0 END AS confidence
  FROM sect1),
final AS (
  SELECT section_path, types,
    CASE WHEN confidence >= 0.7 THEN category WHEN contains(section_path, 'example.net') THEN CASE WHEN category = 'mixed' THEN 'mixed' WHEN len(types) > 0 THEN 'transfer-type' ELSE 'feature' END WHEN category = 'unknown' THEN 'other' ELSE category END AS category,
    CASE WHEN confidence >= 0.7 THEN 'heuristic' WHEN contains(section_path, 'example.net') THEN 'llm' ELSE 'fallback' END AS source,
    CASE WHEN confidence < 0.7 AND contains(section_path, 'example.net') THEN 'rule' END AS reason
  FROM sect)"""
_FEATURES = rf"""{_SECTIONS},
feat0 AS (SELECT p.id, p.name, p.section, p.segments, f.category, f.types AS st, array_to_string({_lemmas("p.name")}, ' ') AS t FROM parsed p LEFT JOIN final f ON p.section = f.section_path),
feat AS (
  SELECT *, list_sort(list_distinct(list_concat(coalesce(st, []), {_labels("t")}))) AS types, lower(coalesce(segments[len(segments)], '')) AS key FROM feat0),
items AS (
  SELECT id, CASE WHEN len(types) > 0 THEN array_to_string(types, '|') ELSE '__feature__|' || key END AS block, coalesce(nullif(trim(t), ''), name, '') AS text FROM feat)"""


def _weights(prefix: str, items: str, grams: str) -> str:
    return f"""
{prefix}g AS (SELECT block, id, unnest({grams}) AS term FROM {items}),
{prefix}tf AS (SELECT block, id, term, 1 + ln(count(*)) AS tf FROM {prefix}g GROUP BY ALL),
{prefix}df AS (SELECT block, term, count(*) AS df FROM {prefix}tf GROUP BY ALL),
{prefix}n AS (SELECT block, count(*) AS n FROM {items} GROUP BY ALL),
{prefix}w0 AS (SELECT block, id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM {prefix}tf JOIN {prefix}df USING (block, term) JOIN {prefix}n USING (block)),
{prefix}w AS (SELECT block, id, term, w / sqrt(sum(w * w) OVER (PARTITION BY block, id)) AS w FROM {prefix}w0),
{prefix}sim AS (SELECT a.block, a.id AS a_id, b.id AS b_id, sum(a.w * b.w) AS sim FROM {prefix}w a JOIN {prefix}w b ON a.block = b.block AND a.term = b.term AND a.id < b.id GROUP BY ALL)"""


_CHARS = r"flatten(list_transform(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> ''), lambda w: flatten(list_transform(range(3, least(5, length(w) + 2) + 1), lambda n: list_transform(range(1, length(w) + 2 - n + 2), lambda i: substring(' ' || w || ' ', i, n))))))"
_WORD_LIST = rf"regexp_extract_all(lower(text), '{_W}+')"
_WORDS = f"list_concat({_WORD_LIST}, list_transform(range(1, len({_WORD_LIST})), lambda i: ({_WORD_LIST})[i] || ' ' || ({_WORD_LIST})[i + 1]))"


def _ratio(pairs: str) -> str:
    """fz (a_id, b_id, fuzz) of a relation (a_id, b_id, a, b): the longest common subsequence by a fold over rows of the table."""
    words = lambda c: rf"list_distinct(list_filter(regexp_split_to_array({c}, '\s+'), lambda x: x <> ''))"
    return f"""
fz0 AS (SELECT a_id, b_id, {words("a")} AS wa, {words("b")} AS wb FROM {pairs}),
fz1 AS (SELECT *, list_intersect(wa, wb) AS i, array_to_string(list_sort(list_filter(wa, lambda x: NOT list_contains(wb, x))), ' ') AS x, array_to_string(list_sort(list_filter(wb, lambda x: NOT list_contains(wa, x))), ' ') AS y FROM fz0),
fz2 AS (SELECT *, length(array_to_string(i, ' ')) AS s, CAST(len(i) > 0 AS INTEGER) AS g, length(x) AS lx, length(y) AS ly,
  CASE WHEN length(x) = 0 OR length(y) = 0 THEN 0 ELSE list_last(list_reduce(
    list_concat([list_transform(range(0, length(y) + 1), lambda j: 0)], list_transform(range(1, length(x) + 1), lambda k: [CAST(k AS INTEGER)])),
    lambda row, k: list_transform(range(1, length(y) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda m: greatest(row[m], CASE WHEN m > 1 AND substring(x, k[1], 1) = substring(y, m - 1, 1) THEN row[m - 1] + 1 ELSE 0 END)))))) END AS lcs
  FROM fz1),
fz AS (SELECT a_id, b_id, CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0.0 WHEN len(i) > 0 AND (lx = 0 OR ly = 0) THEN 1.0 ELSE
    greatest(1 - (lx + ly - 2 * lcs) / (2 * (s + g) + lx + ly), CASE WHEN s > 0 THEN 1 - (g + lx) / (s + s + g + lx) ELSE 0 END, CASE WHEN s > 0 THEN 1 - (g + ly) / (s + s + g + ly) ELSE 0 END) END AS fuzz
  FROM fz2)"""


_CANDIDATES = rf"""{_FEATURES},{_weights("c", "items", _CHARS)},{_weights("v", "items", _WORDS)},
pre AS (SELECT * FROM (SELECT block, a_id, b_id, coalesce(c.sim, 0) AS tc, coalesce(v.sim, 0) AS tw FROM csim c FULL JOIN vsim v USING (block, a_id, b_id)) WHERE greatest(tc, tw) >= 0.6 * 0.55),
named AS (SELECT a_id, b_id, x.text AS a, y.text AS b FROM pre JOIN items x ON x.id = a_id JOIN items y ON y.id = b_id),{_ratio("named")},
scored AS (SELECT * FROM (SELECT pre.*, fuzz, 0.40 * tc + 0.25 * tw + 0.35 * fuzz AS score FROM pre JOIN fz USING (a_id, b_id)) WHERE score >= 0.55),
ends AS (SELECT a_id, b_id, score, a_id AS me, b_id AS other FROM scored UNION ALL SELECT a_id, b_id, score, b_id, a_id FROM scored),
top AS (SELECT DISTINCT a_id, b_id FROM (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY me ORDER BY round(score, 10) DESC, other) <= 5)),
cand AS (
  SELECT 'p_' || a_id || '__' || b_id AS pair_id, a_id, b_id, round(score, 4) AS score, round(tc, 4) AS tfidf_char, round(tw, 4) AS tfidf_word, round(fuzz, 4) AS fuzz,
    CASE WHEN score >= 0.85 THEN 'high_confidence' ELSE 'candidate' END AS tier, block AS block_key
  FROM scored SEMI JOIN top USING (a_id, b_id)),
batched AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY score DESC, pair_id) - 1) / 25) + 1 AS INTEGER) AS batch_id FROM cand)"""
_VERDICTS = rf"""{_CANDIDATES},
marks AS (SELECT id, regexp_matches(lower(name), 'st') AS m FROM feat),
given AS (
  SELECT pair_id, CASE WHEN x.m <> y.m THEN 'different_functionality' WHEN score >= 0.55 THEN 'duplicate' ELSE 'different_functionality' END AS verdict,
    CASE WHEN x.m <> y.m THEN 'one title is negative' WHEN score >= 0.55 THEN 'titles agree' ELSE 'titles differ' END AS reason
  FROM cand JOIN marks x ON x.id = a_id JOIN marks y ON y.id = b_id WHERE (CAST(a_id AS BIGINT) + CAST(b_id AS BIGINT)) % 3 <> 0),
verd AS (SELECT c.pair_id, coalesce(g.verdict, 'uncertain') AS verdict, CASE WHEN g.pair_id IS NULL THEN 'no verdict from LLM' ELSE g.reason END AS reason, a_id, b_id, score, tier FROM cand c LEFT JOIN given g USING (pair_id))"""
_GROUPS = rf"""{_VERDICTS},
edge AS (SELECT a_id, b_id FROM verd WHERE verdict = 'duplicate'),
two AS (SELECT a_id AS x, b_id AS y FROM edge UNION ALL SELECT b_id, a_id FROM edge),
reach AS (SELECT DISTINCT x, x AS y FROM two UNION SELECT r.x, t.y FROM reach r JOIN two t ON r.y = t.x),
comp AS (SELECT x AS id, min(y) AS c FROM reach GROUP BY 1),
grp AS (
  SELECT count(*) AS size, list_sort(list(comp.id)) AS members, list_sort(list_distinct(list(types))) AS sets, any_value(n_edges) AS n_edges
  FROM comp LEFT JOIN feat USING (id) JOIN (SELECT c, count(*) AS n_edges FROM edge JOIN comp ON comp.id = a_id GROUP BY 1) USING (c) GROUP BY comp.c)"""
_TYPES = "CASE WHEN {0}.id IS NULL THEN '?' WHEN len({0}.types) > 0 THEN array_to_string({0}.types, ', ') ELSE '∅' END"


def _pair_table(verdict: str) -> str:
    return f"""WITH {_CANDIDATES},
judged AS (
  SELECT pair_id, a_id, b_id, score, x.name AS a_name, x.section AS a_section, {_TYPES.format("x")} AS a_types, y.name AS b_name, y.section AS b_section, {_TYPES.format("y")} AS b_types,
    (CAST(a_id AS BIGINT) + CAST(b_id AS BIGINT)) % 2 = 0 AS even
  FROM cand LEFT JOIN feat x ON x.id = a_id LEFT JOIN feat y ON y.id = b_id)
SELECT pair_id, a_id, b_id, format('{{:.3f}}', round(score + 1e-9, 3)) AS score, CASE WHEN even THEN 'by section' ELSE 'no reason given' END AS reason, a_name, a_section, a_types, b_name, b_section, b_types
FROM judged WHERE CASE WHEN a_section <> b_section THEN 'different_transfer_type' WHEN even THEN 'different_functionality' ELSE 'uncertain' END = '{verdict}'"""


_NUMBERED = f"""{_GROUPS},
numbered AS (SELECT c, row_number() OVER (ORDER BY count(*) DESC, list_sort(list(id))) AS number FROM comp GROUP BY c)"""
_PARTS = "items AS (SELECT p_brand AS block, p_partkey AS id, p_name AS text FROM part)"
_STEMS = "list_concat(list_concat(CASE WHEN list_contains(ls, 'company') THEN ['bcom'] ELSE [] END, CASE WHEN list_contains(ls, 'inner') THEN ['bin', 'binto'] ELSE [] END), CASE WHEN list_contains(ls, 'organisation') THEN ['borg'] ELSE [] END)"

SQL = {
    "parse_records": f"WITH {_RECORDS} SELECT id, section, array_to_string(segments, '|') AS segments, trim(name) AS name, lower(coalesce(segments[len(segments)], '')) AS secondary_key FROM parsed",
    "section_profile": f"WITH {_RECORDS} SELECT section, array_to_string(any_value(segments), '|') AS segments, count(*) AS n, array_to_string(list_slice(list(name ORDER BY pos), 1, 5), '|') AS sample_names FROM parsed GROUP BY section",
    "repeated_keys": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1",
    "normalize_documents": f"SELECT doc_id, len(ls) AS n_lemmas, substring(sha256(array_to_string(ls, ' ')), 1, 16) AS text_hash FROM (SELECT doc_id, {_lemmas('text')} AS ls FROM documents)",
    "lemma_lookup": f"SELECT p_partkey AS id, array_to_string(list_filter(list_transform({_lemmas('p_name')}, lambda x: coalesce(MAP {{{', '.join(f"'{k}': '{v}'" for k, v in LEMMAS.items())}}}[x], x)), lambda x: length(x) >= 2 AND NOT list_contains({_STOP}, x)), ' ') AS lemma_text FROM part",
    "label_extract": f"WITH {_RECORDS}, l AS (SELECT id, section, {_lemmas('name')} AS w FROM records), m AS (SELECT *, {_labels("array_to_string(w, ' ')")} AS ls FROM l) SELECT id, array_to_string(ls, ',') AS labels, {_markers('section')} AS n_markers, array_to_string(list_filter(w, lambda x: len(list_filter({_STEMS}, lambda s: starts_with(x, s) OR starts_with(s, x))) = 0), ' ') AS stripped_name FROM m",
    "classify_sections": f"WITH {_SECTIONS} SELECT section_path, category, array_to_string(types, ',') AS types, score AS feature_score, confidence FROM sect",
    "route_sections": f"WITH {_SECTIONS} SELECT section_path, CASE WHEN confidence >= 0.7 THEN 'classified' ELSE 'ambiguous' END AS route FROM sect",
    "merge_labels": f"WITH {_SECTIONS} SELECT section_path, category, array_to_string(types, ',') AS types, source, reason FROM final",
    "feature_table": f"WITH {_FEATURES} SELECT id, coalesce(category, 'other') AS section_category, t AS name_lemma_text, array_to_string(types, ',') AS types, key AS feature_block_key, block AS block_key FROM feat JOIN items USING (id)",
    "char_grams": f"SELECT gram, count(*) AS n FROM (SELECT unnest({_CHARS}) AS gram FROM (SELECT p_name AS text FROM part)) GROUP BY 1",
    "word_grams": f"WITH {_RECORDS} SELECT gram, count(*) AS n FROM (SELECT unnest({_WORDS}) AS gram FROM (SELECT name AS text FROM records)) GROUP BY 1",
    "tfidf_weights": f"WITH {_PARTS},{_weights('v', 'items', _WORDS)} SELECT block, id, term, round(w, 6) AS w FROM vw",
    "cosine_pairs_char": f"WITH {_FEATURES},{_weights('c', 'items', _CHARS)} SELECT a_id, b_id, round(sim, 4) AS sim FROM csim",
    "cosine_pairs_word": f"WITH {_FEATURES},{_weights('v', 'items', _WORDS)} SELECT a_id, b_id, round(sim, 4) AS sim FROM vsim",
    "token_set_ratios": f"WITH {_RECORDS}, r AS (SELECT id, name, string_split(name, ' ')[1] AS k FROM records), pairs AS (SELECT x.id AS a_id, y.id AS b_id, x.name AS a, y.name AS b FROM r x JOIN r y ON x.k = y.k AND x.id < y.id),{_ratio('pairs')} SELECT a_id, b_id, round(fuzz, 6) AS ratio FROM fz",
    "candidates": f"WITH {_CANDIDATES} SELECT * FROM cand",
    "topk_union_ties": f"WITH {_PARTS},{_weights('v', 'items', _WORDS)}, ends AS (SELECT a_id, b_id, sim, a_id AS me, b_id AS other FROM vsim UNION ALL SELECT a_id, b_id, sim, b_id, a_id FROM vsim) SELECT DISTINCT a_id, b_id, round(sim, 4) AS score FROM (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY me ORDER BY round(sim, 10) DESC, other) <= 5)",
    "batch_pairs": f"WITH {_CANDIDATES} SELECT batch_id, pair_id, tier, x.name AS a_name, y.section AS b_section, array_to_string(x.types, ',') AS a_types FROM batched JOIN feat x ON x.id = a_id JOIN feat y ON y.id = b_id",
    "batch_manifest": f"WITH {_CANDIDATES} SELECT batch_id, format('batch_{{:04d}}.json', batch_id) AS file, format('batch_{{:04d}}.jsonl', batch_id) AS verdict_file, count(*) AS n FROM batched GROUP BY batch_id",
    "verdict_parse": "SELECT 'p_' || user_id AS pair_id, ['duplicate', 'different_transfer_type', 'different_functionality', 'uncertain', 'maybe'][event_id % 5 + 1] AS verdict, CASE WHEN event_id % 23 = 0 THEN '' ELSE event_type END AS reason, CAST(event_id % 3 AS INTEGER) AS batch_id, event_id AS line_no FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 5 <> 4 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 DESC, event_id DESC) = 1",
    "merge_verdicts": f"WITH {_VERDICTS} SELECT * FROM verd",
    "pending_pairs": f"WITH {_VERDICTS} SELECT pair_id, a_id, b_id FROM verd WHERE reason = 'no verdict from LLM'",
    "duplicate_groups": f"WITH RECURSIVE {_GROUPS} SELECT row_number() OVER (ORDER BY size DESC, members) AS number, size, array_to_string(members, ',') AS member_ids, array_to_string(list_transform(sets, lambda x: '{{' || array_to_string(x, ',') || '}}'), ' ') AS types, n_edges FROM grp",
    "report_summary": f"WITH RECURSIVE {_GROUPS} SELECT (SELECT count(*) FROM feat) AS total_records, (SELECT count(*) FROM verd) AS total_pairs, {', '.join(f"(SELECT count(*) FROM verd WHERE verdict = '{v}') AS n_{v}" for v in ('duplicate', 'different_transfer_type', 'different_functionality', 'uncertain'))}, (SELECT count(*) FROM grp) AS group_count, (SELECT CAST(coalesce(sum(n_edges), 0) AS BIGINT) FROM grp) AS duplicate_pair_count, (SELECT coalesce(max(size), 0) FROM grp) AS largest_group, (SELECT count(*) FROM final WHERE source <> 'heuristic') AS ambiguous_sections",
    "uncertain_pairs": _pair_table("uncertain"),
    "apart_pairs": _pair_table("different_functionality"),
    "lookalike_pairs": _pair_table("different_transfer_type"),
    "group_members": f"WITH RECURSIVE {_NUMBERED} SELECT number, comp.id, coalesce(name, '?') AS name, coalesce(section, '?') AS section, {_TYPES.format('feat')} AS types FROM comp JOIN numbered USING (c) LEFT JOIN feat USING (id)",
    "group_evidence": f"WITH RECURSIVE {_NUMBERED} SELECT number, a_id, b_id, format('{{:.3f}}', round(score + 1e-9, 3)) AS score, coalesce(reason, 'no reason given') AS reason FROM verd JOIN comp ON comp.id = a_id JOIN numbered USING (c) WHERE verdict = 'duplicate'",
    "tsv_scan": f"WITH {_RECORDS} SELECT id, section, name || ' \"' || id || '\"' || chr(9) || chr(10) || ' end' AS name FROM records",
    "json_round_trip": "SELECT item_id, text FROM benchmark",
    "lemma_table": f"SELECT DISTINCT token, coalesce(MAP {{{', '.join(f"'{k}': '{v}'" for k, v in LEMMAS.items())}}}[token], token) AS lemma FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part)",
    "section_labels": """
WITH rows AS (
  SELECT p_partkey // 100 || ' / ' || p_type AS section_path, ['transfer-type', 'feature', 'mixed', 'other', 'else'][p_partkey % 5 + 1] AS category, p_name AS reason,
    CASE WHEN p_partkey % 3 > 0 THEN list_sort(list_distinct([lower(p_name), lower(p_brand)])) ELSE [] END AS types,
    CAST(row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) - 1 AS INTEGER) AS pos
  FROM part)
SELECT section_path, category, array_to_string(types, ',') AS types, reason, pos FROM rows WHERE category <> 'else' QUALIFY row_number() OVER (PARTITION BY section_path ORDER BY pos DESC) = 1""",
    "lexicon_digests": r"SELECT substring(sha256('company\bcom\binner\bin\w*\s+th\w*\binto\borganisation\borg\b\bhttps\b\bspam\w*\bads\b'), 1, 16) AS labels, substring(sha256('anddedieexamplelaofthe'), 1, 16) AS stopwords",
    "empty_vocabulary": f"WITH items AS (SELECT CAST(item_id % 4 AS VARCHAR) AS block, item_id AS id, repeat('!', 1 + item_id % 7) AS text FROM benchmark),{_weights('c', 'items', _CHARS)} SELECT a_id, b_id, round(sim, 4) AS tfidf_char, CAST(0 AS DOUBLE) AS tfidf_word FROM csim WHERE sim >= 0.6 * 0.55",
    "unsettled_sections": f"WITH {_SECTIONS} SELECT section_path, category, source FROM final WHERE source <> 'heuristic'",
    "record_hash": "SELECT item_id, substring(sha256(text), 1, 16) AS hash FROM benchmark",
}
