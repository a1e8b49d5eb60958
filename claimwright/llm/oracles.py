"""DuckDB SQL of the queries of this package that SQL can express."""

ORACLES: dict[str, str] = {}

#: Words of a text; null has none.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op1_substring_dedup"] = rf"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM docs WHERE len(words) >= 13),
windows AS (SELECT doc_id, p, list_aggregate(words[p:p + 12], 'string_agg', ' ') AS sequence FROM starts),
firsts AS (SELECT sequence, min(doc_id) AS first FROM windows GROUP BY sequence HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p
  FROM windows JOIN firsts USING (sequence) WHERE first < doc_id),
gone_lists AS (SELECT doc_id, list(p) AS places FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, words, list_filter(range(1, len(words) + 1), lambda i: places IS NULL OR NOT list_contains(places, i))
    AS kept
  FROM docs LEFT JOIN gone_lists USING (doc_id))
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - len(kept))::BIGINT AS n_removed,
  sha256(coalesce(list_aggregate(list_transform(kept, lambda i: words[i]), 'string_agg', ' '), '')) AS kept_sha256
FROM kept"""


def lower_words(column: str) -> str:
    lowered = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLES["op9_benchmark_decontamination"] = rf"""
WITH docs AS (SELECT doc_id, {lower_words('text')} AS words FROM documents),
items AS (SELECT item_id, {lower_words('text')} AS words FROM benchmark),
item_starts AS (
  SELECT item_id, words, least(len(words), 10) AS length, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p
  FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, length, list_aggregate(words[p:p + length - 1], 'string_agg', ' ') AS sequence
  FROM item_starts),
lengths AS (SELECT DISTINCT length FROM windows),
places AS (
  SELECT doc_id, words, length, unnest(range(1, len(words) - length + 2)) AS p
  FROM docs CROSS JOIN lengths WHERE len(words) >= length),
sequences AS (SELECT doc_id, length, p, list_aggregate(words[p:p + length - 1], 'string_agg', ' ') AS sequence
  FROM places),
found AS (SELECT doc_id, p, s.length, item_id FROM sequences s JOIN windows w USING (sequence)),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + length)) AS q FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

ORACLES["op4_ngram_jaccard_join"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (
  SELECT doc_id, words, least(len(words), 4) AS length, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS p
  FROM docs WHERE len(words) > 0),
shingles AS (
  SELECT DISTINCT doc_id, list_aggregate(words[p:p + length - 1], 'string_agg', ' ') AS shingle FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * common >= 85 * (s.n + t.n - common)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON l.a = r.other)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

# Characters that the template's marks and escapes add are counted; texts and roles are those of the table.
CONTROL = r"'</?s>|<</?SYS>>|\[/?(INST|ROLE|TURN|IMAGE|AUDIO|DOCUMENT|FILE)\]'"


def escaped_length(column: str) -> str:
    return (f"(len({column}) + len({column}) - len(replace({column}, chr(92), ''))"
            f" + len(regexp_extract_all({column}, {CONTROL})))")


ORACLES["op12_chat_formatting"] = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, {escaped_length('text')} + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 4
    ELSE 20 + {escaped_length('role')} END AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(chars))::BIGINT AS formatted_chars, 0::BIGINT AS n_attachments, 0::BIGINT AS expanded_tokens
FROM sized GROUP BY conv_id"""

ORACLES["op13_hard_negatives"] = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
    coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0)::BIGINT
      AS score
  FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""
