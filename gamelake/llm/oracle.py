"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOW_WORDS = WORDS.format(LOWER)

LEAKS = f"""
WITH i AS (SELECT item_id, {LOW_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 5) AS k FROM i WHERE len(w) > 0),
items AS (SELECT item_id, k, unnest(list_distinct([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)])) AS g
  FROM sized),
sizes AS (SELECT item_id, k, count(*) AS n_item FROM items GROUP BY ALL),
d AS (SELECT doc_id, {LOW_WORDS} AS w FROM documents),
docs AS (SELECT DISTINCT doc_id, k, unnest([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)]) AS g
  FROM d, (SELECT DISTINCT k FROM sized) AS widths WHERE len(w) >= k)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM docs JOIN items USING (k, g) JOIN sizes USING (item_id, k)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, {LOW_WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_distinct([w[j] || ' ' || w[j + 1] FOR j IN range(1, len(w))]) END AS g FROM d),
grams AS (SELECT doc_id, unnest(g) AS g FROM s),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM grams a JOIN grams b USING (g)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y
  WHERE 100 * n_both >= 80 * (len(a.g) + len(b.g) - n_both)),
ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT reach.doc_id, ends.y FROM reach JOIN ends ON ends.x = reach.other),
least_of AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(g) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN least_of USING (doc_id)"""

_ESCAPED = (r"regexp_replace(regexp_replace(replace({0}, '~', '~~'), "
            r"'<(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>)', '<~\1', 'g'), '\[(/?INST\])', '[~\1', 'g')")
CHAT = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
n AS (SELECT *, row_number() OVER own = count(*) OVER (PARTITION BY conv_id) AS is_last,
    sum(12 + length(replace({_ESCAPED.format("role")}, chr(10), '~␤')) + 1 + length({_ESCAPED.format("text")}) + 11) OVER own AS upto
  FROM t WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR is_last THEN upto END) AS BIGINT) AS formatted_chars,
  count(CASE WHEN role = 'assistant' OR is_last THEN 1 END) AS n_examples
FROM n GROUP BY conv_id"""

RULES = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, j, w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS j FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, j FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT j + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY 1),
c AS (SELECT doc_id, source, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)),
r AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
m AS (SELECT *, base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * len(lines) AS failed FROM r),
h AS (SELECT source, count(*) AS n, count_if(failed) AS f FROM m GROUP BY 1),
p AS (SELECT avg(f / n) AS mean, var_pop(f / n) AS var FROM h),
q AS (SELECT mean, CASE WHEN var > 0 AND mean * (1 - mean) / var - 1 > 0 THEN mean * (1 - mean) / var - 1 ELSE 10.0 END AS strength FROM p),
v AS (SELECT source, (f + mean * strength) / (n + strength) <= 0.5 AS host_kept FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_kept AS kept FROM m JOIN v ON m.source IS NOT DISTINCT FROM v.source"""

# crc32 of a string whose code points are below 256, from its 256 remainders.
_CRC_TABLE = """(SELECT list(c ORDER BY i) AS crc_of FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS t(i))) AS remainders"""
_BYTES = """flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
    ELSE [(192 | (unicode(c) >> 6))::BIGINT, (128 | (unicode(c) & 63))::BIGINT] END FOR c IN string_split({0}, '')])"""
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], " + _BYTES + "), lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

REPAIR = f"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, {_CRC_TABLE}),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM given, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
numbered AS (SELECT *, row_number() OVER own - 1 AS i, left(role, 1) AS letter, rtrim(text, {_SPACE}) AS bare,
    lag(left(role, 1)) OVER own AS before
  FROM damaged WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))),
faults AS (SELECT *, CASE WHEN bare = '' THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' END AS fault
  FROM numbered),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated,
    count_if(before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
next_of(q, c, r) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts(q, r, cost, audit, said) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 3, 'I', 'user:' || chr(10)), (1, 2, 3, 'I', 'user:' || chr(10)), (3, 2, 3, 'I', 'user:' || chr(10)),
  (2, 3, 3, 'I', 'assistant:' || chr(10)), (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (3, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (2, 2, 6, 'II', 'assistant:' || chr(10) || 'user:' || chr(10))),
turn_edits AS (
  SELECT conv_id, i, q, q AS r, 4 AS cost, 'D' AS edit, '' AS said FROM faults, range(4) AS s(q)
  UNION ALL SELECT conv_id, i, q, r, CASE WHEN fault = 't' THEN 3 ELSE 0 END, 'K', role || ':' || text || chr(10)
  FROM faults JOIN next_of ON c = letter WHERE fault IS NULL OR fault = 't'
  UNION ALL SELECT conv_id, i, q, r, CASE WHEN fault = 't' THEN 6 ELSE 3 END, 'R',
    CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text || chr(10)
  FROM faults JOIN next_of ON c IN ('u', 'a') WHERE fault IS NULL OR fault = 't'),
steps AS (SELECT t.conv_id, t.i, n.q, t.r, n.cost + t.cost AS cost, n.audit || t.edit AS audit, n.said || t.said AS said
  FROM turn_edits t JOIN inserts n ON n.r = t.q),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, '' AS said FROM facts
  UNION ALL
  SELECT conv_id, i + 1, r, arg_min(cost, rank), arg_min(audit, rank), arg_min(said, rank) FROM (
    SELECT b.conv_id, b.i, s.r, b.cost + s.cost AS cost, b.audit || s.audit AS audit, b.said || s.said AS said,
      lpad((b.cost + s.cost)::VARCHAR, 9, '0') || b.audit || s.audit AS rank
    FROM best b JOIN steps s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i AND s.q = b.q)
  GROUP BY conv_id, i, r),
ended AS (SELECT f.*, arg_min(x.cost, rank) AS cost, arg_min(x.audit, rank) AS audit, arg_min(x.said, rank) AS said
  FROM (SELECT b.conv_id, b.i, b.cost + n.cost AS cost, b.audit || n.audit AS audit, b.said || n.said AS said,
      lpad((b.cost + n.cost)::VARCHAR, 9, '0') || b.audit || n.audit AS rank
    FROM best b JOIN inserts n ON n.q = b.q AND n.r IN (0, 3)) AS x
  JOIN facts f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.n = x.i GROUP BY ALL)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(left(said, length(said) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS g LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM g.conv_id"""

SPELLING = f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT run, n, {_CRC.format("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM counted, {_CRC_TABLE}),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 97 = 0
      THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, unnest([left(word, i::INT) || '*' || substr(word, i::INT + 2) FOR i IN range(length(word))]) AS cut FROM words),
lost AS (SELECT DISTINCT word, n, replace(cut, '*', '') AS cut FROM cuts),
near AS (SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.word <> b.word
  UNION ALL SELECT l.word, w.word, w.n FROM lost l JOIN words w ON w.word = l.cut
  UNION ALL SELECT w.word, l.word, l.n FROM lost l JOIN words w ON w.word = l.cut),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
    CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT up.word, f.form, steps + 1 FROM up JOIN formed f ON f.word = up.root WHERE f.form IS NOT NULL),
tops AS (SELECT word, arg_max(root, steps) AS root FROM up GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN tops USING (word)"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS (SELECT id, doc_id, l, [translate(trim(x, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR x IN l] AS keys FROM d),
often AS (SELECT key FROM (SELECT id, unnest(list_distinct(keys)) AS key FROM k) WHERE key <> '' GROUP BY key HAVING count(*) >= 10),
one AS (SELECT id, doc_id, unnest(l) AS line, unnest(keys) AS key, unnest(range(len(l))) AS j FROM k)
SELECT doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY j) FILTER (often.key IS NULL), '')) AS kept_sha256
FROM one LEFT JOIN often USING (key) GROUP BY id, doc_id"""

ORACLE = {
    "op1_decontamination": LEAKS,
    "op2_minhash_dedup": NEAR,
    "op3_chat_format": CHAT,
    "op6_quality_rules": RULES,
    "op11_conversation_repair": REPAIR,
    "op12_spelling_variants": SPELLING,
    "op13_line_dedup": LINES,
}
