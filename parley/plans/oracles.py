"""The same answers in SQL, for comparison. Tables are views of the given parquet files."""

from __future__ import annotations

from parley.constants import CHAT_SYSTEM_PROMPT, HISTOGRAM_BINS, MAX_LENGTH, WHITESPACE
from parley.functions.tokens import BLANK, LATIN
from parley.plans.inputs import NAMES, SPEAKERS

_WS = "".join(f"\\x{{{ord(c):X}}}" for c in WHITESPACE)
_NL = "chr(10)"


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def normal(expr: str) -> str:
    """Blank and line rules on text that NFKC does not change."""
    spaces = f"regexp_replace({expr}, '[ \\t]+', ' ', 'g')"
    lines = f"regexp_replace({spaces}, '\\n{{3,}}', {_NL} || {_NL}, 'g')"
    return f"trim({lines}, {_text(WHITESPACE)})"


def compact(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '[{_WS}]+', ' ', 'g'), ' ')"


def tokens(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, '[{LATIN}]+|[^{LATIN}{BLANK}]'))"


# Whole conversations in one form: tagged text, chat template text.
_TAGGED = f"""trim(string_agg('<|' || role || '|>' || {_NL} || content || {_NL}, {_NL} ORDER BY turn), {_text(WHITESPACE)})"""
_CHATML = f"""string_agg('<|im_start|>' || role || {_NL} || content || '<|im_end|>' || {_NL}, '' ORDER BY turn)"""

_CHATS = f"""
chats AS (SELECT conv_id, turn, role, {normal('text')} AS content FROM conversations),
paired AS (
  SELECT conv_id FROM chats GROUP BY conv_id
  HAVING count(*) >= 2 AND arg_max(role, turn) = 'assistant' AND bool_or(role = 'user'))
"""

# The untidy turns after cleaning: blank ones gone, speakers as given, position among the rest.
_SPEAKER = " ".join(
    f"WHEN '{role}' THEN {_list(names)}[conv_id % 4 + 1]" for role, names in SPEAKERS.items()
)
_TURNS = f"""
filled AS (
  SELECT conv_id, turn, role AS given, conv_id % 4 AS k,
         CASE role {_SPEAKER} END AS speaker,
         {normal('text')} AS content,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position
  FROM conversations WHERE (conv_id * 7 + turn) % 9 <> 4),
led AS (
  SELECT *, CASE WHEN first_value(given) OVER (PARTITION BY conv_id ORDER BY turn) = 'system'
                 THEN 1 ELSE 0 END AS lead
  FROM filled),
inferred AS (
  SELECT conv_id, turn, position, content,
    CASE WHEN given = 'system' THEN CASE WHEN position = 0 THEN 'system' ELSE 'assistant' END
         WHEN k IN (0, 1) OR (k = 3 AND given = 'assistant') THEN given
         WHEN (position - lead) % 2 = 0 THEN 'user' ELSE 'assistant' END AS role
  FROM led),
direct AS (
  SELECT conv_id, turn, position, content,
    CASE WHEN given = 'assistant' AND k = 2 THEN 'user' ELSE given END AS role
  FROM led)
"""
# Cleaned, deduplicated, paired conversations of the untidy set with empty ones.
_CLEANED = f"""{_TURNS},
kept AS (SELECT * FROM inferred WHERE conv_id % 7 <> 3 AND conv_id % 5 <> 2),
keyed AS (
  SELECT conv_id, string_agg(role || ':' || {compact('content')}, {_NL} ORDER BY turn) AS key,
         count(*) >= 2 AND arg_max(role, turn) = 'assistant' AND bool_or(role = 'user') AS is_pair,
         {_TAGGED} AS rendered
  FROM kept GROUP BY conv_id),
firsts AS (SELECT min(conv_id) AS conv_id FROM keyed GROUP BY key)
"""

_LENGTH_STATS = """
  count(*) AS seen, count(v) AS kept, count(v) AS count, min(v) AS min,
  round(quantile_cont(v, 0.95), 6) AS p95, max(v) AS max, round(avg(v), 6) AS mean
"""

_EXCHANGES = f"""
said AS (
  SELECT a.conv_id, a.turn, {normal('a.text')} AS said,
         CASE a.conv_id % 3 WHEN 0 THEN a.role ELSE '' END AS extra,
         CASE WHEN (a.conv_id + a.turn) % 5 = 0 THEN '' ELSE {normal('b.text')} END AS answer
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
"""


def _exact_split(source: str, key: str, test: float, validation: float, seed: int = 42) -> str:
    """CTE ``parts``: the key and its split, by rank of a seeded hash."""
    return f"""
sizes AS (SELECT ceil({test + validation!r} * count(*)) AS held,
                 ceil({test / (test + validation)!r} * ceil({test + validation!r} * count(*))) AS tests
          FROM {source}),
ranked AS (SELECT {key}, row_number() OVER (ORDER BY sha1('{seed}:' || {key}), {key}) AS r FROM {source}),
parts AS (SELECT {key}, CASE WHEN r <= tests THEN 'test' WHEN r <= held THEN 'validation'
                        ELSE 'train' END AS split FROM ranked, sizes)
"""


def _pair(user: str, assistant: str) -> str:
    test = "u <> '' AND a <> ''"
    return f"""WITH {_EXCHANGES}, p AS (SELECT conv_id, turn, {user} AS u, {assistant} AS a FROM said)
SELECT conv_id, turn, CASE WHEN {test} THEN u END AS user_text, CASE WHEN {test} THEN a END AS assistant_text FROM p"""


_BIN = "least(floor((v - low) / (high - low) * {bins}), {bins} - 1)"

_TOLD = f"""WITH t AS (SELECT conv_id, turn, role, trim(text, {_text(WHITESPACE)}) AS content, (conv_id + turn) % 6 = 4 AS blank FROM conversations),
s AS (SELECT conv_id, min(turn) FILTER (blank AND role = 'user') AS stop, bool_or(role = 'system') AS own FROM t GROUP BY conv_id),
told AS (SELECT t.conv_id, turn, role, CASE WHEN blank THEN '' ELSE content END AS content FROM t JOIN s USING (conv_id) WHERE stop IS NULL OR turn < stop),
lines AS (SELECT conv_id, turn, role, content FROM told
  UNION ALL SELECT conv_id, -1, 'system', {_text(CHAT_SYSTEM_PROMPT)} FROM s WHERE NOT own)"""

# All untidy turns of a conversation in brackets, one after another, before the blank rules.
_BRACKETED = f"""string_agg('[' || CASE WHEN (conv_id * 7 + turn) % 9 = 4 THEN '  ' || {_NL}
  WHEN (conv_id + turn) % 3 = 1 THEN '  ' || text || {_NL} || ' ' ELSE text END || ']', ' ' ORDER BY turn)"""

ORACLES = {
    "nfkc_text": "SELECT doc_id, text || '1fi\u30ac\u00e9' AS text FROM documents",
    "normalized_text": f"""SELECT doc_id, {normal("CASE WHEN doc_id % 5 = 3 THEN regexp_replace(text, '" + chr(92) + "n+', chr(10) || chr(10), 'g') ELSE text END")} AS text FROM documents""",
    "compacted_text": f"SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE {compact('text')} END AS text FROM documents",
    "normalized_role": f"SELECT conv_id, turn, {_list(r for _, r in NAMES)}[(conv_id * 3 + turn) % {len(NAMES)} + 1] AS role FROM conversations",
    "content_keys": f"SELECT conv_id, sha1(string_agg(role || ':' || {compact('text')}, {_NL} ORDER BY turn)) AS key FROM conversations GROUP BY conv_id",
    "row_keys": f"SELECT doc_id, sha1('text:' || {compact('text')} || {_NL} || 'lang:' || lang || {_NL} || 'source:' || source) AS key FROM documents",
    "rendered_chat": f"SELECT conv_id, {_TAGGED.replace('content', 'text')} AS text FROM conversations GROUP BY conv_id",
    "rendered_chatml": f"SELECT conv_id, {_CHATML.replace('content', 'text')} || '<|im_start|>assistant' || {_NL} AS text FROM conversations GROUP BY conv_id",
    "char_lengths": "SELECT doc_id, length(text) AS char_length FROM documents",
    "token_counts": f"SELECT doc_id, {tokens('text')} AS tokens FROM documents",
    "extracted_reply": f"""WITH r AS (SELECT conv_id, turn, CASE WHEN (conv_id * 7 + turn) % 9 = 4 THEN '' ELSE {normal('text')} END AS reply FROM conversations)
SELECT conv_id, arg_max(reply, turn) AS reply FROM r GROUP BY conv_id""",
    "perplexity_values": """WITH l AS (SELECT event_id, CASE WHEN event_id % 13 <> 0 AND event_id % 11 <> 0 AND value * 3 < 100 THEN value * 3 END AS loss FROM events)
SELECT event_id, loss IS NULL AS is_infinite, round(ln(exp(loss)), 6) AS log_perplexity FROM l""",
    "messages_shape": f"WITH {_TURNS} SELECT conv_id, position, role, content FROM direct",
    "conversations_shape": f"WITH {_TURNS} SELECT conv_id, position, role, content FROM inferred",
    "inferred_roles": """WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER w - 1 AS position, first_value(role) OVER w = 'system' AS lead
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, position, CASE WHEN role = 'system' THEN role WHEN (position - lead::INT) % 2 = 0 THEN 'user' ELSE 'assistant' END AS role, text AS content FROM t""",
    "instruction_shape": _pair(f"CASE WHEN said = '' OR extra = '' THEN said ELSE said || {_NL} || extra END", "answer"),
    "pair_shape": _pair("said", "answer"),
    "qa_shape": _pair("said", "answer"),
    "text_shape": f"""SELECT doc_id, 0::BIGINT AS position, 'user' AS role, {normal("CASE WHEN doc_id % 5 = 3 THEN regexp_replace(text, '" + chr(92) + "n+', chr(10) || chr(10), 'g') ELSE text END")} AS content FROM documents""",
    "dispatched_shapes": f"""WITH {_TURNS}
SELECT conv_id, position, role, content FROM direct WHERE conv_id % 3 = 0
UNION ALL SELECT conv_id, position, role, content FROM inferred WHERE conv_id % 3 = 1
UNION ALL SELECT conv_id, 0, 'user', {normal(_BRACKETED)} FROM conversations WHERE conv_id % 3 = 2 GROUP BY conv_id""",
    "folded_turns": "SELECT conv_id, turn, role, text AS content FROM conversations",
    "chat_pairs": """SELECT conv_id, count(*) >= 2 AND arg_max(role, turn) = 'assistant' AND bool_or(role = 'user') AS is_pair
FROM conversations GROUP BY conv_id""",
    "nulls_removed": """SELECT conv_id, count(*) AS turns FROM conversations WHERE conv_id % 7 <> 3 AND conv_id % 5 <> 2
GROUP BY conv_id HAVING bool_or((conv_id * 7 + turn) % 9 <> 4)""",
    "normalized_rows": f"""SELECT conv_id, 'note ' || conv_id AS note, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn,
  CASE role {_SPEAKER} END AS speaker, CASE WHEN (conv_id * 7 + turn) % 9 = 4 THEN '' ELSE {normal('text')} END AS text FROM conversations""",
    "deduplicated_chats": f"""WITH {_TURNS},
keyed AS (SELECT conv_id, string_agg(role || ':' || {compact('content')}, {_NL} ORDER BY turn) AS key FROM inferred GROUP BY conv_id),
alls AS (SELECT c.conv_id, coalesce(key, '') AS key, turns FROM (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id) c LEFT JOIN keyed USING (conv_id))
SELECT min(conv_id) AS conv_id, arg_min(turns, conv_id) AS turns FROM alls GROUP BY key""",
    "deduplicated_documents": f"SELECT lang AS split, min(doc_id) AS doc_id FROM documents GROUP BY lang, {compact('text')}",
    "deduplicated_globally": f"SELECT arg_min(source, doc_id) AS split, min(doc_id) AS doc_id FROM documents GROUP BY {compact('text')}",
    "deduplicated_batches": f"""SELECT lang AS split, doc_id FROM documents
QUALIFY row_number() OVER (PARTITION BY lang, {compact('text')} ORDER BY doc_id % 2, doc_id) = 1""",
    "converted_chats": f"""WITH {_TURNS},
ok AS (SELECT conv_id FROM inferred GROUP BY conv_id HAVING count(*) >= 2 AND arg_max(role, turn) = 'assistant' AND bool_or(role = 'user')),
n AS (SELECT conv_id, count(*)::INT AS turns FROM conversations GROUP BY conv_id)
SELECT conv_id, turns, conv_id / 2 AS half, position, role, content FROM inferred JOIN ok USING (conv_id) JOIN n USING (conv_id)""",
    "stage_report": f"""WITH {_CLEANED},
named AS (SELECT DISTINCT conv_id, CASE conv_id % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS split FROM conversations),
own AS (SELECT min(conv_id) AS conv_id FROM keyed JOIN named USING (conv_id) GROUP BY split, key),
counts AS (
  SELECT 0::BIGINT AS step, 'raw' AS stage, conv_id, 2 AS n FROM named
  UNION ALL SELECT 1, 'no_null', conv_id, 2 FROM keyed
  UNION ALL SELECT 2, 'normalized', conv_id, 2 FROM keyed
  UNION ALL SELECT 3, 'deduplicated', conv_id, 1 FROM own
  UNION ALL SELECT 4, 'chat', conv_id, 1 FROM own JOIN keyed USING (conv_id) WHERE is_pair)
SELECT step, stage, split, sum(n)::BIGINT AS rows FROM counts JOIN named USING (conv_id) GROUP BY ALL""",
    "exact_split": f"WITH {_exact_split('documents', 'doc_id', 0.02, 0.02)} SELECT doc_id, split FROM parts",
    "hashed_split": """WITH h AS (SELECT doc_id, ('0x' || substr(sha1('7:' || doc_id), 1, 8))::BIGINT / 4294967296.0 AS place FROM documents)
SELECT doc_id, CASE WHEN place < 0.1 THEN 'test' WHEN place < 0.1::DOUBLE + 0.2::DOUBLE THEN 'validation' ELSE 'train' END AS split FROM h""",
    "first_rows_per_split": """SELECT lang AS split, doc_id, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 20""",
    "many_first_rows_per_split": """SELECT o_orderstatus AS split, o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey, o_orderkey) <= 4500""",
    "eval_rows": f"WITH {_exact_split('documents', 'doc_id', 0.5, 0.0)} SELECT split, doc_id FROM parts WHERE split = 'test' ORDER BY doc_id LIMIT 100",
    "dataset_profile": """SELECT lang AS split, count(*) AS rows, 'doc_id,text,lang,source,n_chars' AS columns,
  'text,lang,source' AS string_columns, 'int=2,str=3' AS column_types FROM documents GROUP BY lang""",
    "columns_per_split": """SELECT lang AS split, c.ordinal::BIGINT AS ordinal, c.name AS "column", c.type AS type
FROM (SELECT DISTINCT lang FROM documents),
  (SELECT unnest([{'ordinal': 0, 'name': 'doc_id', 'type': 'bigint'}, {'ordinal': 1, 'name': 'text', 'type': 'string'},
    {'ordinal': 2, 'name': 'lang', 'type': 'string'}, {'ordinal': 3, 'name': 'source', 'type': 'string'},
    {'ordinal': 4, 'name': 'n_chars', 'type': 'bigint'}]) AS c)""",
    "first_rows_shown": """SELECT c_mktsegment AS split, c_custkey, c_name, c_nationkey, c_acctbal FROM customer
QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) <= 3""",
    "splits_listed": "SELECT lang AS split, count(*) AS rows FROM documents GROUP BY lang",
    "picked_example": """SELECT lang AS split, doc_id, text FROM documents WHERE lang = (SELECT min(lang) FROM documents)
ORDER BY doc_id OFFSET 7 LIMIT 1""",
    "verified_dataset": """WITH j AS (SELECT lang, quality FROM documents LEFT JOIN labels USING (doc_id)),
n AS (SELECT s, count(lang) AS rows, count(lang) - count(quality) AS q FROM (SELECT unnest(['en', 'de', 'train']) AS s) LEFT JOIN j ON lang = s GROUP BY s),
r AS (SELECT 'has_rows' AS rule, s AS split, s AS subject, rows, (rows = 0)::BIGINT AS failures FROM n
UNION ALL SELECT 'column_filled', s, 'text', rows, 0 FROM n
UNION ALL SELECT 'column_filled', s, 'quality', rows, q FROM n
UNION ALL SELECT 'column_filled', s, 'summary', rows, rows FROM n)
SELECT *, failures = 0 AS passed FROM r""",
    "token_length_stats": f"""WITH {_CHATS}, l AS (SELECT {tokens(_TAGGED)} AS v FROM chats GROUP BY conv_id)
SELECT {_LENGTH_STATS} FROM l""",
    "token_length_stats_by_language": f"""WITH l AS (SELECT lang, {tokens("'<|user|>' || chr(10) || text")} AS v FROM documents)
SELECT lang, {_LENGTH_STATS} FROM l GROUP BY lang""",
    "token_stats_of_first_rows": f"""WITH d AS (SELECT text FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 200),
l AS (SELECT {tokens("'<|user|>' || chr(10) || text")} AS v FROM d) SELECT {_LENGTH_STATS} FROM l""",
    "length_histograms": f"""WITH {_CHATS},
texts AS (SELECT {_TAGGED} AS t FROM chats GROUP BY conv_id),
l AS (SELECT 'char_length' AS series, length(t) AS v FROM texts UNION ALL SELECT 'token_length', {tokens('t')} FROM texts),
r AS (SELECT series, min(v)::DOUBLE AS low, max(v)::DOUBLE AS high FROM l GROUP BY series),
edges AS (SELECT series, i AS bin, low + (high - low) / {HISTOGRAM_BINS} * (i - 1) AS bin_low,
          CASE WHEN i = {HISTOGRAM_BINS} THEN high ELSE low + (high - low) / {HISTOGRAM_BINS} * i END AS bin_high
          FROM r, range(1, {HISTOGRAM_BINS + 1}) t(i))
SELECT e.series, bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high, count(v) AS rows
FROM edges e LEFT JOIN l ON l.series = e.series AND v >= bin_low AND (v < bin_high OR (bin = {HISTOGRAM_BINS} AND v <= bin_high))
GROUP BY ALL""",
    "length_totals": f"WITH {_CLEANED} SELECT count(*) AS char_count, count(*) AS token_count FROM keyed",
    "parquet_roundtrip": """SELECT doc_id, text, lang, source, n_chars,
  CASE WHEN doc_id % 4 = 0 THEN '1' WHEN doc_id % 4 < 3 THEN '00' || (doc_id % 3) END AS split FROM documents""",
    "stored_example": """SELECT lang AS split, doc_id, text FROM documents WHERE lang = (SELECT min(lang) FROM documents)
ORDER BY doc_id OFFSET 29 LIMIT 1""",
    "stored_order": "SELECT lang AS split, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 10",
    "jsonl_roundtrip": "SELECT doc_id, text, lang, CASE WHEN doc_id % 3 > 0 THEN source END AS source, n_chars FROM documents",
    "report_roundtrip": f"""WITH l AS (SELECT {tokens("'<|user|>' || chr(10) || text")} AS v FROM documents)
SELECT count(*) AS seen, count(*) AS kept, count(*) AS count, min(v) AS min, max(v) AS max FROM l""",
    "training_text": f"""WITH {_CHATS}, {_exact_split('paired', 'conv_id', 0.2, 0.2)},
t AS (SELECT conv_id, {_TAGGED} AS text FROM chats GROUP BY conv_id) SELECT split, conv_id, text FROM t JOIN parts USING (conv_id)""",
    "training_tokens": f"""WITH {_CHATS},
t AS (SELECT conv_id, {_CHATML} AS text FROM chats JOIN paired USING (conv_id) GROUP BY conv_id),
i AS (SELECT conv_id, list_transform(string_split(text, ''), lambda c: unicode(c)) AS ids FROM t)
SELECT conv_id, least(len(ids), {MAX_LENGTH}) AS tokens, array_to_string(ids[1:{MAX_LENGTH}], ' ') AS input_ids, true AS labels_match, len(ids) > {MAX_LENGTH} AS was_truncated FROM i""",
    "training_steps": f"""WITH {_CHATS}, {_exact_split('paired', 'conv_id', 0.2, 0.2)},
n AS (SELECT count(*) AS train_rows FROM parts WHERE split = 'train'),
s AS (SELECT train_rows, 6::BIGINT AS effective_batch, greatest(1, ceil(train_rows / 6))::BIGINT AS steps_per_epoch FROM n),
t AS (SELECT *, greatest(1, ceil(steps_per_epoch * 2.5))::BIGINT AS total_steps FROM s)
SELECT *, floor(total_steps * 0.03)::BIGINT AS warmup_steps FROM t""",
    "evaluated_loss": f"""WITH {_CHATS}, t AS (SELECT {_TAGGED} AS text FROM chats GROUP BY conv_id),
l AS (SELECT list_avg(list_transform(string_split(text, ''), lambda c: ln(1 + unicode(c)))) AS v FROM t)
SELECT count(*) AS rows, round(avg(v), 6) AS loss, round(exp(avg(v)), 4) AS perplexity FROM l""",
    "unigram_loss": f"""WITH {_CHATS}, {_exact_split('paired', 'conv_id', 0.2, 0.2)},
t AS (SELECT conv_id, {_TAGGED} AS text FROM chats GROUP BY conv_id),
w AS (SELECT split, conv_id, unnest(regexp_extract_all(text, '[{LATIN}]+|[^{LATIN}{BLANK}]')) AS token FROM t JOIN parts USING (conv_id)),
c AS (SELECT token, count(*) AS n FROM w WHERE split = 'train' GROUP BY token),
a AS (SELECT sum(n) + count(*) + 1 AS everything FROM c),
l AS (SELECT split, conv_id, avg(-ln((coalesce(n, 0) + 1)::DOUBLE / everything)) AS loss
      FROM w LEFT JOIN c USING (token), a WHERE split <> 'train' GROUP BY split, conv_id)
SELECT split, count(*) AS rows, round(avg(loss), 6) AS loss, round(exp(avg(loss)), 3) AS perplexity FROM l GROUP BY split""",
    "vocabulary_tokens": f"""WITH RECURSIVE words AS (
  SELECT unnest(regexp_extract_all(text, '[{LATIN}]+|[^{LATIN}{BLANK}]')) AS token FROM benchmark
  UNION SELECT unnest(string_split(text, '')) FROM benchmark),
vocabulary AS (SELECT token, ('0x' || substr(sha1(token), 1, 7))::BIGINT AS id, length(token) AS n FROM words WHERE token <> ''),
places AS (SELECT conv_id, turn, text, unnest(range(1, length(text) + 1)) AS place FROM conversations),
parts AS (SELECT conv_id, turn, place, substr(text, place, n) AS token FROM places, (SELECT DISTINCT n FROM vocabulary)
          WHERE place + n - 1 <= length(text)),
best AS (SELECT conv_id, turn, place, max(n) AS n, arg_max(id, n) AS id FROM parts JOIN vocabulary USING (token) GROUP BY ALL),
jumps AS MATERIALIZED (SELECT conv_id, turn, place, place + coalesce(n, 1) AS onward, coalesce(id, -1) AS id
          FROM places LEFT JOIN best USING (conv_id, turn, place)),
walk AS (SELECT conv_id, turn, 1::BIGINT AS place, 0 AS step, NULL::BIGINT AS id FROM conversations
  UNION ALL SELECT w.conv_id, w.turn, j.onward, w.step + 1, j.id FROM walk w JOIN jumps j USING (conv_id, turn, place))
SELECT conv_id, turn, max(step)::BIGINT AS tokens, coalesce(string_agg(id, ' ' ORDER BY step) FILTER (step > 0), '') AS ids
FROM walk GROUP BY conv_id, turn""",
    "token_sketches": f"""WITH l AS (SELECT lang AS split, {tokens("'<|user|>' || chr(10) || text")} AS v FROM documents)
SELECT split, count(*) AS seen, count(v) AS kept, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, true AS p95_is_near
FROM l GROUP BY split""",
    "generated_replies": f"""SELECT item_id + 1 AS ord, 'You said: ' || trim(text, {_text(WHITESPACE)}) AS reply,
  '<|im_start|>user' || {_NL} || text || '<|im_end|>' || {_NL} || '<|im_start|>assistant' || {_NL} AS model_input FROM benchmark""",
    "generation_summary": f"""WITH t AS (
  SELECT 'base' AS run, ((item_id + 1) % 5) / 8.0::DOUBLE AS s, {tokens("'You said: ' || text")} AS n FROM benchmark
  UNION ALL SELECT 'tuned', ((item_id + 1) % 5) / 8.0::DOUBLE, {tokens("replace(text, ' ', '-')")} FROM benchmark)
SELECT run, count(*) AS prompts, round(avg(s), 6) AS avg_latency_sec, round(quantile_cont(s, 0.95), 6) AS p95_latency_sec,
  sum(n)::BIGINT AS generated_tokens, round(sum(n) / greatest(sum(s), 1e-6), 6) AS tokens_per_sec FROM t GROUP BY run""",
    "generation_speed": f"""WITH t AS (SELECT text AS prompt, ((item_id + 1) % 5) / 8.0::DOUBLE AS latency_sec,
  {tokens("replace(text, ' ', '-')")} AS generated_tokens FROM benchmark)
SELECT *, round(generated_tokens / greatest(latency_sec, 1e-6), 3) AS tokens_per_sec FROM t""",
    "compared_runs": f"""SELECT item_id + 1 AS ord, text AS prompt, 'You said: ' || trim(text, {_text(WHITESPACE)}) AS base,
  trim(replace(text, ' ', '-'), {_text(WHITESPACE)}) AS tuned FROM benchmark""",
    "comparison_report": f"""SELECT 0::BIGINT AS ord, '# Compare Before/After' || {_NL} AS value
UNION ALL SELECT item_id + 1, '## Case ' || (item_id + 1) || {_NL} || {_NL} || '**Prompt**' || {_NL} || {_NL} || text || {_NL} || {_NL} ||
  '**Base**' || {_NL} || {_NL} || 'You said: ' || trim(text, {_text(WHITESPACE)}) || {_NL} || {_NL} ||
  '**Tuned**' || {_NL} || {_NL} || trim(replace(text, ' ', '-'), {_text(WHITESPACE)}) || {_NL} FROM benchmark""",
    "chat_histories": f"""{_TOLD},
running AS (SELECT conv_id, turn, role, string_agg('<|' || role || '|>' || {_NL} || content || {_NL}, {_NL})
  OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS h FROM lines)
SELECT conv_id, turn, trim(h, {_text(WHITESPACE)}) AS history FROM running WHERE role = 'user' AND turn >= 0""",
    "chat_points": f"""{_TOLD},
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM lines)
SELECT conv_id, trim(string_agg('<|' || role || '|>' || {_NL} || content || {_NL}, {_NL} ORDER BY turn), {_text(WHITESPACE)}) AS chat,
  string_agg(turn || ':' || place, ',' ORDER BY turn) FILTER (role = 'user' AND turn >= 0) AS points
FROM numbered GROUP BY conv_id HAVING bool_or(role = 'user' AND turn >= 0)""",
    "turn_runs": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place, turn AS given, role, text AS content
FROM conversations WHERE (conv_id + turn) % 13 <> 5""",
    "lost_turns": "SELECT 'conv_id' AS missing, turn, role, text FROM conversations WHERE (conv_id + turn) % 13 = 5",
    "chat_run_points": f"""{_TOLD}
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place, role, content, role = 'user' AND turn >= 0 AS is_point FROM lines""",
    "workflow_split": f"""WITH {_CLEANED},
chosen AS (SELECT conv_id FROM firsts JOIN keyed USING (conv_id) WHERE is_pair),
{_exact_split('chosen', 'conv_id', 0.1, 0.1)},
l AS (SELECT split, {tokens('rendered')} AS v FROM keyed JOIN parts USING (conv_id))
SELECT split, {_LENGTH_STATS} FROM l GROUP BY split""",
    "workflow_reports": f"""WITH {_CLEANED},
chosen AS (SELECT conv_id FROM firsts JOIN keyed USING (conv_id) WHERE is_pair),
{_exact_split('chosen', 'conv_id', 0.1, 0.1)},
everything AS (SELECT 2 * count(DISTINCT conv_id) AS rows FROM conversations),
filled_rows AS (SELECT 2 * count(*) AS rows FROM keyed),
per_split AS (SELECT split, count(*) AS rows FROM parts GROUP BY split)
SELECT 'raw' AS what, 'train' AS split, rows FROM everything
UNION ALL SELECT 'stats', 'train', rows FROM everything
UNION ALL SELECT 'no_null', 'train', rows FROM filled_rows
UNION ALL SELECT 'normalized', 'train', rows FROM filled_rows
UNION ALL SELECT 'tokens', 'all', rows FROM filled_rows
UNION ALL SELECT 'deduplicated', 'train', count(*) FROM firsts
UNION ALL SELECT 'chat', 'train', count(*) FROM chosen
UNION ALL SELECT 'sizes', split, rows FROM per_split
UNION ALL SELECT 'dataset', split, rows FROM per_split""",
}
