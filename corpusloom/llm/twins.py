"""DuckDB twins of the queries that SQL can express, written apart from the operators; others are tested by brute force in tests/llm."""

from __future__ import annotations

from corpusloom.llm import line_dedup, near_dedup, quality

_ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = (_ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]+", "[A-Za-z0-9+/_-]{20,}={0,2}")
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repo, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(f"SELECT doc_id, {k} AS kind, regexp_extract_all(text, '{p}') AS ms, regexp_extract_all(text, '{p}', {2 if k == 0 else 0}) AS vs, string_split_regex(text, '{p}') AS ps FROM d" for k, p in enumerate(_KINDS))}),
x AS (SELECT doc_id, kind, unnest(ms) AS m, unnest(vs) AS v, unnest(ps[1:len(ms)]) AS p, unnest(range(len(ms))) AS i FROM m WHERE len(ms) > 0),
y AS (SELECT *, CAST(sum(length(p) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS z FROM x),
b AS (SELECT doc_id, kind, z - length(m) AS a, z, v FROM y WHERE kind = 0 AND length(v) >= 8 OR kind = 1 AND length(m) >= 16 OR kind = 2 AND length(m) >= 32 OR kind = 3),
n AS (SELECT v, ch, count(*) AS n FROM (SELECT v, unnest(string_split(v, '')) AS ch FROM (SELECT DISTINCT v FROM b)) GROUP BY v, ch),
h AS (SELECT v, coalesce(sum(n) FILTER (WHERE ch BETWEEN '0' AND '9'), 0) >= 3 AND coalesce(sum(n) FILTER (WHERE lower(ch) BETWEEN 'a' AND 'z'), 0) >= 3 AND -sum(n / length(v) * log2(n / length(v))) >= 3.2 AS random FROM n GROUP BY v),
c AS (SELECT b.*, h.random FROM b JOIN h ON h.v = b.v WHERE kind < 3 OR h.random AND NOT EXISTS (SELECT 1 FROM b o WHERE o.doc_id = b.doc_id AND o.kind < 3 AND o.a < b.z AND b.a < o.z)),
o AS (SELECT v, count(DISTINCT owner) <= 1 AND count(DISTINCT (owner, repo)) <= 3 AS own FROM c JOIN d ON d.doc_id = c.doc_id GROUP BY v),
s AS (SELECT c.*, own, ['assign', 'access', 'hex', 'string'][kind + 1] || ':' || a || ':' || z AS span FROM c JOIN o ON o.v = c.v),
g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex, string_agg(span, ',' ORDER BY a, kind) FILTER (WHERE kind < 3) AS base,
  string_agg(span, ',' ORDER BY a, kind) FILTER (WHERE kind < 3 OR own) AS spans, count(*) FILTER (WHERE own AND random) AS n_live, count(*) FILTER (WHERE NOT own) AS n_copied, string_agg(span, ',' ORDER BY a, kind) FILTER (WHERE own AND random) AS live_spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, coalesce(live_spans, '') AS live_spans
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""

#: Letters and digits, in lower case.
_WORD = r"[0-9a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{1FFF}\x{2070}-\x{2FFF}\x{3001}-\x{10FFFF}]+"
NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w WHERE len(ws) > 0),
c AS (SELECT doc_id, sh, count(*) AS n FROM s GROUP BY doc_id, sh),
t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.n, b.n)) AS common FROM c a JOIN c b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY x, y),
l AS (SELECT x, y FROM p JOIN t u ON u.doc_id = x JOIN t v ON v.doc_id = y WHERE CAST(common AS DOUBLE) / CAST(u.total + v.total - common AS DOUBLE) >= {near_dedup.THRESHOLD}
  UNION SELECT a.doc_id, b.doc_id FROM w a JOIN w b ON a.text = b.text AND a.doc_id < b.doc_id WHERE len(a.ws) = 0 AND a.text <> ''),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(doc_id, near) AS (SELECT x, x FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.near),
k AS (SELECT doc_id, min(near) AS class_id FROM r GROUP BY doc_id),
f AS (SELECT d.doc_id, coalesce(k.class_id, d.doc_id) AS class_id FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, doc_id = class_id AS kept FROM f
"""

_CONTROL = r"\\|<<SYS>>|<</SYS>>|\[/INST\]|\[INST\]|</s>|### |<s>|<\||\|>"

CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROL}')) + len(regexp_extract_all(text, '{_CONTROL}'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def _vote(good: str, bad: str) -> str:
    return f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 END"


def _share(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / greatest({b}, 1)"


def _odds(t: str) -> str:
    return f"ln({t}.prior / (1 - {t}.prior))" + "".join(f" + CASE v_{k} WHEN 1 THEN ln({t}.g_{k} / {t}.b_{k}) WHEN 0 THEN ln((1 - {t}.g_{k}) / (1 - {t}.b_{k})) ELSE 0 END" for k in _VOTES)


def _accuracy(x: str, k: str) -> str:
    return f"(coalesce(sum(n * {x}) FILTER (WHERE v_{k} = 1), 0) + 1) / (coalesce(sum(n * {x}) FILTER (WHERE v_{k} IS NOT NULL), 0) + 2)"


_VOTES = {
    "symbols": _vote("sym < 0.02", "sym > 0.1"),
    "dup_lines": _vote("dup < 0.1 AND n_lines > 2", "dup > 0.34"),
    "repeats": _vote("rep < 0.05 AND n_words > 50", "rep > 0.2"),
    "capitals": _vote("up > 0 AND up < 0.1", "up > 0.3"),
    "common": _vote("com > 0.08", "com < 0.03 AND n_words > 30"),
    "distinct": _vote("dis > 0.4 AND n_words > 30", "dis < 0.25 AND n_words < 2000"),
    "word_length": _vote("per > 3.5 AND per < 7", "per < 2 OR per > 9"),
    "bangs": _vote("ban < 0.02", "ban > 0.1"),
    "sentences": _vote("sto < 40", "sto > 100 AND n_words > 100"),
}
_BLACK = r"[^\x20\x09-\x0D]"
QUALITY = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_BLACK}+') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_BLACK}')) AS ls FROM documents),
u AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
q AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g, unnest(range(len(ws) - 4)) AS i FROM d WHERE len(ws) >= 5),
rp AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM q), range(5) x(k) WHERE c > 1 GROUP BY doc_id),
ww AS (SELECT doc_id, count(DISTINCT w) AS n_distinct, CAST(sum(length(w)) AS BIGINT) AS word_chars, count(*) FILTER (WHERE lower(w) IN {quality.COMMON}) AS n_common, count(*) FILTER (WHERE right(w, 1) IN ('.', '!', '?', ':')) AS n_stops FROM u GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(word_chars, 0) AS word_chars, length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(ls) AS n_lines, coalesce(n_distinct, 0) AS n_distinct, length(t) - length(translate(t, '{quality.CAPITALS}', '')) AS n_upper, coalesce(n_common, 0) AS n_common, length(t) - length(translate(t, '!', '')) AS n_bangs, coalesce(n_stops, 0) AS n_stops
  FROM d LEFT JOIN rp ON rp.doc_id = d.doc_id LEFT JOIN ww ON ww.doc_id = d.doc_id),
s AS (SELECT *, {_share('n_symbols', 'n_words')} AS sym, {_share('n_dup_lines', 'n_lines')} AS dup, {_share('n_repeat_words', 'n_words')} AS rep, {_share('n_upper', 'word_chars')} AS up, {_share('n_common', 'n_words')} AS com, {_share('n_distinct', 'n_words')} AS dis, {_share('word_chars', 'n_words')} AS per, {_share('n_bangs', 'n_words')} AS ban, {_share('n_words', 'n_stops')} AS sto FROM m),
v AS (SELECT *, {', '.join(f'{x} AS v_{k}' for k, x in _VOTES.items())} FROM s),
p AS (SELECT {', '.join(f'v_{k}' for k in _VOTES)}, count(*) AS n FROM v GROUP BY ALL),
em AS (SELECT 0 AS i, 0.8::DOUBLE AS prior, {', '.join(f'0.98::DOUBLE AS g_{k}, 0.7::DOUBLE AS b_{k}' for k in _VOTES)}
  UNION ALL SELECT i + 1, (sum(n * q) + 1) / (sum(n) + 2), {', '.join(f"{_accuracy('q', k)}, {_accuracy('(1 - q)', k)}" for k in _VOTES)} FROM (SELECT em.i, p.*, 1 / (1 + exp(-({_odds('em')}))) AS q FROM em, p WHERE em.i < {quality.ITERATIONS}) GROUP BY i),
z AS (SELECT v.*, 1 / (1 + exp(-({_odds('em')}))) AS quality, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM v, em WHERE em.i = {quality.ITERATIONS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(quality, 6) AS quality, NOT base_failed AND quality >= {quality.MIN_POSTERIOR} AS kept FROM z
"""

LINES = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
k AS (SELECT *, regexp_replace(line, '^[\\x09-\\x0D\\x20]+|[\\x09-\\x0D\\x20]+\\z', '', 'g') AS t FROM l),
h AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
b AS (
  SELECT k.source, t FROM k JOIN h ON k.source IS NOT DISTINCT FROM h.source WHERE t <> ''
  GROUP BY k.source, t, h.n HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_PAGES} AND count(DISTINCT doc_id) > {line_dedup.RATIO} * h.n)
SELECT k.doc_id, coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (WHERE b.t IS NULL), '') AS text,
  count(*) AS n_lines, count(b.t) AS n_dropped
FROM k LEFT JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.t = b.t GROUP BY k.doc_id
"""

ARCHIVES = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
d AS (SELECT *, sha1(html) AS s, regexp_extract(lower(url), '^[a-z]+://([^/?#]*)([^?#]*)([?][^#]+)?.*$', ['host', 'path', 'query']) AS u FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS last FROM d),
k AS (
  SELECT *, array_to_string(list_reverse(string_split(regexp_replace(u.host, '^www\\.', ''), '.')), ',') || ')' || CASE WHEN u.path = '' THEN '/' ELSE u.path END || u.query AS urlkey FROM m)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, s AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to,
  urlkey, row_number() OVER (ORDER BY urlkey, page_id) AS capture_no
FROM k
"""

ORACLE_SQL: dict[str, str] = {"op1_secret_scan": SECRETS, "op5_near_dedup": NEAR_DEDUP, "op6_chat_format": CHAT, "op7_quality": QUALITY, "op8_line_dedup": LINES, "op9_warc": ARCHIVES}
