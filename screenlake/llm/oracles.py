"""SQL giving the rows of the queries that SQL can express."""

from __future__ import annotations

from screenlake.llm.licenses import LEAD, LOOSE, SPELLINGS, known_texts
from screenlake.llm.pii import CONTEXT, KINDS, NEARBY, SCORES, THRESHOLD
from screenlake.llm.urls import LISTED, UNWANTED, pattern_rule

_WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d
),
k AS (SELECT doc_id, pos, line, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
f AS (SELECT k.doc_id, pos, line, s.keeper IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


def _spell(words: str) -> str:
    for said, meant in SPELLINGS:
        a, b = (f"  {x.replace(' ', '  ')}  "[1:-1] for x in (said, meant))
        words = f"replace({words}, '{a}', '{b}')"
    return f"trim(regexp_replace({words}, ' +', ' ', 'g'))"


def _plain(text: str) -> str:
    bare = rf"regexp_replace(lower({text}), '(?m)^[ \t\r*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*$', '', 'g')"
    return rf"'  ' || regexp_replace({bare}, '[^0-9a-z\n\x{{80}}-\x{{10FFFF}}]+', '  ', 'g') || '  '"


def _canonical(text: str) -> str:
    return _spell(f"replace({_plain(text)}, chr(10), '  ')")


def _notice_line(line: str) -> str:
    """True for a copyright line that does not go on with a sentence. RE2 cannot look ahead: two patterns and a third one against them."""
    begin, name = r"^[ \t\r*#/;-]*", r"(Copyright|COPYRIGHT)[ \t]+"
    sure = r"(?i:copyright[ \t]*(\(c\)|©|[0-9:])|\(c\)[ \t]*(copyright|©|[0-9]{4})|©|all rights reserved)"
    goes_on = (r"(?i:holder|owner|notice|licen|law|statement|interest|treat|disclaimer|doctrine|material|permission|protection|right|status"
               r"|and\b|or\b|in\b|on\b|to\b|is\b)")
    return (f"(regexp_matches({line}, '{begin}{sure}') OR "
            f"(regexp_matches({line}, '{begin}{name}[^ \\t]') AND NOT regexp_matches({line}, '{begin}{name}{goes_on}')))")


_WORDS = "list_transform(string_split(line, ' '), lambda w: CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LOOSE.items()) + " ELSE w END)"


def licenses_sql(known: list[tuple[str, str]]) -> str:
    """scan_licenses() with the known texts in the statement; doc_id is unique and not null.

    Known texts and documents are cut into canonical lines alike. A run of lines that begins with the first
    letters of a known text and is as long is digested as a whole, and met with the digests.
    """
    line = _spell(r"'  ' || regexp_replace(lower(line), '[^0-9a-z\x{80}-\x{10FFFF}]+', '  ', 'g') || '  '")
    joined = _spell("'  ' || replace(array_to_string(lines[a.i:e.i], ' '), ' ', '  ') || '  '")
    return f"""
WITH n(license, text) AS (VALUES {', '.join(f'({_quoted(a)}, {_quoted(b)})' for a, b in known)}),
src AS (
  SELECT false AS own, row_number() OVER () AS id, license, text AS t FROM n
  UNION ALL SELECT true, doc_id, NULL, coalesce(text, '') FROM documents
),
w AS (SELECT own, id, license, {_canonical('t')} AS whole FROM src),
cut AS (SELECT own, id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM src),
canon AS (SELECT own, id, pos, {line} AS line FROM cut WHERE NOT {_notice_line('line')}),
l AS (
  SELECT own, id, line, array_to_string({_WORDS}, '') AS letters, row_number() OVER (PARTITION BY own, id ORDER BY pos) AS i
  FROM canon WHERE line <> ''
),
p AS (
  SELECT *, CAST(sum(length(letters)) OVER (PARTITION BY own, id ORDER BY i) AS BIGINT) AS stop,
    string_agg(left(letters, {LEAD}), '') OVER (PARTITION BY own, id ORDER BY i ROWS BETWEEN CURRENT ROW AND {LEAD} FOLLOWING) AS begun
  FROM l
),
x AS (SELECT own, id, list(line ORDER BY i) AS lines, max(stop) AS size, min(begun) FILTER (i = 1) AS begun FROM p GROUP BY own, id),
short AS (SELECT least({LEAD}, min(size)) AS n FROM x WHERE NOT own),
starts AS (SELECT DISTINCT left(begun, n) AS begun, size FROM x, short WHERE NOT own),
known AS (
  SELECT digest, min(license) AS license FROM (
    SELECT sha256(whole) AS digest, license FROM w WHERE NOT own AND whole <> ''
    UNION ALL SELECT sha256({joined.replace('lines[a.i:e.i]', 'lines')}), license FROM x JOIN w USING (own, id) WHERE NOT own
  ) GROUP BY digest
),
r AS (
  SELECT a.id, a.i, e.i - a.i + 1 AS n, len(lines) AS of, sha256({joined}) AS digest
  FROM (SELECT p.id, p.i, stop - length(letters) + size AS stop FROM p, short, starts WHERE own AND left(p.begun, short.n) = starts.begun) a
  JOIN p e ON e.own AND e.id = a.id AND e.stop = a.stop
  JOIN x ON x.own AND x.id = a.id
),
h AS (SELECT id, i, n, of, license, max(i + n) OVER (PARTITION BY id ORDER BY i, -n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r JOIN known USING (digest)),
g AS (
  SELECT id, max(license) FILTER (n = of) AS entire, count(*) FILTER (i + n > coalesce(before, 0)) AS n,
    string_agg(DISTINCT license, ',' ORDER BY license) FILTER (i + n > coalesce(before, 0)) AS names
  FROM h GROUP BY id
)
SELECT w.id AS doc_id, sha256(whole) AS text_digest, coalesce(known.license, entire) AS text_license,
  coalesce(n, 0) AS n_notices, coalesce(names, '') AS notice_licenses
FROM w LEFT JOIN known ON sha256(whole) = digest LEFT JOIN g ON w.id = g.id
WHERE own
"""


LICENSES = licenses_sql(known_texts())

# The patterns as RE2 reads them: without possessive runs and looking around.
_RE2 = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_NUMBER = f"list_reverse(string_split({_DIGITS}, ''))"
_LUHN = f"""list_sum(list_transform({_NUMBER}, lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INTEGER)
  ELSE CAST(c AS INTEGER) * 2 // 10 + CAST(c AS INTEGER) * 2 % 10 END)) % 10 = 0"""
_TURNED = "substr(replace(hit, ' ', ''), 5) || substr(replace(hit, ' ', ''), 1, 4)"
_MOD97 = f"""list_reduce(list_prepend(0, list_transform(string_split({_TURNED}, ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN CAST(c AS INTEGER)
  ELSE ascii(c) - 55 END)), lambda a, x: (a * CASE WHEN x < 10 THEN 10 ELSE 100 END + x) % 97) = 1"""
_CHECKS = {
    "email": "true",
    "ip": "len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
    "iban": _MOD97,
    "ssn": "substr(hit, 1, 3) NOT IN ('000', '666') AND substr(hit, 1, 3) < '900' AND substr(hit, 5, 2) <> '00' AND substr(hit, 8) <> '0000'",
}


def _kind(kind: str) -> str:
    """Spans of one kind with their scores: positions are running sums over the pieces between matches.

    Context words count in the NEARBY characters of the text before and after the span, by position.
    """
    low, high = SCORES[kind]
    near = f"'(?i)(?:^|[^a-z])(?:{CONTEXT[kind]})(?:$|[^a-z])'"
    return rf"""
SELECT doc_id, {KINDS.index(kind)} AS k, '{kind}' AS name, start, start + length(hit) AS stop,
  CASE WHEN regexp_matches(substr(t, greatest(start - {NEARBY}, 0) + 1, least(start, {NEARBY})), {near})
    OR regexp_matches(substr(t, start + length(hit) + 1, {NEARBY}), {near}) THEN {high} ELSE {low} END AS score
FROM (
  SELECT doc_id, t, hit, CAST(sum(length(gap)) OVER w
    + coalesce(sum(length(hit)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM (
    SELECT doc_id, t, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i
    FROM (SELECT doc_id, t, regexp_extract_all(t, '{_RE2[kind]}') AS hits, string_split_regex(t, '{_RE2[kind]}') AS gaps FROM d)
  ) WINDOW w AS (PARTITION BY doc_id ORDER BY i)
) WHERE {_CHECKS[kind]}"""


_ALL = " UNION ALL ".join(_kind(k) for k in KINDS)
PERSONAL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT *, name || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS said FROM ({_ALL}) WHERE k < 4 OR score >= {THRESHOLD})
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card,
  count(*) FILTER (k = 3) AS n_phone,
  sha256(coalesce(string_agg(said, ',' ORDER BY k, start) FILTER (k < 4), '')) AS base_sha256,
  coalesce(string_agg(said, ',' ORDER BY k, start), '') AS spans, CAST(coalesce(max(score), 0) AS DOUBLE) AS max_score
FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id
"""


def _field(column: str) -> str:
    """A field with its number of bytes in front, null as `-`."""
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _hash(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# Every level of a tree is a list; the next one hashes its runs of three.
_NEXT_LEVEL = "list_transform(range(0, CAST(ceil(len(nodes) / 3) AS BIGINT)), lambda i: sha256(array_to_string(nodes[i * 3 + 1:i * 3 + 3], '')))"
_LEFT = "array_to_string(nodes[pos // 3 * 3 + 1:pos], '')"
_RIGHT = "array_to_string(nodes[pos + 2:pos // 3 * 3 + 3], '')"
MERKLE = f"""
WITH RECURSIVE c AS (
  SELECT range AS byte, range AS v, 0 AS step FROM range(0, 256)
  UNION ALL SELECT byte, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, step + 1 FROM c WHERE step < 8
),
crc AS (SELECT list(v ORDER BY byte) AS steps FROM c WHERE step = 8),
d AS (
  SELECT doc_id, source, {_hash('text')} AS leaf, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
    CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(a // 256, steps[xor(a % 256, b) + 1])), 4294967295) % 2 = 0 THEN {_hash("replace(text, chr(10), '')")} ELSE {_hash('text')} END AS checked
  FROM documents, crc
),
t AS (
  SELECT source, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM d GROUP BY source
  UNION ALL SELECT source, level + 1, {_NEXT_LEVEL} FROM t WHERE len(nodes) > 1
),
s AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM t WHERE len(nodes) = 1),
u AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM s
  UNION ALL SELECT level + 1, {_NEXT_LEVEL} FROM u WHERE len(nodes) > 1
),
p AS (
  SELECT doc_id, source, pos, 0 AS level, checked AS h, '' AS proof FROM d
  UNION ALL SELECT doc_id, p.source, pos // 3, p.level + 1, sha256({_LEFT} || h || {_RIGHT}), proof || {_LEFT} || {_RIGHT}
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source AND p.level = t.level WHERE len(nodes) > 1
),
q AS (
  SELECT p.doc_id, p.source, s.pos, 0 AS level, h, proof, subroot
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source AND p.level = t.level AND len(nodes) = 1 JOIN s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL SELECT doc_id, source, pos // 3, q.level + 1, sha256({_LEFT} || h || {_RIGHT}), proof || {_LEFT} || {_RIGHT}, subroot
  FROM q JOIN u ON q.level = u.level WHERE len(nodes) > 1
)
SELECT q.doc_id, leaf, subroot, nodes[1] AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = nodes[1] AS verified
FROM q JOIN u ON q.level = u.level AND len(nodes) = 1 JOIN d ON q.doc_id = d.doc_id
"""

_LISTED = ", ".join(f"({', '.join(map(_quoted, r))})" for r in LISTED)
_UNWANTED = ", ".join(f"({_quoted(p)}, {_quoted(pattern_rule('block', p).regex)})" for p in UNWANTED)
URLS = rf"""
WITH r(verdict, host, path) AS (VALUES {_LISTED}), w(pattern, regex) AS (VALUES {_UNWANTED}),
u AS (
  SELECT DISTINCT url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(.*)', 1), '') AS rest
  FROM pages
),
l AS (
  SELECT url, r.host || r.path AS rule, verdict, row_number() OVER (PARTITION BY url ORDER BY length(r.host || r.path) DESC, verdict DESC, r.host || r.path) AS n
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
),
b AS (
  SELECT url, pattern, row_number() OVER (PARTITION BY url ORDER BY length(pattern) DESC, pattern) AS n
  FROM u JOIN w ON regexp_matches(u.host || u.rest, regex)
)
SELECT page_id, u.host, u.path, rule, pattern, coalesce(verdict, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM pages p JOIN u ON p.url IS NOT DISTINCT FROM u.url LEFT JOIN l ON l.url = u.url AND l.n = 1 LEFT JOIN b ON b.url = u.url AND b.n = 1
"""

ORACLES: dict[str, str] = {
    "op3_license_scan": LICENSES,
    "op6_line_dedup": LINE_DEDUP,
    "op9_personal_data": PERSONAL,
    "op10_exact_top_k": TOP_K,
    "op11_merkle_manifest": MERKLE,
    "op12_url_filter": URLS,
}
