"""DuckDB SQL for the queries whose operators have no SQL beside them.

Written from the contracts of the queries, not from the operators: every window,
byte string, shingle and match is listed and counted. ``doc_id`` and ``page_id`` are
unique and not null in the given tables.
"""

OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM d),
x AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM d WHERE len(ws) >= 50)),
s AS (SELECT g, min(doc_id) AS low FROM x GROUP BY g),
c AS (SELECT doc_id, p FROM x JOIN s USING (g) WHERE low < doc_id),
k AS (SELECT w.doc_id, w.p, word, max(CASE WHEN c.p IS NULL THEN 0 ELSE 1 END) OVER (
        PARTITION BY w.doc_id ORDER BY w.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS dead
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id AND c.p = w.p),
r AS (SELECT doc_id, sum(dead) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE dead = 0) AS kept
      FROM k GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""

# Texts are cut into pieces of 1000 string starts, since substr walks from the start of its string.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, k, substr(h, 2 * k + 1, 2398) AS piece
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 1000)) AS k FROM d)),
b AS (SELECT doc_id, k + j AS p, substr(piece, 2 * j + 1, 2) AS byte, substr(piece, 2 * j + 1, 400) AS s
      FROM (SELECT doc_id, k, piece, unnest(range(0, least(1000, len(piece) // 2))) AS j FROM c)),
x AS (SELECT doc_id, p, byte, CASE WHEN len(s) = 400 THEN md5(s) END AS g FROM b),
t AS (SELECT g FROM x WHERE g IS NOT NULL GROUP BY g HAVING count(*) > 1),
m AS (SELECT doc_id, p, byte, max(CASE WHEN t.g IS NULL THEN 0 ELSE 1 END) OVER (
        PARTITION BY doc_id ORDER BY p ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS dead
      FROM x LEFT JOIN t ON t.g = x.g),
n AS (SELECT *, lag(dead, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM m),
r AS (SELECT doc_id, sum(dead) AS n_removed, sum(CASE WHEN dead > before THEN 1 ELSE 0 END) AS n_spans,
             string_agg(byte, '' ORDER BY p) FILTER (WHERE dead = 0) AS kept FROM n GROUP BY doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""

# The patterns of the kinds, longest match, and the group that is the value.
_KINDS = (
    (r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2),
    ("AKIA[A-Z0-9]+", 0),
    ("[0-9a-f]+", 0),
    ("[A-Za-z0-9+/_=-]+", 0),
)
_MATCHES = " UNION ALL ".join(
    f"""SELECT doc_id, owner, {kind} AS kind, string_split_regex(t, '{regex}') AS pre,
       regexp_extract_all(t, '{regex}') AS w, regexp_extract_all(t, '{regex}', {group}) AS v FROM d"""
    for kind, (regex, group) in enumerate(_KINDS))

OP3_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS owner, coalesce(text, '') AS t FROM documents),
a AS ({_MATCHES}),
u AS (SELECT doc_id, owner, kind, unnest(range(0, len(w))) AS i, unnest(pre[1:len(w)]) AS pre, unnest(w) AS w, unnest(v) AS v FROM a),
s AS (SELECT doc_id, owner, kind, v, len(w) AS n, sum(len(pre) + len(w)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM u),
f AS (SELECT doc_id, owner, kind, v, (stop - n)::BIGINT AS start, stop::BIGINT AS stop FROM s
      WHERE (kind = 0 AND len(v) >= 6) OR (kind = 1 AND len(v) >= 20) OR (kind = 2 AND len(v) >= 24)
         OR (kind = 3 AND len(v) >= 20 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]'))),
o AS (SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT (owner, doc_id)) AS repos FROM f GROUP BY v),
l AS (SELECT f.*, owners < 3 AND repos < 20 AS live FROM f JOIN o USING (v)),
k AS (SELECT *, ['assign', 'access', 'hex', 'generic'][kind + 1] || ':' || start || ':' || stop AS label FROM l
      WHERE kind < 3 OR (live AND NOT EXISTS (
        SELECT 1 FROM l AS b WHERE b.doc_id = l.doc_id AND b.kind < 3 AND b.start < l.stop AND l.start < b.stop))),
r AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
             count(*) FILTER (WHERE kind = 2) AS n_hex, string_agg(label, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
             string_agg(label, ',' ORDER BY start, kind) AS spans, count(*) FILTER (WHERE live) AS n_live FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""

OP4_SQL = r"""
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS best FROM d)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, i // 8 * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM r
"""

# r: a component's smallest id reaches its members through larger ids only.
OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[p:p + least(4, len(ws)) - 1], ' ')) AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(4, len(ws)) + 2)) AS p FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, low) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.doc_id WHERE r.low < e.b),
m AS (SELECT doc_id, min(low) AS low FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.low AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.doc_id = d.doc_id
"""

# Fixed value: the reversed polynomial of the checksum; its table and the checksum of an ASCII string ``k``.
_CRC = """list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))"""
_CRC_TABLE = """SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc"""


def _field(name: str) -> str:
    return f"coalesce(octet_length(encode({name}::VARCHAR))::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _leaf(count: str) -> str:
    return f"sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field(count)} || {_field('text')})"


# t: nodes of the trees of the groups by level, r: of the tree over their roots; s: siblings with their side;
# f: the claimed leaf folded along them.
OP11_SQL = f"""
WITH RECURSIVE x AS ({_CRC_TABLE}),
m AS (SELECT *, xor({_CRC}, 4294967295) % 7 = 0 AS bad FROM (SELECT *, doc_id::VARCHAR AS k FROM documents), x),
d AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf, {_leaf('changed')} AS claim,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i
      FROM (SELECT *, CASE WHEN bad THEN n_chars + 1 ELSE n_chars END AS changed FROM m)),
t(lang, level, i, h, n) AS (
  SELECT lang, 0, i, leaf, count(*) OVER (PARTITION BY lang) FROM d
  UNION ALL
  SELECT lang, max(level) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, i // 2),
g AS (SELECT lang, level AS high, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t WHERE n = 1),
r(level, i, h, n) AS (
  SELECT 0, i, subroot, count(*) OVER () FROM g
  UNION ALL
  SELECT max(level) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM r WHERE n > 1 GROUP BY i // 2),
e AS (SELECT level AS high, h AS root FROM r WHERE n = 1),
a AS (SELECT d.doc_id, d.lang, t.level AS up, (t.i % 2) AS side, o.h FROM d JOIN t ON t.lang IS NOT DISTINCT FROM d.lang AND t.n > 1 AND t.i = d.i >> t.level
      LEFT JOIN t o ON o.lang IS NOT DISTINCT FROM t.lang AND o.level = t.level AND o.i = xor(t.i, 1)
      UNION ALL
      SELECT d.doc_id, d.lang, g.high + r.level, (r.i % 2), o.h FROM d JOIN g ON g.lang IS NOT DISTINCT FROM d.lang
      JOIN r ON r.n > 1 AND r.i = g.i >> r.level LEFT JOIN r o ON o.level = r.level AND o.i = xor(r.i, 1)),
p AS (SELECT doc_id, sha256(coalesce(string_agg(h, '' ORDER BY up), '')) AS proof_sha256, max(up) + 1 AS steps FROM a GROUP BY doc_id),
f(doc_id, up, h) AS (
  SELECT doc_id, 0, claim FROM d
  UNION ALL
  SELECT f.doc_id, f.up + 1, sha256(CASE WHEN a.h IS NULL THEN f.h WHEN a.side = 1 THEN a.h || f.h ELSE f.h || a.h END)
  FROM f JOIN a ON a.doc_id = f.doc_id AND a.up = f.up)
SELECT d.doc_id, d.leaf, g.subroot, e.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = e.root AS verified
FROM d JOIN g ON g.lang IS NOT DISTINCT FROM d.lang CROSS JOIN e LEFT JOIN p ON p.doc_id = d.doc_id
JOIN f ON f.doc_id = d.doc_id AND f.up = coalesce(p.steps, 0)
"""

# u: every distinct text or name with its checksum, byte by byte; h: the curve on all cells of three
# axes of four bits, the rotations undone from the highest bit down (nine steps), then Gray code;
# the length's axis is the largest e up to 15 with 2 ** (1.5 e) <= bytes + 1.
OP8_SQL = f"""
WITH RECURSIVE x AS ({_CRC_TABLE}),
w AS (SELECT coalesce(text, '') AS v FROM documents UNION SELECT source FROM documents UNION SELECT lang FROM documents),
u AS (SELECT v, xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(v)), '..'), lambda y: ('0x' || y)::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS k FROM w, x WHERE v IS NOT NULL),
h(s, a, b, c, x, y, z) AS (
  SELECT 0, i // 256, i // 16 % 16, i % 16, i // 256, i // 16 % 16, i % 16 FROM range(0, 4096) r(i)
  UNION ALL
  SELECT s + 1, a, b, c, CASE WHEN (v & q) <> 0 THEN xor(x, q - 1) ELSE xor(x, t) END,
         CASE WHEN s % 3 = 1 AND (v & q) = 0 THEN xor(y, t) ELSE y END, CASE WHEN s % 3 = 2 AND (v & q) = 0 THEN xor(z, t) ELSE z END
  FROM (SELECT *, xor(x, v) & (q - 1) AS t FROM (SELECT *, 8 >> (s // 3) AS q, [x, y, z][s % 3 + 1] AS v FROM h WHERE s < 9))),
g AS (SELECT a, b, c, [xor(x, f), xor(y, f), xor(z, f)] AS p FROM (
        SELECT *, xor(xor(CASE WHEN (z & 8) <> 0 THEN 7 ELSE 0 END, CASE WHEN (z & 4) <> 0 THEN 3 ELSE 0 END), CASE WHEN (z & 2) <> 0 THEN 1 ELSE 0 END) AS f
        FROM (SELECT a, b, c, x, xor(x, y) AS y, xor(xor(x, y), z) AS z FROM h WHERE s = 9))),
o AS (SELECT a, b, c, list_sum(list_transform(range(0, 12), lambda i: ((p[i % 3 + 1] >> (3 - i // 3)) & 1) << (11 - i))) AS curve FROM g),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, t.k AS crc, coalesce(m.k, 0) % 16 AS a, coalesce(l.k, 0) % 16 AS b
      FROM documents JOIN u t ON t.v = coalesce(text, '') LEFT JOIN u m ON m.v = source LEFT JOIN u l ON l.v = lang),
e AS (SELECT *, len(list_filter(range(1, 16), lambda j: (n + 1)::HUGEINT * (n + 1) >= 1::HUGEINT << (3 * j)::INT)) AS c FROM d),
r AS (SELECT doc_id, n + 8 AS size, crc, row_number() OVER (
        ORDER BY curve, md5(coalesce(doc_id::VARCHAR, '') || ':' || crc), doc_id NULLS FIRST, crc, n) - 1 AS pos, count(*) OVER () AS total
      FROM e JOIN o USING (a, b, c))
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (pos * 24 // total)::INT AS shard,
       (pos - (pos * 24 // total * total + 23) // 24)::BIGINT AS slot, NULL::INT AS grown_shard
FROM r
"""

# b: cheapest way to every state after i rows, with its edits; an inserted row (i stays) is
# tried before every row and at the end. State 0: nothing read, 1: system, 2: user, 3: assistant.
_INSERTED = """SELECT conv, i, CASE WHEN q = 2 THEN 3 ELSE 2 END AS q, cost + 5 AS cost, audit || 'I' AS audit,
               done || [CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END] AS done"""
_BEST = """SELECT conv, i, q, min(struct_pack(cost := cost, audit := audit, done := done)) AS b"""
OP12_SQL = f"""
WITH RECURSIVE x AS ({_CRC_TABLE}),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
      FROM conversations),
m AS (SELECT *, xor({_CRC}, 4294967295) % 20 AS mode FROM c, x),
g AS (SELECT conv_id, turn, CASE WHEN mode = 4 THEN 'user' ELSE role END AS role,
             CASE mode WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN mode = 3 THEN [1, 2] ELSE [1] END) AS copy FROM m WHERE mode <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
             substr(role, 1, 1) AS one, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM g),
f AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN body[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
             lag(one) OVER (PARTITION BY conv_id ORDER BY i) || one AS pair FROM o),
s AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
             count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
             count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
w AS (SELECT conv_id AS conv, i, one, role || ':' || text AS line, ':' || text AS rest, fault IN ('blank', 'duplicate') AS dead,
             CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM f),
v(conv, i, q, b) AS (
  SELECT conv_id, 0, 0, struct_pack(cost := 0, audit := '', done := []::VARCHAR[]) FROM s
  UNION ALL
  ({_BEST} FROM (
    SELECT p.conv, p.i + 1 AS i, u.q, p.cost + u.cost AS cost, p.audit || u.edit AS audit, p.done || u.line AS done
    FROM (SELECT conv, i, q, b.cost AS cost, b.audit AS audit, b.done AS done FROM v
          UNION ALL {_INSERTED} FROM (SELECT conv, i, q, b.cost AS cost, b.audit AS audit, b.done AS done FROM v)) p
    JOIN w ON w.conv IS NOT DISTINCT FROM p.conv AND w.i = p.i + 1,
    LATERAL (SELECT unnest(list_filter([
        {{'ok': true, 'q': p.q, 'cost': 2, 'edit': 'D', 'line': []::VARCHAR[]}},
        {{'ok': NOT w.dead AND CASE w.one WHEN 's' THEN p.q = 0 WHEN 'u' THEN p.q <> 2 WHEN 'a' THEN p.q = 2 ELSE false END,
          'q': CASE w.one WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'cost': w.more, 'edit': 'K', 'line': [w.line]}},
        {{'ok': NOT w.dead, 'q': CASE WHEN p.q = 2 THEN 3 ELSE 2 END, 'cost': 1 + w.more, 'edit': 'R',
          'line': [CASE WHEN p.q = 2 THEN 'assistant' ELSE 'user' END || w.rest]}}], lambda y: y.ok), recursive := true)) u)
   GROUP BY conv, i, q)),
z AS (SELECT v.conv, v.q, b.cost AS cost, b.audit AS audit, b.done AS done FROM v JOIN s ON s.conv_id IS NOT DISTINCT FROM v.conv AND s.n = v.i),
y AS (SELECT conv, min(struct_pack(cost := cost, audit := audit, done := done)) AS b
      FROM (SELECT * FROM z UNION ALL SELECT conv, q, cost, audit, done FROM ({_INSERTED.replace(' i, ', ' ')} FROM z)) WHERE q IN (0, 3) GROUP BY conv)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.done, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN y ON y.conv IS NOT DISTINCT FROM a.conv_id
"""
