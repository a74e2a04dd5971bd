"""DuckDB SQL for the training-data queries that SQL can express on whole tables."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM (SELECT item_id, w, least(10, len(w)) AS m FROM iw WHERE len(w) > 0))),
dwin AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM dw, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT doc_id, dwin.m, i, item_id FROM dwin JOIN win ON dwin.m = win.m AND dwin.s = win.s),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# texts are cut into stretches of 500 bytes, with what windows that start in them need, as hexadecimal digits
OP4 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (
  SELECT doc_id, c, substr(h, 2 * c + 1, 2 * 599) AS x
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 500)) AS c FROM d)),
win AS (
  SELECT doc_id, c + j AS i, substr(x, 2 * j + 1, 200) AS s
  FROM (SELECT doc_id, c, x, unnest(range(0, least(500, length(x) // 2 - 99))) AS j FROM c WHERE length(x) >= 200)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM win) WHERE rn > 1),
p AS (
  SELECT doc_id, c + j AS i, substr(x, 2 * j + 1, 2) AS byte
  FROM (SELECT doc_id, c, x, unnest(range(0, least(500, length(x) // 2))) AS j FROM c)),
last AS (
  SELECT doc_id, i, byte, max(l) OVER (PARTITION BY doc_id ORDER BY i) AS l
  FROM (SELECT p.doc_id, p.i, p.byte, later.i AS l FROM p LEFT JOIN later ON p.doc_id = later.doc_id AND p.i = later.i)),
gone AS (SELECT doc_id, i, byte, coalesce(l > i - 100, false) AS gone FROM last),
kept AS (
  SELECT doc_id, count(*) AS n_bytes, cast(sum(gone::int) AS bigint) AS n_removed,
         cast(sum((gone AND NOT coalesce(before, false))::int) AS bigint) AS n_spans,
         coalesce(string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS k
  FROM (SELECT *, lag(gone) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone) GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM win) WHERE doc_id > first),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
gone AS (
  SELECT p.doc_id, p.i, p.word, coalesce(l.i > p.i - 13, false) AS gone
  FROM p ASOF LEFT JOIN later l ON p.doc_id = l.doc_id AND p.i >= l.i),
kept AS (
  SELECT doc_id, count(*) AS n_words, cast(sum(gone::int) AS bigint) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS k
  FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = f"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UP}', '{_LOW}') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

OP10 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM common JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, low AS component_id, doc_id = low AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS low FROM reach GROUP BY x) USING (doc_id)
"""



def _crc32(x: str) -> str:
    """Unsigned crc32 of a number's decimal digits: the polynomial bit by bit."""
    codes = f"list_transform(string_split(cast({x} AS varchar), ''), lambda c: cast(ord(c) AS bigint))"
    byte = "list_reduce(list_prepend(xor(a, b), range(8)), lambda s, i: xor(s >> 1, (s & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 AS bigint), {codes}), lambda a, b: {byte}), 4294967295)"


# depth d of a conversation is the list of its first d turns; subtree sums meet each node with all its prefixes
OP11 = f"""
WITH t AS (
  SELECT conv_id, md5(concat(md5(coalesce(role, '')), md5(coalesce(text, '')))) AS x,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS bigint) AS w, turn
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(struct_pack(x := x, w := w) ORDER BY turn NULLS FIRST, x) AS l FROM t GROUP BY conv_id),
h AS (SELECT conv_id, l, {_crc32('conv_id')} % 4 AS h, conv_id - conv_id % 20 AS base FROM own),
c AS (
  SELECT h.conv_id, list_concat(coalesce(b.l, [])[1:h.h], h.l[h.h + 1:]) AS l FROM h LEFT JOIN own b ON h.base = b.conv_id),
p AS (
  SELECT conv_id, d, len(l) = d AS ends, CASE WHEN d > 0 THEN l[d].w ELSE 0 END AS w,
         array_to_string(list_transform(l[1:d], lambda e: e.x), '') AS k
  FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM c)),
node AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
         sha256(coalesce(string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY d, k),
kids AS (SELECT d - 1 AS d, left(k, 32 * (d - 1)) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
v AS (
  SELECT node.d, node.k, cast((n_convs - 1) * w AS bigint) AS saved, (kids.n IS NULL)::int AS leaf
  FROM node LEFT JOIN kids USING (d, k)),
below AS (
  SELECT a AS d, left(k, 32 * a) AS k, cast(sum(saved) AS bigint) AS saved, cast(sum(leaf) AS bigint) AS leaves
  FROM (SELECT k, saved, leaf, unnest(range(0, d + 1)) AS a FROM v) GROUP BY ALL)
SELECT node.conv_id, cast(node.d AS bigint) AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0) AS n_children,
       leaves AS n_leaves, below.saved AS saved_tokens, node.ends_sha256
FROM node JOIN below USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN node up ON up.d = node.d - 1 AND up.k = left(node.k, 32 * (node.d - 1))
"""

# periods from 5 on are tried where a multiple of the period and the next one begin with the same five words
OP12 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {_crc32('doc_id')} AS h FROM documents),
g AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS planted, len(w) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN planted THEN g % n ELSE 0 END AS a FROM g),
q AS (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM a),
r AS (SELECT doc_id, CASE WHEN planted THEN list_concat(w[1:a], list_transform(range(0, n - a), lambda i: w[a + 1 + i % p])) ELSE w END AS w FROM q),
t AS (SELECT doc_id, unnest(range(0, len(w))) AS i, unnest(w) AS x, len(w) AS n FROM r),
five AS (
  SELECT doc_id, i, n, array_to_string(w[i + 1:i + 5], ' ') AS s
  FROM (SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w) - 4)) AS i FROM r WHERE len(w) >= 5)),
period AS (
  SELECT DISTINCT x.doc_id, y.i - x.i AS q
  FROM five x JOIN five y ON x.doc_id = y.doc_id AND x.s = y.s AND y.i > x.i AND y.i - x.i BETWEEN 5 AND x.n // 4 AND x.i % (y.i - x.i) = 0
  UNION SELECT doc_id, unnest([1, 2, 3, 4]) FROM r),
same AS (
  SELECT x.doc_id, q, x.i, x.i - row_number() OVER (PARTITION BY x.doc_id, q ORDER BY x.i) AS island
  FROM period JOIN t x ON period.doc_id = x.doc_id JOIN t y ON y.doc_id = x.doc_id AND y.i = x.i + q AND y.x = x.x),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM same GROUP BY doc_id, q, island HAVING count(*) >= greatest(6 - q, 3 * q)),
run AS (SELECT doc_id, s, l, min(q) AS q FROM stretch GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l DESC, s, q) AS nth FROM run) WHERE nth = 1),
listed AS (SELECT doc_id, count(*) AS n, string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS lines FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS k FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(listed.n, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period, 1000 * best.l // best.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _escapes(c: str) -> str:
    """Backslashes that formatting adds to a text: for backslashes, for # that begin ###, for </turn>."""
    return (
        f"length({c}) - length(replace({c}, '\\', '')) + coalesce(list_sum(list_transform(regexp_extract_all({c}, '#{{3,}}'), lambda x: length(x) - 2)), 0)"
        f" + (length({c}) - length(replace({c}, '</turn>', ''))) // 7"
    )


OP13 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
n AS (SELECT *, 14 + length(r) + length(t) + {_escapes('r')} + length(r) - length(replace(r, ':', '')) + {_escapes('t')} AS size FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(r, chr(10), t, chr(10)), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
       cast(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       cast(sum(size) AS bigint) AS formatted_chars
FROM n GROUP BY conv_id
"""

ORACLE_SQL = {
    "op1_decontamination": OP1,
    "op4_suffix_dedup": OP4,
    "op7_substring_dedup": OP7,
    "op9_url_filter": OP9,
    "op10_minhash_dedup": OP10,
    "op11_prefix_trie": OP11,
    "op12_periodic_runs": OP12,
    "op13_chat_format": OP13,
}
