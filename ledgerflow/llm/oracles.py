"""DuckDB statements of the queries that SQL can express."""

# All pairs that share a shingle, and the smallest id that links lead to.
OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(ws, i, i + 4), ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= 75 * (na.n + nb.n - k)),
r AS (
  SELECT doc_id AS id, doc_id AS reach FROM d
  UNION
  SELECT r.id, e.b FROM r JOIN e ON e.a = r.reach)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT id, min(reach) AS component_id FROM r GROUP BY id) c ON c.id = d.doc_id
"""

# Covered words: the union of repeated passages of five words or more is the union of repeated
# five-word windows.  A passage of over 100 words repeats where a window of 101 words does.
OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
s AS (SELECT rid, ws, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (
  SELECT rid, i,
    CASE WHEN i + 4 <= n THEN array_to_string(list_slice(ws, i, i + 4), ' ') END AS g5,
    CASE WHEN i + 7 <= n THEN array_to_string(list_slice(ws, i, i + 7), ' ') END AS g8,
    CASE WHEN i + 100 <= n THEN md5(array_to_string(list_slice(ws, i, i + 100), ' ')) END AS g101
  FROM s),
c AS (
  SELECT rid, i,
    g5 IS NOT NULL AND count(*) OVER (PARTITION BY rid, g5) > 1 AS r5,
    g8 IS NOT NULL AND count(*) OVER (PARTITION BY rid, g8) > 1 AS r8,
    g101 IS NOT NULL AND count(*) OVER (PARTITION BY rid, g101) > 1 AS r101
  FROM g),
u AS (
  SELECT rid,
    bool_or(r5) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS u5,
    bool_or(r8) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS u8,
    r101
  FROM c),
m AS (
  SELECT rid, count(*) FILTER (WHERE u5) AS n5, count(*) FILTER (WHERE u8) AS n8, bool_or(r101) AS long_one
  FROM u GROUP BY rid),
l AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
f AS (
  SELECT w.doc_id, len(w.ws)::BIGINT AS n_words,
    length(array_to_string(w.ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.n_dup, 0)::BIGINT AS n_dup_lines, coalesce(m.n8, 0)::BIGINT AS n_repeat_words,
    coalesce(m.n5, 0) AS n5, coalesce(m.long_one, false) AS long_one
  FROM w LEFT JOIN m USING (rid) LEFT JOIN l USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND 100 * n5 <= 30 * n_words AND NOT long_one AS kept
FROM f
"""


def _kd_sql(shards: int = 16) -> str:
    """The k-d tree by windows: sums of bytes in the order of the widest dimension's keys, level by level."""
    def place(c: str) -> str:
        return (f"CASE WHEN {c} IS NULL OR max({c}) OVER () = min({c}) OVER () THEN 0 ELSE CAST(floor((CAST({c} AS DOUBLE) - "
                f"CAST(min({c}) OVER () AS DOUBLE)) * 1048575.0::DOUBLE / (CAST(max({c}) OVER () AS DOUBLE) - "
                f"CAST(min({c}) OVER () AS DOUBLE))) AS BIGINT) END")

    def bits(text: str, digits: int, drop: int) -> str:
        return f"(CAST(('0x' || substr(md5({text}), 1, {digits})) AS BIGINT) >> {drop})"

    parts = [r"""tab AS (
  SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) r(i))""", f"""l0 AS (
  SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) + 1 AS size, {place('n_chars')} AS k0,
    coalesce({bits('source', 5, 0)}, 0) AS k1, coalesce({bits('lang', 5, 0)}, 0) AS k2,
    ({bits("coalesce(text, '')", 6, 0)} << 19) | ({bits('CAST(doc_id AS VARCHAR)', 4, 1)} << 4) AS tie, 0 AS node
  FROM (SELECT doc_id, text, min(n_chars) OVER g AS n_chars, min(source) OVER g AS source, min(lang) OVER g AS lang
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))))"""]
    level, n = 0, shards
    while n > 1:  # a power of two: all nodes of a level are split alike
        rows = f"l{level}"
        extents = ", ".join(f"max(k{d}) OVER (PARTITION BY node) - min(k{d}) OVER (PARTITION BY node) AS e{d}" for d in range(3))
        key = "CASE " + " ".join(f"WHEN e{d} = greatest(e0, e1, e2) THEN k{d}" for d in range(3)) + " END"
        parts += [f"a{level} AS (SELECT *, {extents} FROM {rows})",
                  f"b{level} AS (SELECT *, (({key}) << 43) | tie AS key FROM a{level})",
                  f"c{level} AS (SELECT *, key >> 19 AS pre, sum(size) OVER (PARTITION BY node ORDER BY key >> 19) AS pre_so_far, "
                  f"sum(size) OVER (PARTITION BY node, key >> 19) AS pre_w, sum(size) OVER (PARTITION BY node) / {n}.0 / 100.0 AS whole, sum(size) OVER (PARTITION BY node ORDER BY key) AS so_far, "
                  f"sum(size) OVER (PARTITION BY node) / 2.0 AS target, sum(size) OVER (PARTITION BY node, key) AS w FROM b{level})",
                  f"d{level} AS (SELECT node, min(key) AS cut, arg_min(pre_w <= whole, key) AS by_group FROM c{level} WHERE so_far >= target GROUP BY node)",
                  f"""l{level + 1} AS (
  SELECT doc_id, t, size, k0, k1, k2, tie, node * 2 + CASE
    WHEN by_group THEN CASE WHEN pre < cut >> 19 THEN 0
      WHEN pre = cut >> 19 AND abs(pre_so_far - target) < abs(pre_so_far - pre_w - target) THEN 0 ELSE 1 END
    WHEN key < cut THEN 0
    WHEN key = cut AND abs(so_far - target) < abs(so_far - w - target) THEN 0 ELSE 1 END AS node
  FROM c{level} JOIN d{level} USING (node))"""]
        level, n = level + 1, n // 2
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, CAST(size AS BIGINT) AS size,
  xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST(('0x' || x) AS BIGINT)),
    lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS text_crc32,
  'bytes' AS law, CAST(node AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY node ORDER BY (tie >> 4) % greatest(64, (SELECT count(*) FROM documents) // {shards * 20_000}), tie, doc_id) - 1
    AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM l{level}, tab"""


OP6_SQL = _kd_sql()


# All phrases of one to four words counted, then the rules of the list on whole tables.
OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (
  SELECT lang, k, list_slice(ws, i, i + k - 1) AS ws, count(*) AS n
  FROM i, range(1, 5) r(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidate AS (SELECT lang, k, ws, n AS a FROM f WHERE k > 1 AND n >= 30),
scored AS (
  SELECT c.lang, c.ws, c.a, x.n AS l, y.n AS r, (2000000::HUGEINT * c.a) // (x.n + y.n) AS score,
    row_number() OVER (PARTITION BY c.lang, c.ws ORDER BY (2000000::HUGEINT * c.a) // (x.n + y.n), cut) AS nth
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidate) c
  JOIN f x ON x.lang = c.lang AND x.ws = list_slice(c.ws, 1, cut)
  JOIN f y ON y.lang = c.lang AND y.ws = list_slice(c.ws, cut + 1, c.k)),
longer AS (
  SELECT lang, list_slice(ws, b, b + size - 1) AS ws, max(a) AS a
  FROM candidate, range(2, 4) s(size), range(1, 4) t(b) WHERE size < k AND b + size - 1 <= k GROUP BY ALL),
kept AS (
  SELECT s.lang, array_to_string(s.ws, ' ') AS phrase, s.a, s.l, s.r, s.score
  FROM scored s LEFT JOIN longer o ON o.lang = s.lang AND o.ws = s.ws
  WHERE s.nth = 1 AND (o.a IS NULL OR 100::HUGEINT * o.a < 80::HUGEINT * s.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

# Each window of 20 words by its words; a word goes with any window that isn't the first of its kind.
OP12_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
h AS (
  SELECT doc_id, ws[i] AS word, i, CASE WHEN i + 19 <= len(ws) THEN md5(array_to_string(list_slice(ws, i, i + 19), ' ')) END AS h
  FROM s),
g AS (
  SELECT doc_id, word, i, h IS NOT NULL AND row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS later FROM h),
c AS (
  SELECT doc_id, word, i, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM g),
k AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM c GROUP BY doc_id)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

# Near words share a pattern: with one letter replaced by a star, or with a star put between two.
OP13_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) r(i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zÀ-ÿ]+')) AS run
  FROM documents),
each AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce([4294967295::BIGINT] || list_transform(
    regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'), lambda x: CAST(('0x' || x) AS BIGINT)),
    lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM each, tab),
made AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
    ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
patterns AS (
  SELECT word, n, substr(word, 1, CAST(i AS INTEGER)) || '*' || substr(word, CAST(i AS INTEGER) + 1 + d) AS p
  FROM (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM words), (VALUES (0), (1)) v(d) WHERE i < length(word) OR d = 0),
pairs AS (SELECT DISTINCT x.word, y.word AS near, y.n AS near_n FROM patterns x JOIN patterns y ON x.p = y.p AND x.word <> y.word),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS nth
  FROM pairs),
found AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.nth = 1),
chain AS (
  SELECT word, form AS root FROM found WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN found f ON f.word = c.root WHERE f.form IS NOT NULL),
last AS (SELECT c.word, c.root FROM chain c JOIN found f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(l.root, f.word) AS root, f.n, f.n_near, f.form_n FROM found f LEFT JOIN last l USING (word)
"""
