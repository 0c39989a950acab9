"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Hit words of ``{documents}`` by windows of ``benchmark``; ends with relation hits(rid, item_id, i, n).
WINDOWS = f"""
d AS (SELECT row_number() OVER () AS rid, *, {_WORDS.format("text")} AS words FROM {{documents}}),
b AS (SELECT item_id, {_WORDS.format("text")} AS words FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n,
         unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1), lambda i: array_to_string(words[i:i + least(len(words), 10) - 1], ' '))) AS win
  FROM b WHERE len(words) > 0),
p AS (SELECT rid, words, unnest(range(1, len(words) + 1)) AS i FROM d),
w AS (SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS win FROM p, (SELECT DISTINCT n FROM g) WHERE i + n - 1 <= len(words)),
hits AS (SELECT rid, item_id, i, w.n FROM w JOIN g ON w.n = g.n AND w.win = g.win)"""

OP7 = f"""
WITH {WINDOWS.format(documents="documents")},
placed AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM hits) GROUP BY rid),
named AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits GROUP BY rid),
runs AS (
  -- the longest verbatim match: windows of an item that follow one another in both texts
  SELECT rid, max(len) AS longest FROM (
    SELECT rid, max(i + n) - min(i) AS len FROM (
      SELECT h.rid, h.item_id, h.i, h.n, q.j, h.i - q.j AS diagonal,
             q.j - row_number() OVER (PARTITION BY h.rid, h.item_id, h.i - q.j ORDER BY q.j) AS island
      FROM hits h JOIN d ON d.rid = h.rid
      JOIN (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS j FROM b WHERE len(words) > 0) q
        ON q.item_id = h.item_id AND q.words[q.j:q.j + h.n - 1] = d.words[h.i:h.i + h.n - 1])
    GROUP BY rid, item_id, diagonal, island) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM d LEFT JOIN placed USING (rid) LEFT JOIN named USING (rid) LEFT JOIN runs USING (rid)"""

OP5 = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l),
c AS (SELECT *, (coalesce(lag(h) OVER (PARTITION BY rid ORDER BY i), 0) * 31 + h) % 3 = 0 AS cut FROM h),
k AS (SELECT *, coalesce(sum(CAST(cut AS INT)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM c),
body AS (SELECT rid, doc_id, chunk, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM k GROUP BY rid, doc_id, chunk),
ranked AS (SELECT *, count(*) OVER (PARTITION BY body) AS copies, rank() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, chunk) AS place FROM body WHERE n > 1),
gone AS (SELECT rid, chunk FROM ranked WHERE copies > 1 AND place > 1),
kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM k ANTI JOIN gone USING (rid, chunk) GROUP BY rid)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines), 0) - coalesce(n, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN kept USING (rid)"""

#: Mixing of relation ``{documents}``; ends with relation mixed(rid, doc_id, size, source_size, target, taken).
MIX = r"""
z AS (SELECT row_number() OVER () AS rid, *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM {documents}),
u AS (
  SELECT *, -ln((CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 1) / 4503599627370496.0)
    / (1.0 + CASE WHEN length(text) / greatest(size, 1) BETWEEN 3 AND 12 THEN 0.75 ELSE 0 END + CASE WHEN length(text) >= 200 THEN 0.25 ELSE 0 END) AS rank_key
  FROM z),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM z GROUP BY source),
v AS (SELECT *, [5.0, 2.0, 1.0][(k - 1) % 3 + 1] AS w, 1.5 * (SELECT sum(size) FROM z) AS total FROM s),
lv AS (SELECT *, 2.0 * source_size / w AS level FROM v),
st AS (
  -- at the level of each source: what all sources would hold
  SELECT a.level, (any_value(a.total) - sum(CASE WHEN b.level < a.level OR (b.level = a.level AND b.k < a.k) THEN 2.0 * b.source_size ELSE 0 END))
     / sum(CASE WHEN b.level < a.level OR (b.level = a.level AND b.k < a.k) THEN 0 ELSE b.w END) AS water
  FROM lv a, lv b GROUP BY a.level, a.k),
tg AS (SELECT source, source_size, least(2.0 * source_size, w * coalesce((SELECT arg_min(water, level) FROM st WHERE water < level), 1e300)) AS target FROM lv),
rest AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM tg),
o AS (
  SELECT u.*, source_size, target, epochs, target - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY u.source ORDER BY rank_key, substr(md5(coalesce(text, '')), 1, 12), doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM u JOIN rest ON u.source IS NOT DISTINCT FROM rest.source),
mixed AS (SELECT *, CAST(epochs + CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies, CAST(size * copies AS BIGINT) AS taken FROM o)"""

OP9 = f"""
WITH {MIX.format(documents="documents")}
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, CAST(target AS DOUBLE) AS target,
       CAST(epochs AS BIGINT) AS epochs, copies, taken FROM mixed"""

OP12 = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM t),
w AS (SELECT rid, lang, source, unnest(terms) AS term FROM t),
vocab AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN vocab USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, vocab.term, coalesce(c.n, 0) AS n, vocab.n AS n_lang
  FROM g JOIN vocab ON vocab.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = vocab.term),
s AS (
  SELECT lang, source, term, n,
         1 + (CAST(n + 1 AS HUGEINT) * 1000000000) // CAST(sum(n) OVER own + count(*) OVER own AS HUGEINT) AS p,
         1 + (CAST(n_lang + 1 AS HUGEINT) * 1000000000) // CAST(sum(n_lang) OVER own + count(*) OVER own AS HUGEINT) AS q
  FROM dense WINDOW own AS (PARTITION BY lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM s WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200"""

#: In a run of smallest period q equal stretches of 16 words follow one another at the distance q: islands of such pairs.
#: Of periods of one stretch the smallest counts. crc32 is worked out bit by bit.
OP11 = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(4294967295, list_reduce([4294967295] || list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda v, b: list_reduce([xor(v, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM documents),
g AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a FROM t),
c AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
d AS (SELECT rid, doc_id, CAST(n AS BIGINT) AS n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM c),
k AS (SELECT rid, unnest(range(n - 15)) AS i, unnest(list_transform(range(n - 15), lambda i: array_to_string(w[i + 1:i + 16], ' '))) AS gram FROM d WHERE n >= 24),
e AS (SELECT x.rid, x.i, y.i - x.i AS q FROM k x JOIN k y ON x.rid = y.rid AND x.gram = y.gram AND x.i < y.i),
j AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM e),
s AS (SELECT rid, q, min(i) AS start, max(i) - min(i) + 16 + q AS length FROM j GROUP BY rid, q, island),
r AS (SELECT rid, start, length, min(q) AS period FROM s WHERE length >= greatest(24, 3 * q) GROUP BY rid, start, length),
b AS (SELECT r.*, row_number() OVER (PARTITION BY r.rid ORDER BY length * f // period DESC, start, period) AS place FROM r, (SELECT CAST(1000000000000 AS HUGEINT) AS f)),
own AS (
  SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS text FROM (SELECT rid, unnest(range(n)) AS i, unnest(w) AS word FROM d WHERE rid IN (SELECT rid FROM r)) x
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.rid = x.rid AND gone.i = x.i) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(CASE WHEN n_runs > 0 THEN kept.text ELSE array_to_string(w, ' ') END, '')) AS collapsed_sha256
FROM d LEFT JOIN own USING (rid) LEFT JOIN kept USING (rid) LEFT JOIN b ON b.rid = d.rid AND place = 1"""

SQL: dict[str, str] = {"op5_line_dedup": OP5, "op7_decontamination": OP7, "op9_mixing": OP9, "op11_periodic_runs": OP11, "op12_divergence": OP12}
