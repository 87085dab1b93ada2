"""DuckDB SQL of the queries that SQL can express; written from the definitions, not from the Spark plans."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP1 = f"""
WITH rules(h, p, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (SELECT row_number() OVER () AS rid, page_id,
               CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
host AS (SELECT rid, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h0 FROM cut),
u AS (SELECT rid, page_id, translate(h0, '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM host),
fit AS (SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
        FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(action, 'allow') AS verdict
FROM u LEFT JOIN fit USING (rid)
"""

_OP2 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
all_lines AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS idx FROM d),
solid AS (SELECT *, len(regexp_extract_all(line, '\S+')) AS words,
                 row_number() OVER (PARTITION BY rid ORDER BY idx) AS seq
          FROM all_lines WHERE regexp_matches(line, '\S')),
cum AS (SELECT *, sum(words) OVER (PARTITION BY rid ORDER BY seq) AS upto,
               sum(words) OVER (PARTITION BY rid) AS total FROM solid),
runs AS (
  SELECT rid, doc_id, seq, list(line) OVER (PARTITION BY rid ORDER BY upto - words
    RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING) AS content, total - upto + words >= 50 AS ok FROM cum
  UNION
  SELECT rid, doc_id, seq - count(*) OVER w + 1, list(line) OVER w, upto >= 50 FROM cum
  WINDOW w AS (PARTITION BY rid ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
ranked AS (SELECT rid, seq, len(content) AS m, row_number() OVER (
             PARTITION BY content ORDER BY doc_id NULLS LAST, rid, seq) AS nth FROM runs WHERE ok),
gone AS (SELECT DISTINCT rid, unnest(range(seq, seq + m)) AS seq FROM ranked WHERE nth > 1),
flagged AS (SELECT c.rid, c.idx, c.seq, g.seq IS NOT NULL AS cut FROM cum c LEFT JOIN gone g ON c.rid = g.rid AND c.seq = g.seq),
marks AS (SELECT a.rid, a.idx, a.line, f.seq, f.cut,
                 last_value(f.cut IGNORE NULLS) OVER (PARTITION BY a.rid ORDER BY a.idx) AS prev_cut,
                 first_value(f.cut IGNORE NULLS) OVER (PARTITION BY a.rid ORDER BY a.idx
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_cut
          FROM all_lines a LEFT JOIN flagged f ON a.rid = f.rid AND a.idx = f.idx),
built AS (SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY idx)
                   FILTER (WHERE NOT coalesce(prev_cut AND next_cut, FALSE)), '') AS text,
                 count(seq) AS n_lines, count(*) FILTER (WHERE cut) AS n_removed FROM marks GROUP BY rid)
SELECT d.doc_id, CASE WHEN coalesce(b.n_removed, 0) = 0 THEN d.text ELSE b.text END AS text,
       CAST(coalesce(b.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(b.n_removed, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN built b ON d.rid = b.rid
"""

_OP10 = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS sid
      FROM d GROUP BY source),
w AS (SELECT *, CASE sid % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most FROM s),
-- at a trial level, the sources below it stop at their limit; the right level makes the sum come out
trial AS (SELECT w1.sid AS this, (sum(w2.source_size) - coalesce(sum(w2.most) FILTER (WHERE (w2.most / w2.weight, w2.sid) < (w1.most / w1.weight, w1.sid)), 0))
                 / CAST(sum(w2.weight) FILTER (WHERE (w2.most / w2.weight, w2.sid) >= (w1.most / w1.weight, w1.sid)) AS DOUBLE) AS level,
                 any_value(w1.most) AS most, any_value(w1.weight) AS weight FROM w w1, w w2 GROUP BY w1.sid),
lev AS (SELECT arg_min(level, (most / weight, this)) AS level FROM trial WHERE level * weight <= most),
t AS (SELECT w.*, least(level * weight, CAST(most AS DOUBLE)) AS target FROM w, lev),
p AS (SELECT *, least(CAST(round(target) AS BIGINT), most) AS planned FROM t),
o AS (SELECT d.*, p.source_size, p.target, p.planned,
             sum(d.size) OVER (PARTITION BY p.sid ORDER BY o, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE (planned // source_size) * size
       + greatest(0, least(size, planned % source_size - start)) END AS BIGINT) AS taken FROM o
"""

_WORDS = (f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce({_WORDS}, []) AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item, 13 AS n, list_slice(ws, i, i + 12) AS content FROM (SELECT item, ws, unnest(range(1, len(ws) - 11)) AS i FROM b WHERE len(ws) >= 13)
  UNION SELECT item, len(ws), ws FROM b WHERE len(ws) BETWEEN 1 AND 12),
spots AS (SELECT rid, n, i, list_slice(ws, i, i + n - 1) AS content FROM (
            SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)),
found AS (SELECT rid, i, n, item FROM spots JOIN windows USING (n, content)),
hit AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS k FROM found) GROUP BY rid),
own AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN own USING (rid)
"""

_OP6 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
runs AS (SELECT rid, array_to_string(list_slice(ws, i, i + least(5, len(ws)) - 1), ' ') AS s
         FROM (SELECT rid, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)),
bags AS (SELECT rid, s, count(*) AS n FROM runs GROUP BY rid, s),
sizes AS (SELECT rid, sum(n) AS total FROM bags GROUP BY rid),
common AS (SELECT a.rid AS x, b.rid AS y, sum(least(a.n, b.n)) AS m FROM bags a JOIN bags b ON a.s = b.s AND a.rid <> b.rid GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes p ON p.rid = x JOIN sizes q ON q.rid = y WHERE 10 * m >= 8 * (p.total + q.total - m)),
reach(rid, other) AS (SELECT rid, rid FROM d UNION SELECT r.rid, l.y FROM reach r JOIN links l ON l.x = r.other),
label AS (SELECT rid, min(other) AS class FROM reach GROUP BY rid),
classes AS (SELECT class, min(doc_id) AS class_id, count(*) AS class_size FROM label JOIN d USING (rid) GROUP BY class)
SELECT doc_id, class_id, class_size, CAST(coalesce(total, 0) AS BIGINT) AS n_shingles
FROM d JOIN label USING (rid) JOIN classes USING (class) LEFT JOIN sizes USING (rid)
"""

_OP9 = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid, a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5
"""

# crc32 written out: a list of start value and bytes is reduced, eight shifts a byte
_CRC = ("xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), "
        "lambda crc, byte: list_reduce([xor(crc, byte)] || CAST(range(8) AS BIGINT[]), "
        "lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)")

_OP13 = f"""
WITH t AS (SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tok,
                  length(coalesce(text, '')) AS len, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(tok ORDER BY turn NULLS FIRST, tok) AS toks, list(len ORDER BY turn NULLS FIRST, tok) AS lens FROM t GROUP BY conv_id),
h AS (SELECT *, {_CRC.format("conv_id")} % 6 AS h FROM o),
c AS (SELECT h.conv_id, coalesce(list_slice(b.toks, 1, h.h), []) || list_slice(h.toks, h.h + 1, len(h.toks)) AS toks,
             coalesce(list_slice(b.lens, 1, h.h), []) || list_slice(h.lens, h.h + 1, len(h.lens)) AS lens
      FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
m AS (SELECT conv_id, array_to_string(toks, '') AS path, len(toks) AS size, lens, unnest(range(0, len(toks) + 1)) AS d FROM c),
n AS (SELECT d, substr(path, 1, 64 * d) AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(any_value(CASE WHEN d > 0 THEN lens[d] END), 0) AS len,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = size), '')) AS ends_sha256
      FROM m GROUP BY ALL),
kids AS (SELECT d - 1 AS d, substr(node, 1, 64 * (d - 1)) AS node, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
u AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM n LEFT JOIN kids k USING (d, node)),
up AS (SELECT substr(node, 1, 64 * a) AS node, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves,
              CAST(sum((n_convs - 1) * len) AS BIGINT) AS saved_tokens
       FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM u) GROUP BY a, substr(node, 1, 64 * a))
SELECT u.conv_id, u.d AS depth, p.conv_id AS parent_conv_id, u.n_convs, u.n_children, up.n_leaves, up.saved_tokens, u.ends_sha256
FROM u JOIN up USING (node) LEFT JOIN n p ON u.d > 0 AND p.node = substr(u.node, 1, 64 * (u.d - 1))
"""

SQL = {"op13_conversation_trie": _OP13, "op3_decontaminate": _OP3, "op6_near_dedup": _OP6, "op9_topk": _OP9, "op1_url_filter": _OP1, "op2_line_dedup": _OP2, "op10_mixing": _OP10}
