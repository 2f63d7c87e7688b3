"""The queries that SQL can express, in DuckDB's SQL over the same tables.

Missing are those of order MinHash, of seeded block choice, of token counts, of page wrappers and of language profiles;
tests hold them against plain versions.
"""

WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP1 = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM items WHERE len(w) > 0)
),
docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
grams AS (
    SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS gram
    FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
    )
),
found AS (SELECT doc_id, item_id, s, g.n FROM grams g JOIN windows v ON g.n = v.n AND g.gram = v.gram),
hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN named m ON d.doc_id = m.doc_id
"""

OP2 = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE list_aggregate(embedding, 'count') = len(embedding) AND len(embedding) > 0
        AND isfinite(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))
        AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
),
reach AS (
    SELECT a AS node, b AS other FROM links
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least_of AS (SELECT node, min(other) AS least_id FROM reach GROUP BY node)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(least_id, e.vec_id)) AS component_id,
    e.vec_id = least(e.vec_id, coalesce(least_id, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counted c ON e.vec_id = c.a LEFT JOIN least_of l ON e.vec_id = l.node
"""

OP3 = """
WITH docs AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
pieces_of AS (
    SELECT doc_id, 256 * b AS base, substr(h, 512 * b + 1, 610) AS piece
    FROM (SELECT doc_id, h, unnest(range(0, CAST(len(h) // 512 AS BIGINT) + 1)) AS b FROM docs)
),
windows AS (
    SELECT doc_id, base + r AS s, substr(piece, 2 * r + 1, 100) AS w
    FROM (
        SELECT *, unnest(range(0, least(256, CAST(len(piece) // 2 AS BIGINT) - 49))) AS r
        FROM pieces_of WHERE len(piece) >= 100
    )
),
firsts AS (SELECT w, min(doc_id) AS least_id FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT x.doc_id, s FROM windows x JOIN firsts f ON x.w = f.w AND x.doc_id > f.least_id),
marked AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM gone),
runs AS (
    SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before + 50 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY s) AS run
    FROM marked
),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 50 AS b FROM runs GROUP BY doc_id, run),
pieces AS (
    SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS kept_from FROM spans
),
kept AS (
    SELECT p.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
        string_agg(substr(h, CAST(2 * kept_from + 1 AS BIGINT), CAST(2 * (a - kept_from) AS BIGINT)), '' ORDER BY a)
            || substr(any_value(h), CAST(2 * max(b) + 1 AS BIGINT)) AS k
    FROM pieces p JOIN docs d ON p.doc_id = d.doc_id GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(len(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM docs d LEFT JOIN kept t ON d.doc_id = t.doc_id
"""

OP8 = """
WITH parts AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
named AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
),
rules(verdict, rule, rule_host, rule_path) AS (
    VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
        ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
),
ranked AS (
    SELECT page_id, rule, verdict, row_number() OVER (
        PARTITION BY page_id ORDER BY len(rule_host) DESC, len(rule_path) DESC) AS place
    FROM named JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT n.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM named n LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON n.page_id = r.page_id
"""

OP9 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
marked AS (
    SELECT *, regexp_extract_all(
        role || chr(10) || text,
        '<\\*(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>)|\[\\*(INST\]|/INST\])') AS controls
    FROM turns
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(length(role) + length(text) + len(controls)
        + length('<|im_start|>') + length('<|im_sep|>') + length('<|im_end|>')) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

# DuckDB has no crc32: the checksum's register takes the bits of the decimal digits one by one.
def _crc32(digits: str) -> str:
    bits = f"list_prepend(4294967295, flatten(list_transform(string_split({digits}, ''), lambda d: [ascii(d) >> k & 1 for k in range(8)])))"
    return f"xor(list_reduce({bits}, lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"


# A run repeats its first six words one period later, so equal groups of six words find every period.
OP11 = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, {_crc32("CAST(doc_id AS VARCHAR)")} AS h,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
placed AS (
    SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
        3 + (h // 10) % 8 AS parts FROM texts
),
docs AS (
    SELECT rid, doc_id, CASE WHEN a IS NULL THEN w ELSE list_concat(w[1:a], list_transform(
        range(a, n), lambda i: w[CAST(1 + a + (i - a) % (1 + (n - a) // parts) AS BIGINT)])) END AS w
    FROM placed
),
grams AS (
    SELECT rid, x, array_to_string(w[x + 1:x + 6], ' ') AS g
    FROM (SELECT rid, w, unnest(range(0, len(w) - 5)) AS x FROM docs WHERE len(w) >= 6)
),
pairs AS (
    SELECT a.rid, a.x, b.x - a.x AS p FROM grams a JOIN grams b ON a.rid = b.rid AND a.g = b.g AND a.x < b.x
),
stretches AS (
    SELECT rid, p, min(x) AS start, max(x) + 6 + p - min(x) AS length
    FROM (SELECT *, x - row_number() OVER (PARTITION BY rid, p ORDER BY x) AS island FROM pairs) GROUP BY rid, p, island
),
runs AS (
    SELECT rid, start, length, min(p) AS period FROM stretches WHERE length >= greatest(12, 2 * p) GROUP BY rid, start, length
),
listed AS (
    SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
    FROM runs GROUP BY rid
),
longest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY length DESC, start, period) AS place FROM runs)
    WHERE place = 1
),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS x FROM runs),
words AS (
    SELECT rid, x, w[x + 1] AS word FROM (SELECT rid, w, unnest(range(0, len(w))) AS x FROM docs WHERE rid IN (SELECT rid FROM runs))
),
kept AS (
    SELECT v.rid, string_agg(word, ' ' ORDER BY v.x) AS t
    FROM words v LEFT JOIN gone g ON v.rid = g.rid AND v.x = g.x WHERE g.x IS NULL GROUP BY v.rid
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, m.start, m.length, m.period, 1000 * m.length // m.period AS exponent_milli,
    sha256(coalesce(l.t, '')) AS runs_sha256, sha256(coalesce(k.t, array_to_string(w, ' '))) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON d.rid = l.rid LEFT JOIN longest m ON d.rid = m.rid LEFT JOIN kept k ON d.rid = k.rid
"""

OP12 = """
WITH vectors AS (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
),
scored AS (
    SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS other, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

OP13 = f"""
WITH given AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
numbered AS (
    SELECT c, g, b, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, g) AS d
    FROM (SELECT *, substr(sha256(length(role) || chr(10) || role || text), 1, 32) AS g, strlen(text) AS b FROM given)
),
convs AS (SELECT c, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT c FROM given)),
rebuilt AS (
    SELECT v.c, d, g, b FROM convs v JOIN numbered n ON n.c = v.c - v.c % 5 AND d <= h
    UNION ALL SELECT v.c, d, g, b FROM convs v JOIN numbered n ON n.c = v.c AND d > h
),
turns AS (SELECT c, g, b, row_number() OVER (PARTITION BY c ORDER BY d) AS d FROM rebuilt),
prefixes AS (
    SELECT c, d, b, string_agg(g, '') OVER (PARTITION BY c ORDER BY d) AS x FROM turns
    UNION ALL SELECT c, 0, 0, '' FROM convs
),
nodes AS (SELECT x, d, min(c) AS conv_id, count(*) AS n, any_value(b) AS b FROM prefixes GROUP BY x, d),
children AS (SELECT left(x, len(x) - 32) AS x, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
    SELECT left(x, 32 * a) AS x, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (
        SELECT v.x, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n - 1) * b AS saved, unnest(range(0, d + 1)) AS a
        FROM nodes v LEFT JOIN children k ON v.x = k.x
    ) GROUP BY 1
),
ends AS (
    SELECT x, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha
    FROM (SELECT *, max(d) OVER (PARTITION BY c) AS last FROM prefixes) WHERE d = last GROUP BY x
)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(n_children, 0) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM nodes v LEFT JOIN nodes p ON v.d > 0 AND p.x = left(v.x, len(v.x) - 32) AND p.d = v.d - 1
LEFT JOIN children k ON v.x = k.x LEFT JOIN below b ON v.x = b.x LEFT JOIN ends e ON v.x = e.x
"""

ORACLE_SQL = {
    "op1_decontamination": OP1,
    "op2_embedding_dedup": OP2,
    "op3_suffix_dedup": OP3,
    "op8_url_filter": OP8,
    "op9_chat_format": OP9,
    "op11_periodic_runs": OP11,
    "op12_exact_topk": OP12,
    "op13_prefix_trie": OP13,
}
