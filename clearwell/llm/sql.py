"""SQL that gives the rows of an operator's query, for those that SQL can express: plain and quadratic."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MINHASH = f"""
WITH RECURSIVE
words AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS own
    FROM words),
shingles AS (SELECT doc_id, unnest(own) AS s FROM sets),
several AS (SELECT s, row_number() OVER () AS number FROM shingles GROUP BY s HAVING count(*) > 1),
numbered AS (SELECT doc_id, number FROM shingles JOIN several USING (s)),
half AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM numbered a JOIN numbered b ON a.number = b.number AND a.doc_id < b.doc_id GROUP BY ALL),
shared AS (SELECT a, b, n FROM half UNION ALL SELECT b, a, n FROM half),
links AS (
    SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * n >= 85 * (len(x.own) + len(y.own) - n)),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
classes AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, CAST(len(own) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN classes ON a = doc_id
"""

SUBSTRINGS = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS pos FROM bytes),
strings AS (SELECT doc_id, pos, h[2 * pos + 1:2 * pos + 100] AS s FROM starts),
repeats AS (
    SELECT doc_id, pos FROM strings JOIN (SELECT s, min(doc_id) AS first_doc FROM strings GROUP BY s) USING (s)
    WHERE doc_id > first_doc),
opened AS (SELECT *, pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 AS opens FROM repeats),
numbered AS (
    SELECT *, sum(CASE WHEN coalesce(opens, TRUE) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS span
    FROM opened),
spans AS (SELECT doc_id, span, min(pos) AS low, max(pos) + 50 AS high FROM numbered GROUP BY doc_id, span),
pieces AS (
    SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS low, low AS high FROM spans
    UNION ALL SELECT doc_id, max(high), 1000000000 FROM spans GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(h[2 * low + 1:2 * high], '' ORDER BY low) AS k
    FROM pieces JOIN bytes USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM bytes LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

EMBEDDINGS = """
WITH RECURSIVE
valid AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
normed AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM valid),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM normed a JOIN normed b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
classes AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN classes ON a = vec_id LEFT JOIN counted USING (vec_id)
"""

LINES = """
WITH RECURSIVE
split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
numbered AS (
    SELECT doc_id, unnest(range(0, len(lines))) AS line_no, lower(trim(unnest(lines), ' ')) AS line FROM split),
filled AS (SELECT * FROM numbered WHERE line <> ''),
wordy AS (SELECT DISTINCT line, string_split_regex(line, ' +') AS w FROM filled),
sets AS (
    SELECT line, list_distinct(list_concat(
        list_transform(range(1, len(w) + 1), lambda i: array_to_string(w[i:i + 7], ' ')[1:16]),
        flatten(list_transform(list_filter(w, lambda x: length(x) > 16),
            lambda x: list_transform(range(1, length(x) - 14), lambda i: x[i:i + 15]))))) AS own FROM wordy),
shingles AS (SELECT line, unnest(own) AS s FROM sets),
shared AS (
    SELECT a.line AS a, b.line AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.line <> b.line GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sets x ON x.line = a JOIN sets y ON y.line = b
    WHERE 100 * n >= 80 * (len(x.own) + len(y.own) - n)),
reached AS (
    SELECT line AS a, line AS b FROM sets
    UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
classes AS (SELECT a AS line, min(b) AS component FROM reached GROUP BY a),
ranked AS (
    SELECT doc_id, line_no, row_number() OVER (PARTITION BY component ORDER BY doc_id, line_no) AS nth
    FROM filled JOIN classes USING (line)),
removed AS (
    SELECT doc_id, count(*) AS n, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS numbers
    FROM ranked WHERE nth > 1 GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS INTEGER) AS n_lines, CAST(coalesce(n, 0) AS INTEGER) AS n_removed,
    coalesce(numbers, '') AS removed
FROM split LEFT JOIN removed USING (doc_id)
"""

RUNS = """
WITH hashed AS (
    SELECT doc_id, text, CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)),
            lambda b, k: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295) AS BIGINT) AS h
    FROM documents),
plain AS (
    SELECT doc_id, h, h // 10 AS g, list_filter(
        regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM hashed),
placed AS (
    SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n,
        CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % greatest(len(w), 1) ELSE len(w) END AS a, g FROM plain),
planted AS (
    SELECT doc_id, n, list_transform(range(n), lambda i:
        w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) AS w FROM placed),
words AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM planted),
equals AS (
    SELECT x.doc_id, y.i - x.i AS p, x.i AS i FROM words x
    JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM equals),
stretches AS (
    SELECT doc_id, p, min(i) AS s, count(*) + p AS l FROM islands GROUP BY doc_id, p, island
    HAVING count(*) + p >= greatest(6, 4 * p)),
runs AS (SELECT doc_id, s, l, min(p) AS p FROM stretches GROUP BY doc_id, s, l),
told AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || p || chr(10), '' ORDER BY s, p) AS listed,
        first(struct_pack(s := s, l := l, p := p) ORDER BY CAST(l AS DOUBLE) / p DESC, s, p) AS best
    FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + p, s + l)) AS i FROM runs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start,
    CAST(best.l AS BIGINT) AS length, CAST(best.p AS BIGINT) AS period,
    CAST(1000 * best.l // best.p AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
    sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
