"""The queries that SQL can express, as DuckDB SQL over the given tables."""

from __future__ import annotations

from textwrap import dedent

_WORD = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Every node reaches itself and what its links reach.
_REACH = """
    reach AS (
        SELECT id AS a, id AS b FROM nodes
        UNION
        SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

TOPK = """
    WITH v AS (
        SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 20 = 0)
    SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
    FROM s
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER w <= 20"""

JACCARD = f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORD}) AS w
        FROM documents),
    sets AS (
        SELECT doc_id,
               CASE WHEN len(w) = 0 THEN []
                    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
        FROM d),
    items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
    pairs AS (
        SELECT p.doc_id AS a, q.doc_id AS b, p.n AS na, q.n AS nb, count(*) AS shared
        FROM items AS p JOIN items AS q ON p.x = q.x AND p.doc_id < q.doc_id
        GROUP BY ALL),
    close AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (na + nb - shared)),
    links AS (SELECT a, b FROM close UNION ALL SELECT b, a FROM close),
    nodes AS (SELECT doc_id AS id FROM sets),{_REACH}
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
    FROM sets JOIN least ON doc_id = id"""

URLS = f"""
    WITH rules(verdict, rule) AS (
        VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
               ('allow', 'com/fr/'), ('block', 'com/de/')),
    rests AS (SELECT page_id, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS rest FROM pages),
    parts AS (
        SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rests),
    fits AS (
        SELECT page_id, arg_max(rule, len(rule)) AS rule, arg_max(verdict, len(rule)) AS verdict
        FROM parts JOIN rules
          ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
         AND starts_with(path, substr(rule, strpos(rule, '/')))
        GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts LEFT JOIN fits USING (page_id)"""

SUBSTRINGS = f"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
    starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
    windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM starts),
    first AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i
        FROM windows JOIN first USING (k) WHERE doc_id > first),
    each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
    kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
        FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)"""

SUFFIXES = """
    WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    starts AS (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM d WHERE n >= 200),
    windows AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS k FROM starts),
    twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
    found AS (SELECT doc_id, i FROM windows SEMI JOIN twice USING (k)),
    cut AS (
        SELECT doc_id, i, CAST(coalesce(i - lag(i) OVER w > 200, TRUE) AS INTEGER) AS new
        FROM found WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM cut),
    runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, run),
    edges AS (
        SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before, run FROM runs),
    gone AS (
        SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
               string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
        FROM edges JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
           sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN gone USING (doc_id)"""

SUBSPACE = f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
          AND len([x FOR x IN embedding IF x <> 0]) > 0),
    links AS (
        SELECT p.vec_id AS a, q.vec_id AS b
        FROM v AS p JOIN v AS q ON p.label = q.label AND p.vec_id <> q.vec_id
        WHERE list_cosine_similarity(p.v, q.v) >= 0.98),
    nodes AS (SELECT vec_id AS id FROM embeddings),{_REACH},
    counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
    SELECT id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, id = component_id AS kept
    FROM least LEFT JOIN counts USING (id)"""

LINES = f"""
    WITH l AS (
        SELECT doc_id, line, i, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k
        FROM (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
    common AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (common.k IS NOT NULL) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.k IS NULL), '')) AS kept_sha256
    FROM l LEFT JOIN common USING (k) GROUP BY doc_id"""

AUDIT = f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x,
               regexp_extract_all(coalesce(text, ''), {_WORD}) AS w
        FROM documents),
    good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
    toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
    failed AS (
        SELECT part,
               list_filter([CASE WHEN len(w) < 100 THEN 'A' END,
                            CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
                            CASE WHEN 100 * len(regexp_extract_all(x, '[A-Z]')) > 10 * len(x) THEN 'C' END,
                            CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' END,
                            CASE WHEN min(doc_id) OVER (PARTITION BY x) < doc_id THEN 'E' END], lambda f: f IS NOT NULL) AS f,
               CAST(doc_id IN (FROM good) AS INTEGER) AS good, CAST(doc_id IN (FROM toxic) AS INTEGER) AS toxic
        FROM d),
    cells AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
    letters(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
    orders(o) AS (
        SELECT '' UNION ALL
        SELECT o || c FROM orders JOIN letters ON strpos(o, c) = 0 WHERE len(o) < 5),
    steps AS (
        SELECT o, i AS step, o[i] AS c, string_split(o[1:i - 1], '') AS before
        FROM (SELECT o, unnest(range(1, 6)) AS i FROM orders WHERE len(o) = 5)),
    effects AS (
        SELECT part, o AS filter_order, step, c,
               coalesce(sum(n) FILTER (NOT list_contains(f, c) AND NOT list_has_any(f, before)), 0) AS kept,
               coalesce(sum(n) FILTER (list_contains(f, c) AND NOT list_has_any(f, before)), 0) AS removed,
               coalesce(sum(n) FILTER (list_contains(f, c) AND list_has_any(f, before)), 0) AS redundant,
               coalesce(sum(n) FILTER (f = [c]), 0) AS unique_fails,
               coalesce(sum(good) FILTER (list_contains(f, c) AND NOT list_has_any(f, before)), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (list_contains(f, c) AND NOT list_has_any(f, before)), 0) AS toxic_lost
        FROM cells CROSS JOIN steps GROUP BY ALL)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
    FROM effects"""

# Entry 0 to 63 of each part, after each of two rounds.
CODES = """
    WITH v AS (
        SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    parts AS (
        SELECT vec_id, label, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS x
        FROM v, range(16) AS r(p)),
    book0 AS (
        SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e
        FROM parts QUALIFY e < 64),{rounds}
    codes AS (
        SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM at2 GROUP BY ALL),
    flat AS (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM book2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, j)) FROM flat) AS codebooks_sha256
    FROM codes"""

_AT = """
    at{i} AS (
        SELECT vec_id, label, p, any_value(x) AS x, arg_min(e, 64 * d + e) AS e, min(d) AS d
        FROM (SELECT a.vec_id, a.label, a.p, a.x, b.e,
                     list_sum([(a.x[j] - b.x[j]) * (a.x[j] - b.x[j]) FOR j IN range(1, len(a.x) + 1)]) AS d
              FROM parts AS a JOIN book{i} AS b USING (p))
        GROUP BY ALL)"""

_BOOK = """
    sums{i} AS (
        SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x
        FROM (SELECT p, e, j, sum(y) AS s, count(*) AS n
              FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM at{before}) GROUP BY ALL)
        GROUP BY ALL),
    book{i} AS (
        SELECT p, e, coalesce(sums{i}.x, book{before}.x) AS x
        FROM book{before} LEFT JOIN sums{i} USING (p, e))"""

CODES = CODES.replace("{rounds}", ",".join([_AT.format(i=0), _BOOK.format(i=1, before=0), _AT.format(i=1), _BOOK.format(i=2, before=1), _AT.format(i=2)]) + ",")

SQL: dict[str, str] = {
    name: dedent(text)
    for name, text in {
        "op1_topk": TOPK,
        "op2_jaccard": JACCARD,
        "op4_url_rules": URLS,
        "op6_substrings": SUBSTRINGS,
        "op8_suffixes": SUFFIXES,
        "op9_subspace": SUBSPACE,
        "op11_line_runs": LINES,
        "op12_filter_audit": AUDIT,
        "op13_dual_tree": CODES,
    }.items()
}
