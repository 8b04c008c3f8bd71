"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

_WORDS = r"CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)"

OP1 = f"""
WITH docs AS (
    SELECT doc_id, source, {_WORDS} AS size, md5('mix-' || CAST(doc_id AS VARCHAR)) AS place FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
    SELECT source, source_size, 2.0::DOUBLE * source_size AS most,
        [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sizes
), levelled AS (
    SELECT *, most / weight AS ratio,
        (1.5::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), targets AS (
    SELECT l.source, source_size, least(most, coalesce(f.level * weight, most)) AS target
    FROM levelled l LEFT JOIN (
        SELECT arg_min(level, ratio) AS level FROM levelled WHERE most >= level * weight
    ) f ON true
), placed AS (
    SELECT doc_id, size, source_size, target,
        sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    CAST(greatest(0, least(size, floor(target) - before))
        + greatest(0, least(size, floor(target) - before - source_size)) AS BIGINT) AS taken
FROM placed
"""

OP4 = """
WITH rows AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), bytes AS (
    SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM rows
), kept AS (
    SELECT hex, max(page_id) AS keeper FROM bytes GROUP BY hex
), digits AS (
    -- Base32 takes the 160 bits five at a time, which is five hex digits for four letters.
    SELECT page_id, n, hex, keeper, list_transform(range(0, 40, 5), lambda i: CAST(concat('0x', substr(hex, CAST(i + 1 AS INT), 5)) AS INT)) AS fives
    FROM bytes JOIN kept USING (hex)
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(fives, lambda x:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x // 32768 % 32 + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x // 1024 % 32 + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x // 32 % 32 + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x % 32 + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM digits
"""

_LINE_WORDS = r"len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))"

OP6 = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents WHERE text IS NOT NULL
), counted AS (
    SELECT doc_id, line, pos, CAST({_LINE_WORDS} AS BIGINT) AS words FROM lines
), placed AS (
    SELECT *, CAST(sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS until FROM counted WHERE words > 0
), windows AS (
    SELECT doc_id, min(pos) OVER f AS s, max(pos) OVER f AS e, list(line) OVER f AS body, sum(words) OVER f AS words
    FROM (SELECT *, until - words AS since FROM placed)
    WINDOW f AS (PARTITION BY doc_id ORDER BY since RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
    UNION ALL
    SELECT doc_id, min(pos) OVER b AS s, max(pos) OVER b AS e, list(line) OVER b AS body, sum(words) OVER b AS words
    FROM placed
    WINDOW b AS (PARTITION BY doc_id ORDER BY until RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), spans AS (
    SELECT doc_id, s, e, md5(array_to_string(body, chr(10))) AS content FROM windows WHERE words >= 50
), firsts AS (
    SELECT content, min((doc_id, s, e)) AS first FROM spans GROUP BY content HAVING count(*) > 1
), later AS (
    SELECT DISTINCT doc_id, s, e FROM spans JOIN firsts USING (content) WHERE doc_id <> first[1] OR s > first[3]
), gone AS (
    SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN later r ON l.doc_id = r.doc_id AND l.pos BETWEEN r.s AND r.e
), rest AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL) AS text,
        CAST(count(g.pos) AS BIGINT) AS removed_lines
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(r.text, '') END AS text, coalesce(removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN rest r USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE parts AS (
    SELECT page_id, url, html,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), rules(verdict, rule, name, start) AS (
    VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
        ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
), links AS (
    SELECT url AS a, link FROM (
        SELECT url, unnest([
            regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
            regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)
        ]) AS link FROM parts
    ) WHERE link LIKE '%://%'
), nodes AS (
    SELECT regexp_replace(a, '#.*$', '') AS a, regexp_replace(link, '#.*$', '') AS b FROM links
), reached(a, b) AS (
    SELECT a, b FROM nodes UNION SELECT b, a FROM nodes
    UNION SELECT r.a, n.b FROM reached r JOIN (SELECT a, b FROM nodes UNION SELECT b, a FROM nodes) n ON r.b = n.a
), ruled AS (
    SELECT DISTINCT b, arg_max(verdict, length(rule)) AS verdict FROM (
        SELECT DISTINCT b, regexp_extract(b, '(?s)^.*?://([^/?#]*)', 1) AS host, regexp_extract(b, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM reached
    ) x JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY b
), aliases AS (
    SELECT a, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict FROM reached JOIN ruled USING (b) GROUP BY a
), own AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM parts JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(o.verdict, l.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN own o USING (page_id) LEFT JOIN aliases l ON l.a = regexp_replace(p.url, '#.*$', '')
"""

OP12 = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS one, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS two,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
            WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM docs
), parts AS (
    SELECT *, array_to_string(units[1:least(one, two)], '') AS prefix,
        array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
        array_to_string(units[greatest(one, two) + 1:n], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

OP13 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
    SELECT r, words, unnest(range(1, len(words) - 33)) AS s FROM docs
), windows AS (
    SELECT r, s, md5(array_to_string(words[s:s + 34], ' ')) AS mark FROM starts
), gone AS (
    SELECT DISTINCT r, s + unnest(range(0, 35)) AS place
    FROM windows WHERE mark IN (SELECT mark FROM windows GROUP BY mark HAVING count(*) > 1)
), words AS (
    SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, place) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_source_mixing": OP1,
    "op4_warc_in_zip": OP4,
    "op6_line_dedup": OP6,
    "op10_url_filter": OP10,
    "op12_fill_in_middle": OP12,
    "op13_substring_dedup": OP13,
}
