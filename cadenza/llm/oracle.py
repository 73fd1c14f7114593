"""DuckDB SQL for the queries that SQL can express."""

from cadenza.llm.licenses import TEMPLATES

SQL = {}

_TEMPLATE_ROWS = ", ".join("({}, '{}', '{}')".format(k, n, t.replace("'", "''"))
                           for k, (n, t) in enumerate(TEMPLATES))

SQL["op1_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, rid, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, rid, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE r.k IS NOT NULL AND doc_id <> last_doc) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
              FILTER (WHERE r.k IS NULL OR doc_id = last_doc), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated r USING (k)
GROUP BY doc_id, rid
"""

SQL["op4_benchmark_decontamination"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), starts AS (
  SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS s
  FROM doc_words, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m
), found AS (
  SELECT rid, s, m, item_id FROM (SELECT rid, s, m, array_to_string(w[s:s + m - 1], ' ') AS p FROM starts)
  JOIN windows USING (m, p)
), hits AS (
  SELECT rid, count(DISTINCT place) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + m)) AS place FROM (SELECT DISTINCT rid, s, m FROM found)) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

SQL["op6_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT rid, doc_id, unnest(CASE WHEN len(w) >= 3
         THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM words
), sizes AS (
  SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM grams GROUP BY rid
), shared AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.rid < b.rid GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
  SELECT rid, rid FROM sizes
  UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b
), named AS (
  SELECT a AS rid, min(doc_id) AS c FROM reach JOIN sizes ON sizes.rid = b GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id,
       coalesce(c, doc_id) = doc_id AS kept
FROM words LEFT JOIN (SELECT rid, n FROM sizes) USING (rid) LEFT JOIN named USING (rid)
"""

def _attribute(name: str) -> str:
    """The value of a tag's attribute: in double or single quotes, or bare."""
    return "trim(" + " || ".join(
        rf"""regexp_extract(tag, '(?is)[\s"'']{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', {k})"""
        for k in (1, 2, 3)) + ")"


SQL["op9_url_filter"] = r"""
WITH RECURSIVE rules(h, p, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), parts AS (
  SELECT page_id, url, html, row_number() OVER () AS rid,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parsed AS (
  SELECT *, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail
  FROM parts
), nodes AS (
  SELECT *, CASE WHEN rest IS NOT NULL THEN host || tail END AS node FROM parsed
), won AS (
  SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(says, length(h || p)) AS says
  FROM nodes JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid
), tags AS (
  SELECT node, host, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b(?:"[^"]*"|''[^'']*''|[^>"''])*>')) AS tag
  FROM nodes WHERE rest IS NOT NULL
), named AS (
  SELECT node, host, path, unnest([
      CASE WHEN list_contains(string_split_regex(lower(attr(tag, 'rel')), '\s+'), 'canonical') THEN attr(tag, 'href') END,
      CASE WHEN regexp_matches(tag, '(?i)http-equiv\s*=\s*["'']?\s*refresh')
           THEN regexp_extract(attr(tag, 'content'), '(?is)\burl\s*=\s*(.*)$', 1) END]) AS raw FROM tags
), links AS (
  SELECT node, host, path, regexp_replace(trim(trim(replace(list_reduce(list_prepend(
      replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', chr(39)),
      list_distinct(regexp_extract_all(raw, '&#(?:[0-9]{1,6}|[xX][0-9a-fA-F]{1,5});'))), lambda acc, r: replace(acc, r,
        CASE WHEN lower(r) IN ('&#38;', '&#x26;') THEN '&amp;' WHEN lower(r[3]) = 'x' THEN chr(CAST('0x' || r[4:-2] AS INTEGER))
             ELSE chr(CAST(r[3:-2] AS INTEGER)) END)), '&amp;', '&')), chr(34) || chr(39)), '(?s)#.*$', '') AS link
  FROM named WHERE raw <> ''
), goals AS (
  SELECT node, host, path, link, regexp_extract(link, '(?s)^[^?]*') AS own, regexp_extract(link, '(?s)\?.*$') AS query,
         regexp_replace(path, '[^/]*$', '') AS folder FROM links
), pathed AS (
  SELECT node, host, path, link, query, string_split(CASE WHEN starts_with(own, '/') THEN own ELSE
           CASE WHEN starts_with(folder, '/') THEN '' ELSE '/' END || folder || own END, '/') AS parts FROM goals
), cleared AS (
  SELECT node, host, path, link, query, array_to_string(list_reduce(list_transform(
      CASE WHEN parts[-1] IN ('.', '..') THEN list_append(parts, '') ELSE parts END, lambda x: [x]), lambda acc, x:
      CASE x[1] WHEN '.' THEN acc WHEN '..' THEN CASE WHEN len(acc) > 1 THEN acc[:-2] ELSE acc END ELSE list_concat(acc, x) END), '/') AS clear
  FROM pathed
), absolute AS (
  SELECT node, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN substr(link, instr(link, '://') + 3)
         WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with(link, '//') THEN substr(link, 3)
         WHEN link = '' THEN node WHEN starts_with(link, '?') THEN host || path || link ELSE host || clear || query END AS rest
  FROM cleared
), edges AS (
  SELECT node AS a, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS b
  FROM absolute WHERE rest IS NOT NULL
), both_ways AS (
  SELECT a, b FROM edges UNION SELECT b, a FROM edges
), blocked(node) AS (
  SELECT node FROM nodes JOIN won USING (rid) WHERE says = 'block'
  UNION
  SELECT e.b FROM blocked JOIN both_ways e ON e.a = blocked.node
)
SELECT page_id, host, path, rule,
       coalesce(says, CASE WHEN node IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM nodes LEFT JOIN won USING (rid)
""".replace("attr(tag, 'rel')", _attribute("rel")).replace("attr(tag, 'href')", _attribute("href")).replace(
    "attr(tag, 'content')", _attribute("content"))

SQL["op2_license_scan"] = rf"""
WITH templates(k, license, t) AS (
  VALUES {_TEMPLATE_ROWS}
), template_words AS (
  SELECT k, license, w, count(*) AS tf FROM (
    SELECT k, license, unnest(regexp_extract_all(lower(t), '[a-z0-9]+')) AS w FROM templates) GROUP BY ALL
), idf AS (
  SELECT w, ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*))) + 1 AS idf FROM template_words GROUP BY w
), template_vectors AS (
  SELECT k, license, w, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY k)) AS share
  FROM template_words JOIN idf USING (w)
), files AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls,
         concat_ws('/', coalesce(source, 'unknown'), coalesce(lang, 'und'), CAST(doc_id % 97 AS VARCHAR)) AS dir
  FROM documents
), named AS (
  SELECT *, len(ls) <= 2 AND regexp_matches(ls[-1], '(?i)licen[sc]') AS is_file FROM files
), units AS (
  -- a licence file counts as a whole, by paragraph and by line
  SELECT DISTINCT rid, unnest(CASE WHEN is_file THEN list_concat([text], list_concat(
    string_split_regex(text, '\n[ \t\n\x0B\f\r]*\n'), ls)) ELSE ls END) AS unit FROM named
), unit_words AS (
  SELECT unit, w, count(*) AS tf FROM (
    SELECT unit, unnest(regexp_extract_all(lower(unit), '[a-z0-9]+')) AS w FROM (SELECT DISTINCT unit FROM units))
  GROUP BY ALL
), weights AS (
  SELECT unit, w, tf * coalesce(idf, ln(1 + (SELECT count(*) FROM templates)) + 1) AS x FROM unit_words LEFT JOIN idf USING (w)
), norms AS (
  SELECT unit, sqrt(sum(x * x)) AS norm FROM weights GROUP BY unit
), scored AS (
  SELECT unit, license, round(dot / norm, 6) AS cosine FROM (
    SELECT unit, k, license, sum(x * share) AS dot FROM weights JOIN template_vectors USING (w) GROUP BY ALL)
  JOIN norms USING (unit) WHERE round(dot / norm, 6) >= 0.6
), own AS (
  SELECT rid, cosine, license FROM units JOIN scored USING (unit)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY cosine DESC, license) = 1
), licensed AS (
  SELECT dir, license, cosine FROM named JOIN own USING (rid) WHERE is_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, license) = 1
)
SELECT doc_id, dir || '/' || CASE WHEN is_file THEN 'LICENSE' ELSE doc_id || '.txt' END AS path,
       coalesce(own.license, licensed.license) AS license, coalesce(own.cosine, licensed.cosine) AS cosine,
       CASE WHEN own.license IS NOT NULL THEN CASE WHEN is_file THEN 'file' ELSE 'header' END
            WHEN licensed.license IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN own.license IS NULL AND licensed.license IS NOT NULL THEN dir END AS from_dir
FROM named LEFT JOIN own USING (rid) LEFT JOIN licensed USING (dir)
"""

SQL["op13_fill_in_middle"] = r"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), numbers AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM tokens
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
  FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

# crc32 bit by bit: DuckDB has no function for it
SQL["op11_prefix_trie"] = r"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
                                      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM ordered)
), rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY late, k) AS d, r, t FROM (
    SELECT own.conv_id, 0 AS late, k, r, t FROM own JOIN ordered b ON b.conv_id = own.conv_id - own.conv_id % 100 WHERE k <= h
    UNION ALL
    SELECT conv_id, 1, k, r, t FROM own JOIN ordered USING (conv_id) WHERE k > h)
), paths AS (
  SELECT conv_id, d, length(t) AS chars,
         string_agg(md5(length(r) || ':' || r || t), '') OVER (PARTITION BY conv_id ORDER BY d) AS p FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM own
), nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM paths GROUP BY d, p
), ends AS (
  SELECT p, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM paths JOIN (SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id) USING (conv_id, d) GROUP BY p
), children AS (
  SELECT a.p, count(*) AS n_children FROM nodes a JOIN nodes b ON b.d = a.d + 1 AND starts_with(b.p, a.p) GROUP BY a.p
), subtrees AS (
  SELECT a.p, count(*) FILTER (WHERE c.p IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.chars) AS saved_tokens
  FROM nodes a JOIN nodes b ON b.d >= a.d AND starts_with(b.p, a.p) LEFT JOIN children c ON c.p = b.p GROUP BY a.p
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN subtrees USING (p) LEFT JOIN children USING (p) LEFT JOIN ends USING (p)
LEFT JOIN nodes up ON up.d = n.d - 1 AND starts_with(n.p, up.p)
"""
