"""SQL for the queries that SQL can express.

The other queries rest on hashes, learned models or iterations without an SQL form; tests
hold them against brute force.
"""

from __future__ import annotations

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len, array_to_string(list_slice(w, i, i + len - 1), ' ') AS t
  FROM (SELECT item_id, w, least(10, len(w)) AS len, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
),
lens AS (SELECT DISTINCT len FROM win),
occ AS (
  SELECT rid, s, len, array_to_string(list_slice(w, s, s + len - 1), ' ') AS t
  FROM (SELECT rid, w, lens.len, unnest(range(1, len(w) - lens.len + 2)) AS s FROM d JOIN lens ON len(d.w) >= lens.len)
),
hit AS (SELECT occ.rid, occ.s, occ.len, win.item_id FROM occ JOIN win ON occ.len = win.len AND occ.t = win.t),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + len)) AS p FROM (SELECT DISTINCT rid, s, len FROM hit)) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h, coalesce(html, '') AS payload FROM pages),
f AS (SELECT payload, min(page_id) AS first_id FROM p GROUP BY payload)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  TRUE AS digest_holds
FROM p JOIN f USING (payload)
"""


def _url_levels(order: int) -> str:
    """CTEs ``n1`` to ``p{order + 1}``: counts and chances of stretches of every length."""
    out = []
    for size in range(1, order + 2):
        lower = "1.0 / (SELECT count(*) FROM n1) AS la, 1.0 / (SELECT count(*) FROM n1) AS lr" if size == 1 else "b.pa AS la, b.pr AS lr"
        join = "" if size == 1 else f"JOIN p{size - 1} b ON b.gram = right(n.gram, {size - 1})"
        out.append(f"""
n{size} AS (SELECT right(gram, {size}) AS gram, sum(a) AS a, sum(r) AS r FROM g GROUP BY 1),
c{size} AS (SELECT left(gram, {size - 1}) AS context, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ta, count(*) FILTER (r > 0) AS tr FROM n{size} GROUP BY 1),
p{size} AS (
  SELECT gram, CASE WHEN na > 0 THEN (a + ta * la)::DOUBLE / (na + ta) ELSE la END AS pa, CASE WHEN nr > 0 THEN (r + tr * lr)::DOUBLE / (nr + tr) ELSE lr END AS pr
  FROM (SELECT n.gram, n.a::DOUBLE AS a, n.r::DOUBLE AS r, c.na::DOUBLE AS na, c.nr::DOUBLE AS nr, c.ta::DOUBLE AS ta, c.tr::DOUBLE AS tr, {lower}
        FROM n{size} n JOIN c{size} c ON c.context = left(n.gram, {size - 1}) {join})
),""")
    return "".join(out)


URLS = f"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
),
h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM u),
p AS (
  SELECT rid, page_id, coalesce(host, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(host || regexp_replace(rest, '^[^/?#]*', ''), url, '') AS body
  FROM h
),
f AS (
  SELECT *, left(md5(body), 1) < '4' AS held, CASE
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p
),
rows AS (SELECT *, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS action FROM f),
each AS (
  SELECT rid, action, held, substr(padded, i, 5) AS gram
  FROM (SELECT rid, action, held, padded, unnest(range(1, length(padded) - 3)) AS i
        FROM (SELECT rid, action, held, repeat(chr(2), 4) || body || chr(3) AS padded FROM rows WHERE body <> ''))
),
g AS (SELECT gram, count(*) FILTER (action = 'allow' AND NOT held) AS a, count(*) FILTER (action = 'block' AND NOT held) AS r FROM each GROUP BY 1),
{_url_levels(4)}
logs AS (SELECT gram, round((ln(pa) - ln(pr)) * 1048576)::BIGINT AS llr FROM p5),
ready AS (SELECT sum(a) > 0 AND sum(r) > 0 AS both_known FROM g),
sums AS (SELECT rid, floor(sum(llr)::DOUBLE / count(*))::BIGINT AS steps FROM each JOIN logs USING (gram), ready WHERE both_known GROUP BY rid),
scored AS (SELECT rows.*, steps, floor(steps / 4096.0)::BIGINT AS bin FROM rows LEFT JOIN sums USING (rid)),
known AS (SELECT bin, action FROM scored WHERE held AND action IS NOT NULL AND steps IS NOT NULL),
sizes AS (SELECT count(*) FILTER (action = 'allow') AS allowed, count(*) FILTER (action = 'block') AS blocked FROM known),
edges AS (SELECT bin AS e FROM known UNION SELECT bin + 1 FROM known UNION SELECT 0),
harm AS (
  SELECT e, count(*) FILTER (action = 'allow' AND bin < e) * any_value(blocked) + count(*) FILTER (action = 'block' AND bin >= e) * any_value(allowed) AS harm
  FROM edges, known, sizes WHERE allowed > 0 AND blocked > 0 GROUP BY e
),
edge AS (SELECT coalesce((SELECT e FROM harm ORDER BY harm, abs(e), e LIMIT 1), 0) AS edge)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN steps < edge * 4096 THEN 'block' ELSE 'allow' END) AS verdict, steps AS score_steps
FROM scored, edge
"""

ORACLES: dict[str, str] = {"op4_decontaminate": DECONTAMINATE, "op8_warc_chain": WARC, "op12_url_filter": URLS}
