"""SQL for the queries of this subpackage that it can express over whole tables, for DuckDB."""

from __future__ import annotations

SPACE = "'[\\x20\\x09-\\x0D]+'"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), {SPACE}), lambda x: x <> '')"


#: A window is the text of 13 words; it goes from every document but the one with the least id.
SUBSTRING = f"""WITH w AS (SELECT doc_id, {_words('text')} AS ws FROM documents),
k AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS key FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
m AS (SELECT key, min(doc_id) AS d FROM k GROUP BY key),
gone AS (SELECT DISTINCT k.doc_id, k.i + j AS pos FROM k JOIN m USING (key), range(0, 13) AS t(j) WHERE m.d < k.doc_id),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS pos FROM w),
left_ AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.pos) AS kept, count(*) AS n FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.pos = gone.pos GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN left_ ON w.doc_id = left_.doc_id"""

#: Bytes as pairs of hexadecimal digits; windows that occur twice, merged into runs, and what lies between the runs.
SUFFIX_ARRAY = """WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT doc_id, i, md5(substr(h, i * 2 + 1, 400)) AS key FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM b WHERE length(h) >= 400)),
r AS (SELECT doc_id, i FROM k SEMI JOIN (SELECT key FROM k GROUP BY key HAVING count(*) > 1) m USING (key)),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM r)) GROUP BY doc_id, run),
e AS (SELECT doc_id, count(*) AS n, sum(z - a) AS gone FROM s GROUP BY doc_id),
g AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM s UNION ALL SELECT doc_id, max(z), 1000000000 FROM s GROUP BY doc_id),
p AS (SELECT g.doc_id, string_agg(substr(h, g.a * 2 + 1, (g.z - g.a) * 2), '' ORDER BY g.a) AS h FROM g JOIN b ON g.doc_id = b.doc_id GROUP BY g.doc_id)
SELECT b.doc_id, CAST(length(b.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(p.h, b.h))) AS kept_sha256
FROM b LEFT JOIN e ON b.doc_id = e.doc_id LEFT JOIN p ON b.doc_id = p.doc_id"""

#: Links by counting shared shingles, components by reachability.
NEAR_DUPLICATES = f"""WITH RECURSIVE w AS (SELECT doc_id, {_words("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, key FROM (SELECT doc_id, array_to_string(ws[i:i + 4], ' ') AS key FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5) UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.key = b.key AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM i JOIN c p ON p.doc_id = x JOIN c q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept FROM documents d JOIN m ON m.x = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id"""

_FOLDED = "list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

#: Shingles of items found in documents, counted in every window of an item's size that holds one; a shorter document is one window.
DECONTAMINATION = f"""WITH t AS (SELECT item_id, ws, len(ws) AS n, least(len(ws), 5) AS w FROM (SELECT DISTINCT item_id, {_FOLDED} AS ws FROM benchmark) WHERE len(ws) > 0),
ik AS (SELECT item_id, n, w, key, count(*) AS ic FROM (SELECT item_id, n, w, array_to_string(ws[i:i + w - 1], ' ') AS key FROM (SELECT *, unnest(range(1, n - w + 2)) AS i FROM t)) GROUP BY ALL),
d AS (SELECT doc_id, {_FOLDED} AS ws FROM documents),
dk AS (SELECT doc_id, w, len(ws) AS l, i AS pos, array_to_string(ws[i:i + w - 1], ' ') AS key FROM (SELECT doc_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS i FROM d, (SELECT DISTINCT w FROM t) WHERE len(ws) >= w)),
h AS (SELECT doc_id, item_id, n, n - ik.w + 1 + least(n, l) - ik.w + 1 AS m, ic, dk.key, unnest(range(greatest(1, pos - (n - ik.w)), least(pos, greatest(l - n, 0) + 1) + 1)) AS i FROM dk JOIN ik ON dk.key = ik.key AND dk.w = ik.w),
b AS (SELECT doc_id, item_id, n, m, i, sum(least(c, ic)) AS inter FROM (SELECT doc_id, item_id, n, m, i, key, ic, count(*) AS c FROM h GROUP BY ALL) GROUP BY ALL)
SELECT doc_id, item_id, CAST(i - 1 AS BIGINT) AS first_word, CAST(n AS BIGINT) AS n_words, CAST(inter AS DOUBLE) / CAST(m - inter AS DOUBLE) AS similarity FROM b WHERE 100 * inter >= 75 * (m - inter) QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY CAST(inter AS DOUBLE) / CAST(m - inter AS DOUBLE) DESC, i) = 1"""

SQL = {"op2_decontamination": DECONTAMINATION, "op5_substring_dedup": SUBSTRING, "op7_suffix_array_dedup": SUFFIX_ARRAY, "op10_near_duplicates": NEAR_DUPLICATES}
