"""SQL that gives the rows of :mod:`queries`, written apart from the operators, for an engine with RE2 expressions."""

from __future__ import annotations

from veilgrid.functions.labels import CATEGORIES, DOCUMENT_FIELDS, ENTITIES, PRIORITY, UNIQUE
from veilgrid.operators.policy import PRESETS, Policy
from veilgrid.plans.queries import AS_OF, FIXTURES


def quoted(items) -> str:
    return ", ".join("'" + str(x) + "'" for x in items)


SQL: dict[str, str] = {}

EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+"
EMAIL_FULL = "(?i)[A-Z0-9.!#$%&''*+/=?^_`{|}~-]+@(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\\.)+[A-Z]{2,63}"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
LUHN = "list_sum(list_transform(range(1, len(v) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse(v)[i] AS INT) ELSE CASE WHEN CAST(reverse(v)[i] AS INT) > 4 THEN CAST(reverse(v)[i] AS INT) * 2 - 9 ELSE CAST(reverse(v)[i] AS INT) * 2 END END)) % 10 = 0"


def located(source: str, key: str, text: str, pattern: str) -> str:
    """Matches with places: lengths of what stands between and of the matches before."""
    return f"""SELECT {key}, CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: length(g))), 0) AS BIGINT) AS start_at, found[i] AS v
        FROM (SELECT {key}, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM
            (SELECT {key}, regexp_extract_all({text}, '{pattern}') AS found, string_split_regex({text}, '{pattern}') AS gaps FROM {source}))"""


FOUND = {
    "email_address": (located("documents", "doc_id", "text", EMAIL), f"regexp_full_match(v, '{EMAIL_FULL}')", 1.0),
    "ip_address": (located("documents", "doc_id", "text", "[0-9]+(?:\\.[0-9]+)+"), f"regexp_full_match(v, '{OCTET}(?:\\.{OCTET}){{3}}')", 1.0),
    "phone_number": (located("documents", "doc_id", "text", "\\+[1-9][0-9 ().-]{6,20}[0-9]"), "length(regexp_replace(v, '[^0-9]', '', 'g')) BETWEEN 8 AND 15", 1.0),
    "account_card_number": (located("documents", "doc_id", "text", "\\b[0-9]{13,19}\\b"), LUHN, 1.0),
    "credential_secret": (f"SELECT doc_id, start_at + 9 AS start_at, v[10:49] AS v FROM ({located('documents', 'doc_id', 'text', 'token = .[0-9a-f]{40}.')})", "true", 0.9),
}
SQL["pii_category_counts"] = "SELECT category, count(*) AS n_matches, count(DISTINCT doc_id) AS n_docs FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS category, doc_id FROM ({q}) WHERE {ok}" for c, (q, ok, _) in FOUND.items()) + ") GROUP BY category"
for _name, _c in (("email", "email_address"), ("ipv4", "ip_address"), ("phone", "phone_number"), ("card", "account_card_number"), ("secret", "credential_secret")):
    _q, _ok, _score = FOUND[_c]
    SQL[f"pii_matches_{_name}"] = f"SELECT doc_id, start_at, start_at + length(v) AS stop_at, v AS value, CAST({_score} AS DOUBLE) AS confidence FROM ({_q}) WHERE {_ok}"

LINES = "SELECT doc_id, i - 1 AS line_no, lines[i] AS line, coalesce(list_sum(list_transform(lines[1:i - 1], lambda x: length(x) + 1)), 0) AS line_start FROM (SELECT doc_id, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)"
SQL["pii_match_lines"] = f"SELECT doc_id, line_no, CAST(line_start AS BIGINT) AS line_start, start_at AS start_in_line, v AS value FROM ({located(f'({LINES})', 'doc_id, line_no, line_start', 'line', EMAIL)}) WHERE regexp_full_match(v, '{EMAIL_FULL}')"
SQL["line_offsets"] = f"SELECT doc_id, count(*) AS n_lines, CAST(max(line_start) AS BIGINT) AS last_start, CAST(sum(length(line)) AS BIGINT) AS characters FROM ({LINES}) GROUP BY doc_id"

_PRESETS = " UNION ALL ".join(f"SELECT '{p.name}' AS policy, {str(p.checksum).lower()} AS checksum, '{p.invalid_checksum}' AS invalid_checksum, {p.min_risk} AS min_risk, {p.min_context} AS min_context, '{p.missing_context}' AS missing_context, '{p.review}' AS review" for p in PRESETS.values())
SQL["card_checksum_gate"] = f"""SELECT policy, valid, action, count(*) AS n FROM (SELECT policy, valid, CASE WHEN NOT checksum OR valid THEN 'mask' ELSE invalid_checksum END AS action
    FROM (SELECT {LUHN} AS valid FROM (SELECT unnest(regexp_extract_all(text, '\\b[0-9]{{16}}\\b')) AS v FROM documents)), ({_PRESETS})) GROUP BY ALL"""

_ALL = quoted(Policy().categories)


def gate_sql(presets: str, anchors: str = "", missing_anchor: str = "review") -> str:
    """Gates as a chain of subqueries, one rank for each."""
    level = lambda c: f"CASE {c} WHEN 'exclude' THEN 2 WHEN 'review' THEN 1 ELSE 0 END"
    needs = f"risk IS NOT NULL AND entity_type IN ({anchors})" if anchors else "false"
    return f"""SELECT *, CASE WHEN gone IS NOT NULL THEN 2 ELSE final0 END AS final,
        CASE WHEN gone IS NOT NULL OR final0 = 2 THEN false WHEN final0 = 1 AND review = 'exclude_review' THEN false WHEN final0 <> 1 AND review = 'review_only' THEN false ELSE true END AS included,
        CASE WHEN gone IS NOT NULL THEN review_required WHEN final0 = 1 AND NOT review_required THEN true WHEN final0 = 0 AND waived THEN false ELSE review_required END AS effective_review
    FROM (SELECT *, review_required AND (bad_sum OR no_context OR no_anchor) AND lvl = 0 AS waived,
        CASE WHEN review_required AND NOT ((bad_sum OR no_context OR no_anchor) AND lvl = 0) THEN greatest(lvl, 1) ELSE lvl END AS final0
    FROM (SELECT *, greatest(CASE WHEN bad_sum THEN {level('invalid_checksum')} ELSE 0 END, CASE WHEN no_context THEN {level('missing_context')} ELSE 0 END, CASE WHEN no_anchor THEN {level(f"'{missing_anchor}'")} ELSE 0 END) AS lvl
    FROM (SELECT *, checksum AND evidence LIKE 'checksum:invalid%' AS bad_sum,
        risk IS NOT NULL AND min_context > 0 AND n_gates < min_context AND NOT (checksum AND evidence = 'checksum:valid') AS no_context,
        ({needs}) AS needs_anchor, ({needs}) AND NOT (rule_id LIKE 'context:%' OR regexp_matches(evidence, '^(anchor|keyword|context|field):')) AS no_anchor,
        CASE WHEN entity_type NOT IN ({_ALL}) THEN 'category not selected' WHEN risk < min_risk THEN 'risk below minimum' END AS gone
    FROM (SELECT *, CASE WHEN rule_id LIKE 'context:%' OR evidence = 'anchor:prefix' THEN 'field' WHEN evidence LIKE 'keyword:%' THEN 'keyword' END AS gate,
        CASE WHEN rule_id LIKE 'context:%' OR evidence = 'anchor:prefix' OR evidence LIKE 'keyword:%' THEN 1 ELSE 0 END AS n_gates
    FROM ({FIXTURES['gated']}) g, ({presets}) p))))"""


_ACTION = "CASE final WHEN 2 THEN 'exclude' WHEN 1 THEN 'review' ELSE 'mask' END"
_TWO = f"SELECT * FROM ({_PRESETS}) WHERE policy = 'standard'"
SQL["policy_preset_sweep"] = f"SELECT CAST(doc_id AS BIGINT) AS id, policy, {_ACTION} AS action, included, effective_review FROM ({gate_sql(_PRESETS)})"
SQL["policy_anchor_gate"] = f"""SELECT CAST(doc_id AS BIGINT) AS id, {_ACTION} AS action, included FROM ({gate_sql(f"SELECT * FROM ({_PRESETS}) WHERE policy = 'sensitive'", quoted(("phone_number", "date", "account_card_number")), "exclude")})"""
SQL["review_handling_matrix"] = f"""SELECT policy, {_ACTION} AS action, count(*) AS n, count(*) FILTER (included) AS n_included
    FROM ({gate_sql(f"SELECT r AS policy, checksum, invalid_checksum, min_risk, min_context, missing_context, r AS review FROM ({_TWO}), (VALUES ('mask_all'), ('exclude_review'), ('review_only')) AS x(r)")}) GROUP BY ALL"""
SQL["policy_decision_reasons"] = f"""SELECT CAST(doc_id AS BIGINT) AS id, CASE WHEN gone IS NOT NULL THEN gone ELSE coalesce(nullif(concat_ws('; ',
    'context: ' || gate, CASE WHEN regexp_matches(evidence, '^(pattern|format|checksum|date_valid|date):') THEN 'format evidence' END,
    CASE WHEN NOT checksum AND evidence LIKE 'checksum:%' THEN 'checksum not checked' WHEN checksum AND evidence = 'checksum:valid' THEN 'checksum valid' WHEN bad_sum THEN 'checksum invalid: ' || invalid_checksum END,
    CASE WHEN no_context THEN 'context missing: ' || n_gates || '/' || min_context || ': ' || missing_context END,
    CASE WHEN waived THEN 'review waived by an explicit gate' WHEN review_required THEN 'detector asks for review' END,
    CASE WHEN final0 = 1 THEN 'masked, marked for review' END), ''), 'passed all gates') END AS reasons FROM ({gate_sql(_TWO)})"""

SQL["ner_fallback_decision"] = f"""WITH d AS (SELECT DISTINCT doc_id FROM ({FIXTURES['rule_spans']})), w(c) AS (VALUES ('person_name'), ('address')),
    m AS (SELECT doc_id, c FROM d, w EXCEPT SELECT doc_id, entity_type FROM ({FIXTURES['rule_spans']}))
    SELECT CAST(d.doc_id AS BIGINT) AS doc_id, count(c) > 0 AS run_ner, coalesce(string_agg(c, ',' ORDER BY c), '') AS missing FROM d LEFT JOIN m ON d.doc_id = m.doc_id GROUP BY d.doc_id"""

_SHOWN = "CAST(doc_id AS BIGINT) AS doc_id, entity_type, text, CAST(raw_start AS BIGINT) AS raw_start, CAST(raw_end AS BIGINT) AS raw_end, tokens, confidence, rule_id"
_R, _M = f"({FIXTURES['rule_spans']})", f"({FIXTURES['model_spans']})"
_MEET = "a.doc_id = b.doc_id AND ((a.raw_start < b.raw_end AND b.raw_start < a.raw_end) OR list_has_any(string_split(a.tokens, ','), string_split(b.tokens, ',')))"
SQL["combine_any"] = f"SELECT {_SHOWN} FROM (SELECT * FROM {_R} UNION ALL SELECT * FROM {_M})"
SQL["combine_agreement"] = f"SELECT {_SHOWN} FROM (SELECT a.* FROM {_R} a WHERE EXISTS (SELECT 1 FROM {_M} b WHERE {_MEET} AND a.entity_type = b.entity_type) UNION ALL SELECT a.* FROM {_M} a WHERE EXISTS (SELECT 1 FROM {_R} b WHERE {_MEET} AND a.entity_type = b.entity_type))"
SQL["combine_category_priority"] = f"SELECT {_SHOWN} FROM (SELECT a.* FROM {_R} a WHERE NOT (a.entity_type IN ('person_name', 'address') AND EXISTS (SELECT 1 FROM {_M} b WHERE {_MEET})) UNION ALL SELECT * FROM {_M})"
SQL["combine_routing"] = f"SELECT {_SHOWN} FROM (SELECT * FROM {_R} WHERE entity_type NOT IN ('person_name', 'address') UNION ALL SELECT * FROM {_M} WHERE entity_type IN ('person_name', 'address'))"

_S = f"({FIXTURES['spans']})"
_RANK = "CASE entity_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRIORITY.items()) + " ELSE 0 END"


def exact(src: str) -> str:
    return f"(SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY doc_id, entity_type, raw_start, raw_end, rule_id ORDER BY seq) = 1)"


def contained(src: str) -> str:
    return f"(SELECT * EXCLUDE (reach) FROM (SELECT *, max(raw_end) OVER (PARTITION BY doc_id, entity_type ORDER BY raw_start, raw_end DESC, confidence DESC, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src}) WHERE reach IS NULL OR reach < raw_end)"


def fragments(src: str) -> str:
    return f"""(SELECT doc_id, arg_min(seq, raw_start * 1000 + seq) AS seq, entity_type, string_agg(text, '' ORDER BY raw_start, seq) AS text, min(raw_start) AS raw_start, max(raw_end) AS raw_end, tokens, max(confidence) AS confidence,
        arg_min(rule_id, raw_start * 1000 + seq) AS rule_id FROM {src} GROUP BY doc_id, tokens, entity_type)"""


def location(src: str) -> str:
    return f"(SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY doc_id, raw_start, raw_end, tokens ORDER BY confidence DESC, {_RANK} DESC, seq) = 1)"


def overlap(src: str) -> str:
    """A fold by recursion: the numbers of the spans kept so far travel with what the last of them is."""
    return f"""(WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw_start, raw_end, seq) AS n, {_RANK} AS pr FROM {src}),
    f AS (SELECT doc_id, n, raw_end AS e, confidence AS c, pr AS p, raw_end - raw_start AS l, [n] AS kept FROM s WHERE n = 1
    UNION ALL SELECT f.doc_id, s.n, CASE WHEN take THEN s.raw_end ELSE f.e END, CASE WHEN take THEN s.confidence ELSE f.c END, CASE WHEN take THEN s.pr ELSE f.p END, CASE WHEN take THEN s.raw_end - s.raw_start ELSE f.l END,
        CASE WHEN s.raw_start >= f.e THEN list_append(f.kept, s.n) WHEN take THEN list_append(f.kept[1:len(f.kept) - 1], s.n) ELSE f.kept END
        FROM f JOIN s ON s.doc_id = f.doc_id AND s.n = f.n + 1, LATERAL (SELECT s.raw_start >= f.e OR (s.confidence, s.pr, s.raw_end - s.raw_start) > (f.c, f.p, f.l) AS take))
    SELECT s.* EXCLUDE (n, pr) FROM s JOIN (SELECT doc_id AS d, arg_max(kept, n) AS kept FROM f GROUP BY doc_id) k ON s.doc_id = k.d AND list_contains(k.kept, s.n))"""


for _name, _step in (("dedup_exact", exact), ("dedup_contained", contained), ("merge_fragments", fragments), ("resolve_location", location), ("resolve_overlap", overlap)):
    SQL[_name] = f"SELECT {_SHOWN} FROM {_step(_S)}"
_FINAL = overlap(location(fragments(contained(exact(_S)))))
SQL["dedup_pipeline"] = f"SELECT {_SHOWN} FROM {_FINAL}"
SQL["trace_outcomes"] = f"SELECT s.entity_type, CASE WHEN f.tokens IS NULL THEN 'deduplicated' ELSE 'kept' END AS outcome, count(*) AS n FROM {_S} s LEFT JOIN (SELECT DISTINCT doc_id, entity_type, tokens FROM {_FINAL}) f ON s.doc_id = f.doc_id AND s.entity_type = f.entity_type AND s.tokens = f.tokens GROUP BY ALL"

SQL["mask_text"] = f"""SELECT doc_id, md5(masked) AS masked_md5, CAST(n AS BIGINT) AS n_spans FROM (SELECT doc_id, len(found) AS n, coalesce(list_reduce(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || coalesce(repeat('*', length(found[i])), '')), lambda a, b: a || b), '') AS masked
    FROM (SELECT doc_id, regexp_extract_all(text, '{EMAIL}') AS found, string_split_regex(text, '{EMAIL}') AS gaps FROM documents))"""
SQL["mask_rectangles"] = f"SELECT CAST(id AS BIGINT) AS id, CAST(a AS BIGINT) AS x1, CAST(b AS BIGINT) AS y1, CAST(c AS BIGINT) AS x2, CAST(d AS BIGINT) AS y2 FROM (SELECT id, greatest(0, x1 - 2) AS a, greatest(0, y1 - 2) AS b, least(width - 1, x2 + 2) AS c, least(height - 1, y2 + 2) AS d FROM ({FIXTURES['rects']})) WHERE a <= c AND b <= d"
SQL["output_paths"] = f"""SELECT CAST(id AS BIGINT) AS id, CASE WHEN p LIKE '/%' OR list_contains(string_split(p, '/'), '..') THEN NULL WHEN regexp_matches(p, '[^/]\\.[^./]+$') THEN regexp_replace(p, '\\.([^./]+)$', '_masked.\\1') ELSE p || '_masked' END AS path
    FROM (SELECT id, regexp_replace(v, '^(data/)?images/', '') AS p FROM ({FIXTURES['paths']}))"""

_WORDS = """SELECT doc_id, l, unnest(list_filter(string_split_regex(lines[l], '[ \\t\\r]+'), lambda w: w <> '')) AS w, unnest(range(1, len(list_filter(string_split_regex(lines[l], '[ \\t\\r]+'), lambda w: w <> '')) + 1)) AS k
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS l FROM ({source}))"""


def laid_out(source: str) -> str:
    """Words with boxes: a running sum of widths and gaps on each line."""
    return f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY l, k) - 1 AS token_id, l, k, w AS text,
        CAST(30 + coalesce(sum(greatest(14, 15 * length(w)) + 14) OVER (PARTITION BY doc_id, l ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS x1, CAST(30 + 48 * (l - 1) AS BIGINT) AS y1, greatest(14, 15 * length(w)) AS width FROM ({_WORDS.replace('{source}', source)})"""


_TURNS = "SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations"
SQL["token_layout"] = f"SELECT doc_id, CAST(token_id AS BIGINT) AS token_id, text, x1, y1, CAST(x1 + width AS BIGINT) AS x2, y1 + 26 AS y2 FROM ({laid_out(_TURNS)})"
SQL["line_clustering"] = f"SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY l) - 1 AS BIGINT) AS line_id, text FROM (SELECT doc_id, l, string_agg(text, ' ' ORDER BY k) AS text FROM ({laid_out(_TURNS)}) GROUP BY doc_id, l)"
_SPACED = f"SELECT doc_id, token_id, length(text) AS n, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ({laid_out(_TURNS)})"
SQL["token_intervals"] = f"SELECT doc_id, count(*) AS n, CAST(max(s + n) AS BIGINT) AS raw_end, CAST(sum(s) AS BIGINT) AS starts FROM ({_SPACED}) GROUP BY doc_id"
SQL["mask_summary"] = f"""SELECT doc_id, CAST(sum(n) AS BIGINT) AS span_count, count(*) AS box_count FROM (SELECT doc_id, len(regexp_extract_all(w, '{EMAIL}')) AS n FROM ({_WORDS.replace('{source}', 'SELECT doc_id, text FROM documents')})) WHERE n > 0 GROUP BY doc_id"""

_SIZE = f"""SELECT id, width, height, CASE WHEN given_width > 0 AND given_height > 0 THEN given_width WHEN edge IS NOT NULL OR greatest(width, height) >= 1280 THEN CASE WHEN height > width THEN floor(width * (t / greatest(width, height)::DOUBLE)) ELSE t END ELSE width END AS w,
    CASE WHEN given_width > 0 AND given_height > 0 THEN given_height WHEN edge IS NOT NULL OR greatest(width, height) >= 1280 THEN CASE WHEN height > width THEN t ELSE floor(height * (t / greatest(width, height)::DOUBLE)) END ELSE height END AS h FROM (SELECT *, coalesce(edge, 1280) AS t FROM ({FIXTURES['boxes']}))"""
SQL["coordinate_rescale"] = f"SELECT CAST(id AS BIGINT) AS id, CAST(w AS BIGINT) AS w, CAST(h AS BIGINT) AS h, round(width / w::DOUBLE, 6) AS scale_x, round(height / h::DOUBLE, 6) AS scale_y FROM ({_SIZE})"
SQL["box_rescale"] = f"SELECT CAST(id AS BIGINT) AS id, CAST(greatest(0, floor(11 * (width / w::DOUBLE))) AS BIGINT) AS x1, CAST(greatest(0, floor(13 * (height / h::DOUBLE))) AS BIGINT) AS y1, CAST(least(width, ceil(101 * (width / w::DOUBLE))) AS BIGINT) AS x2, CAST(least(height, ceil(203 * (height / h::DOUBLE))) AS BIGINT) AS y2 FROM ({_SIZE})"

_FIELDS = "json_extract(response, '$.formResult.fieldResults[*]')"
_BOXES = "json_extract(list_filter(f, lambda x: json_extract_string(x, '$.displayName') = 'word_boxes' OR json_extract_string(x, '$.fieldId') = '802')[1], '$.value[*]')"
SQL["ocr_json_parse"] = f"""WITH r AS (SELECT image, response::JSON AS response FROM ({FIXTURES['responses']})), g AS (SELECT image, response, {_FIELDS} AS f FROM r), b AS (SELECT image, response, f, {_BOXES} AS boxes FROM g),
    s AS (SELECT *, CASE WHEN json_extract_string(response, '$.error') IS NOT NULL OR coalesce(json_extract_string(response, '$.resultCode'), '') <> '0000' THEN 'failed'
        WHEN coalesce(len(f), 0) = 0 OR coalesce(len(boxes), 0) = 0 OR len(list_filter(boxes, lambda x: json_extract(x, '$.boundingBox.y2') IS NULL)) > 0 THEN 'malformed' ELSE 'ok' END AS status FROM b)
    SELECT image, status, CASE WHEN status = 'ok' THEN len(list_distinct(list_transform(list_filter(boxes, lambda x: json_extract(x, '$.boundingBox.x1')::INT <= json_extract(x, '$.boundingBox.x2')::INT), lambda x: json_extract_string(x, '$.inferText') || json_extract_string(x, '$.boundingBox')))) ELSE 0 END::BIGINT AS n_tokens,
        json_extract(list_filter(f, lambda x: json_extract_string(x, '$.fieldId') = '803')[1], '$.value')::BIGINT AS given_width,
        CASE WHEN status = 'ok' THEN len(list_filter(boxes, lambda x: json_extract(x, '$.boundingBox.x1')::INT > json_extract(x, '$.boundingBox.x2')::INT)) ELSE 0 END::BIGINT AS inverted FROM s"""

_COLLAPSED = "regexp_replace(regexp_replace(regexp_replace({x}, '-+', '-', 'g'), '[.]+', '.', 'g'), '/+', '/', 'g')"
_NEXT = "regexp_extract(substr(v, i + 1), '^[ ./-]*(.)', 1)"
_LAST = "regexp_extract(substr(v, 1, i - 1), '(.)[ ./-]*$', 1)"
_DIGIT = "translate(substr(v, i, 1), 'OoQIilL|!ZzSsGB', '000111111225568')"
SQL["numeric_recovery"] = f"""SELECT CAST(id AS BIGINT) AS id, {_COLLAPSED.format(x="any_value(v)")} AS recovered, {_COLLAPSED.format(x="string_agg(CASE WHEN regexp_matches(" + _NEXT + ", '[0-9]') OR regexp_matches(" + _LAST + ", '[0-9]') THEN " + _DIGIT + " ELSE substr(v, i, 1) END, '' ORDER BY i)")} AS tolerant
    FROM (SELECT id, v, unnest(range(1, length(v) + 1)) AS i FROM ({FIXTURES['confusions']})) GROUP BY id"""
SQL["search_form"] = f"SELECT CAST(id AS BIGINT) AS id, regexp_replace(translate(v, '０１２ＡＢＣ３－–−　', '012ABC3---'), ' ', '', 'g') AS form FROM ({FIXTURES['forms']})"

_D = "regexp_replace(v, '[^0-9]', '', 'g')"
_SUM = lambda weights: " + ".join(f"CAST(d[{i + 1}] AS INT) * {w}" for i, w in enumerate(weights))
_BORN = "try_strptime(CASE WHEN d[7] IN ('9', '0') THEN '18' WHEN d[7] IN ('1', '2', '5', '6') THEN '19' ELSE '20' END || d[1:6], '%Y%m%d')"
_GOOD = f"length(d) = 13 AND {_BORN} IS NOT NULL AND {_BORN} <= DATE '{AS_OF}'"
SQL["rrn_frn_validate"] = f"""SELECT CAST(id AS BIGINT) AS id, coalesce({_GOOD} AND d[7] IN ('1', '2', '3', '4', '9', '0'), false) AS resident, coalesce({_GOOD} AND d[7] IN ('5', '6', '7', '8'), false) AS foreigner,
    CASE WHEN length(d) = 13 THEN (11 - ({_SUM((2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5))}) % 11) % 10 = CAST(d[13] AS INT) ELSE false END AS check_ok FROM (SELECT id, {_D} AS d FROM ({FIXTURES['numbers']}))"""
SQL["idcard_classify"] = f"SELECT CAST(id AS BIGINT) AS id, CASE WHEN regexp_full_match(regexp_replace(v, '-', '', 'g'), '[0-9]{{13}}') AND {_GOOD} THEN CASE WHEN d[7] IN ('5', '6', '7', '8') THEN 'foreigner_registration_number' ELSE 'resident_registration_number' END ELSE 'id_card_number' END AS kind FROM (SELECT id, v, {_D} AS d FROM ({FIXTURES['numbers']}))"
SQL["brn_validate"] = f"SELECT CAST(id AS BIGINT) AS id, CASE WHEN length(d) = 10 THEN (10 - ({_SUM((1, 3, 7, 1, 3, 7, 1, 3, 5))} + (CAST(d[9] AS INT) * 5) // 10) % 10) % 10 = CAST(d[10] AS INT) ELSE false END AS ok FROM (SELECT id, {_D} AS d FROM ({FIXTURES['business']}))"
SQL["corp_validate"] = f"SELECT CAST(id AS BIGINT) AS id, CASE WHEN length(d) = 13 THEN (10 - ({_SUM((1, 2) * 6)}) % 10) % 10 = CAST(d[13] AS INT) ELSE false END AS ok FROM (SELECT id, {_D} AS d FROM ({FIXTURES['corporate']}))"
SQL["passport_validate"] = f"SELECT CAST(id AS BIGINT) AS id, regexp_full_match(v, '(M|S|G|P[PMSODRT])[0-9]{{8}}') AND v[-8:] <> '00000000' AS ok FROM ({FIXTURES['passports']})"
SQL["driver_license_validate"] = f"SELECT CAST(id AS BIGINT) AS id, TRY_CAST(v[1:2] AS INT) BETWEEN 11 AND 28 AND (regexp_full_match(v, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{6}}-[0-9]{{2}}') OR (regexp_full_match(v, '[0-9]{{12}}') AND anchored)) AS ok FROM ({FIXTURES['licenses']})"
SQL["representative_phone_filter"] = f"SELECT CAST(id AS BIGINT) AS id, regexp_full_match(regexp_replace(v, '[ ./-]', '', 'g'), '1[5678][0-9]{{6}}') AS ok FROM ({FIXTURES['phones']})"
SQL["nearby_field_evidence"] = "WITH k(c, l) AS (VALUES " + ", ".join(f"('{c}', '{x}')" for c, ls in DOCUMENT_FIELDS.items() for x in dict.fromkeys(ls)) + f""") SELECT CAST(id AS BIGINT) AS id, (SELECT l FROM k WHERE c = entity_type AND contains(near, upper(l)) ORDER BY length(l) DESC, l LIMIT 1) AS label
    FROM (SELECT id, entity_type, upper(regexp_replace(substr(raw, greatest(s - 64, 0) + 1, e + 24 - greatest(s - 64, 0)), ' ', '', 'g')) AS near FROM ({FIXTURES['contexts']}))"""
SQL["field_anchor_prefix"] = f"SELECT CAST(id AS BIGINT) AS id, regexp_matches(rtrim(regexp_replace(substr(raw, greatest(s - 32, 0) + 1, s - greatest(s - 32, 0)), ' ', '', 'g'), ':：-'), '(여권번호|휴대전화번호|고객센터)$') AS anchored FROM ({FIXTURES['contexts']})"
SQL["bank_anchor_match"] = f"""SELECT CAST(id AS BIGINT) AS id, CASE WHEN regexp_full_match(v, '국민은행') THEN 0.85 WHEN regexp_matches(v, '국민은행|신한은행') THEN 0.85 WHEN regexp_matches(v, '(^|[^0-9A-Za-z가-힣])(우리|농협)($|[^0-9A-Za-z가-힣])') THEN 0.8
    WHEN len(list_filter(['신한', '신협', '국민은행'], lambda t: length(t) = length(v) AND list_sum(list_transform(range(1, length(t) + 1), lambda i: CASE WHEN t[i] = v[i] THEN 0 ELSE 1 END)) = 1)) > 0 THEN 0.6 END::DOUBLE AS score FROM ({FIXTURES['banks']})"""

_E = " ".join(f"WHEN '{k}' THEN '{c}'" for k, (c, _) in ENTITIES.items())
_T = " ".join(f"WHEN '{k}' THEN {t}" for k, (_, t) in ENTITIES.items())
_P = f"SELECT *, CASE entity {_E} END AS category, CASE entity {_T} END AS base FROM ({FIXTURES['predictions']})"
SQL["ner_threshold_trace"] = f"SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(view_id AS BIGINT) AS view_id, CAST(seq AS BIGINT) AS seq, category, round(CAST(base - 0.05 AS DOUBLE), 6) AS threshold, confidence >= round(CAST(base - 0.05 AS DOUBLE), 6) AS passed FROM ({_P})"
SQL["ner_bio_merge"] = f"""WITH p AS (SELECT *, CASE WHEN lag(category) OVER w = category AND start <= lag(stop) OVER w + 1 AND (bio = 'I' OR category IN ('person_name', 'address')) THEN 0 ELSE 1 END AS fresh FROM ({_P}) WHERE confidence >= base WINDOW w AS (PARTITION BY doc_id, view_id ORDER BY seq)),
    q AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, view_id ORDER BY seq) AS run FROM p),
    g AS (SELECT doc_id, view_id, run, any_value(category) AS category, string_agg(entity, '+' ORDER BY seq) AS entities, min(start) AS s, max(stop) AS e, avg(confidence) AS c, sum(length(text)) AS n FROM q GROUP BY doc_id, view_id, run)
    SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(view_id AS BIGINT) AS view_id, category, CASE WHEN entities = 'EMAIL+EMAIL' THEN 'EMAIL' WHEN entities = 'USERNAME+USERNAME' THEN 'USERNAME' ELSE entities END AS entities, CAST(s AS BIGINT) AS start_at, CAST(e AS BIGINT) AS stop_at, round(c, 6) AS confidence
    FROM g WHERE n >= CASE WHEN category = 'address' AND entities IN ('STREET', 'BUILDINGNUM') THEN 3 WHEN category IN ('person_name', 'address') THEN 2 ELSE 1 END"""

_LIST = lambda c: f"list_sort(list_filter(string_split(coalesce({c}, ''), ','), lambda x: x <> ''))"
_CASES = lambda want: f"SELECT case_id, scenario, expectation, {_LIST(want)} AS e, {_LIST('got')} AS g, CASE WHEN expectation = 'required' THEN {_LIST(want)} = {_LIST('got')} END AS passed FROM ({FIXTURES['cases']})"
_COUNTS = "count(*) AS total, count(passed) AS scored, count(*) FILTER (passed) AS passed_cases"
SQL["evaluator_summary"] = f"""SELECT checksum, {_COUNTS}, round(count(*) FILTER (passed) / count(passed), 4) AS pass_rate, count(*) FILTER (len(e) > 0 AND passed IS NOT NULL) AS positives, count(*) FILTER (len(e) > 0 AND passed) AS positives_passed,
    count(*) FILTER (len(e) = 0 AND passed IS NOT NULL) AS negatives, count(*) FILTER (len(e) = 0 AND passed) AS negatives_passed FROM (SELECT true AS checksum, * FROM ({_CASES('want')}) UNION ALL SELECT false, * FROM ({_CASES('coalesce(want_off, want)')})) GROUP BY checksum"""
SQL["evaluator_by_scenario"] = f"SELECT scenario, {_COUNTS} FROM ({_CASES('want')}) GROUP BY scenario"
SQL["evaluator_by_category"] = f"""WITH c AS (SELECT * FROM ({_CASES('want')}) WHERE passed IS NOT NULL), a AS (SELECT case_id, unnest(e) AS category FROM c), b AS (SELECT case_id, unnest(g) AS category FROM c)
    SELECT coalesce(a.category, b.category) AS category, count(a.case_id) AS expected, count(*) FILTER (a.case_id IS NOT NULL AND b.case_id IS NOT NULL) AS detected, count(*) FILTER (a.case_id IS NULL) AS unexpected FROM a FULL JOIN b ON a.case_id = b.case_id AND a.category = b.category GROUP BY 1"""

_FINDINGS = " UNION ALL ".join(f"SELECT doc_id FROM ({FOUND[c][0]}) WHERE {FOUND[c][1]}" for c in ("email_address", "ip_address"))
SQL["quality_vs_pii"] = f"SELECT quality, toxic, count(*) AS n_docs, count(n) AS n_with, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_matches FROM labels LEFT JOIN (SELECT doc_id, count(*) AS n FROM ({_FINDINGS}) GROUP BY doc_id) f USING (doc_id) GROUP BY quality, toxic"
SQL["pages_url_scan"] = "SELECT page_id, CAST(strpos(url, 'http') - 1 AS BIGINT) AS start_at, regexp_extract(url, '(?i)https?://[^ <>\"'']*[^ <>\"''.,;:!?)]') AS value FROM pages WHERE regexp_matches(url, '(?i)https?://[^ <>\"'']+')"
SQL["conversation_pii_by_role"] = f"SELECT role, count(*) AS turns, CAST(sum(len(list_filter(regexp_extract_all(text, '{EMAIL}'), lambda v: regexp_full_match(v, '{EMAIL_FULL}'))) + len(list_filter(regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)+'), lambda v: regexp_full_match(v, '{OCTET}(?:\\.{OCTET}){{3}}')))) AS BIGINT) AS n FROM conversations GROUP BY role"
SQL["dedup_documents"] = "SELECT entity_type, count(*) AS n, CAST(sum(length(v)) AS BIGINT) AS characters FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS entity_type, v FROM ({q}) WHERE {ok}" for c, (q, ok, _) in FOUND.items()) + ") GROUP BY entity_type"
_RULED = " UNION ALL ".join(f"SELECT doc_id, '{c}' AS entity_type, '{a}' AS action FROM ({FOUND[c][0]}) WHERE {FOUND[c][1]}" for c, a in (("email_address", "review"), ("ip_address", "review"), ("phone_number", "review"), ("account_card_number", "mask"), ("credential_secret", "mask")))
SQL["risk_by_language"] = f"SELECT lang, entity_type, action, count(*) AS n FROM ({_RULED}) JOIN documents USING (doc_id) GROUP BY ALL"
SQL["category_dimension"] = "SELECT u AS is_unique, count(*) AS n, CAST(sum(p) AS BIGINT) AS priorities FROM (VALUES " + ", ".join(f"({str(c in UNIQUE).lower()}, {PRIORITY.get(c, 0)})" for c in CATEGORIES) + ") AS t(u, p) GROUP BY u"
SQL["table_header_join"] = f"""WITH t AS (SELECT * FROM ({FIXTURES['tokens']})), h(doc_id, line_id, a, z, label) AS (VALUES (1, 0, 2, 3, '휴대전화'), (1, 0, 4, 4, 'EMAIL'), (1, 3, 0, 0, '계좌번호'), (1, 3, 1, 1, '여권번호')),
    b AS (SELECT h.*, (min(t.x1) + max(t.x2)) / 2.0 AS c, greatest(1, max(t.y2) - min(t.y1)) AS hh, max(t.y2) AS bottom FROM h JOIN t ON t.doc_id = h.doc_id AND t.line_id = h.line_id AND t.pos BETWEEN h.a AND h.z GROUP BY ALL),
    e AS (SELECT b.*, ((l.x1 + l.x2) / 2.0 + c) / 2 AS lo, ((r.x1 + r.x2) / 2.0 + c) / 2 AS hi, (SELECT min(line_id) FROM h WHERE h.line_id > b.line_id) AS stop FROM b LEFT JOIN t l ON l.line_id = b.line_id AND l.pos = b.a - 1 LEFT JOIN t r ON r.line_id = b.line_id AND r.pos = b.z + 1)
    SELECT CAST(e.doc_id AS BIGINT) AS doc_id, CAST(e.line_id AS BIGINT) AS line_id, CAST(v.line_id AS BIGINT) AS value_line, label, string_agg(v.text, ' ' ORDER BY v.pos) AS value_text FROM e JOIN t v ON v.line_id > e.line_id AND v.line_id <= e.line_id + 3 AND (stop IS NULL OR v.line_id < stop)
    AND (SELECT min(y1) FROM t x WHERE x.line_id = v.line_id) - bottom <= hh * 3 * (v.line_id - e.line_id) AND (lo IS NULL OR (v.x1 + v.x2) / 2.0 >= lo) AND (hi IS NULL OR (v.x1 + v.x2) / 2.0 <= hi) GROUP BY ALL"""

_TOK = f"({FIXTURES['tokens']})"
SQL["format_compact_view"] = f"""SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(line_id AS BIGINT) AS line_id, text, CAST(length(text) AS BIGINT) AS n FROM (SELECT doc_id, line_id, string_agg(CASE WHEN pos = 0 OR (piece AND before) THEN text ELSE ' ' || text END, '' ORDER BY pos) AS text
    FROM (SELECT *, lag(piece) OVER (PARTITION BY doc_id, line_id ORDER BY pos) AS before FROM (SELECT *, regexp_matches(text, '[0-9@:/._+-]|^[A-Za-z]+$') AS piece FROM {_TOK})) GROUP BY doc_id, line_id)"""
_LINE = f"SELECT doc_id, line_id, string_agg(text, ' ' ORDER BY pos) AS text FROM {_TOK} GROUP BY doc_id, line_id"
SQL["spaced_view"] = f"""SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(line_id AS BIGINT) AS line_id, text || '|' || follower AS text, CAST(o AS BIGINT) AS first_raw, CAST(o + length(text) + length(follower) AS BIGINT) AS last_raw
    FROM (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY line_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o, lead(text) OVER (PARTITION BY doc_id ORDER BY line_id) AS follower FROM ({_LINE})) WHERE follower IS NOT NULL"""
_DAY = "[0-9]{4} *[-./년] *[0-9]{1,2} *[-./월] *[0-9]{1,2}"
SQL["address_field_cut"] = f"""SELECT CAST(id AS BIGINT) AS id, CASE WHEN ok THEN cut END AS address, CASE WHEN ok THEN CAST(length(v) - length(ltrim(v)) AS BIGINT) END AS start_at FROM (SELECT id, v, cut,
    regexp_matches(cut, '^.{{0,12}}(특별시|광역시|[가-힣]{{2,}}도|[가-힣]{{2,}}시)') AND regexp_matches(regexp_replace(cut, '{_DAY}', ' ', 'g'), '[0-9]') AS ok FROM (SELECT id, v, rtrim(regexp_replace(trim(v), '( +(전화|주소|성명|이메일)|{_DAY}).*$', '')) AS cut FROM ({FIXTURES['addresses']})))"""
SQL["account_block"] = f"""SELECT CAST(id AS BIGINT) AS id, CASE WHEN ok THEN a END AS account, CASE WHEN ok THEN CAST(bank + CASE WHEN regexp_matches(text, '계좌번호: *[0-9]') THEN 0.05 ELSE 0 END AS DOUBLE) END AS account_score,
    CASE WHEN ok THEN coalesce(nullif(regexp_extract(text, '예금주: *([가-힣]{{2,4}})', 1), ''), nullif(regexp_extract(text, chr(10) || '([가-힣]{{2,4}})$', 1), '')) END AS owner
    FROM (SELECT *, bank IS NOT NULL AND length(regexp_replace(a, '[^0-9]', '', 'g')) BETWEEN 10 AND 16 AS ok FROM (SELECT id, text, regexp_extract(text, '[0-9][0-9 -]{{8,30}}[0-9]') AS a, CASE WHEN regexp_matches(text, '(국민|신한|우리)은행') THEN 0.85 WHEN text LIKE '신형%' THEN 0.6 END AS bank FROM ({FIXTURES['accounts']})))"""
_JSON = "'{{\"seq\":' || seq || ',\"entity_type\":\"' || entity_type || '\",\"text\":\"' || text || '\",\"raw_start\":' || raw_start || ',\"raw_end\":' || raw_end || '}}'".replace("{{", "{").replace("}}", "}")
SQL["sink_json"] = "SELECT CAST(doc_id AS BIGINT) AS doc_id, '{\"doc_id\":' || doc_id || ',\"count\":' || count(*) || ',\"detections\":[' || string_agg(" + _JSON + ", ',' ORDER BY seq, entity_type, text) || ']}' AS json FROM " + _S + " GROUP BY doc_id"

#: What must be found is part of how each case is made.
SQL["evaluation_run"] = f"SELECT case_id, want AS found FROM ({FIXTURES['run_cases']}) WHERE expectation = 'required'"
_VALUES = laid_out(f"SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM ({FIXTURES['run_cases']}) WHERE scenario IN ('labelled', 'no_hyphen', 'several')")
SQL["mask_from_run"] = f"SELECT doc_id, CAST(x1 - 2 AS BIGINT) AS x1, CAST(y1 - 2 AS BIGINT) AS y1, CAST(x1 + width + 2 AS BIGINT) AS x2, CAST(y1 + 28 AS BIGINT) AS y2 FROM ({_VALUES}) WHERE regexp_matches(text, '[0-9]')"
SQL["ocr_confidence_list"] = f"SELECT doc_id, CAST(token_id AS BIGINT) AS token_id, text FROM ({laid_out(_TURNS)}) WHERE 1 - length(text) / 50.0 < 0.8"
_EVERY = " UNION ALL ".join(f"SELECT rule_id FROM ({FIXTURES[x]})" for x in ("rule_spans", "model_spans", "spans"))
SQL["span_sources"] = f"SELECT CASE WHEN rule_id LIKE 'rule:%' THEN 'rule' WHEN rule_id LIKE 'context:%' THEN 'context' WHEN rule_id LIKE 'ner:%' THEN 'model' ELSE split_part(rule_id, ':', 1) END AS source, count(*) AS n FROM ({_EVERY}) GROUP BY 1"
