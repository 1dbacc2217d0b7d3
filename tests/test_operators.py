import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from veilgrid.operators import catalog, evaluate, layout, masking, ner, policy, postprocess, spans, structure, tables, views
from veilgrid.plans import detect
from veilgrid.plans.detect import SPAN_TYPES
from veilgrid.sources import ocr, texts


def span(doc, seq, kind, text, start, end, tokens, confidence, rule="r", ocr_confidence=0.9, review=False, risk=3, evidence=()):
    return (doc, seq, kind, text, text, start, end, list(tokens), [], confidence, ocr_confidence, rule, review, risk, list(evidence))


def table(spark, rows):
    return spark.createDataFrame([(*r, []) for r in rows], SPAN_TYPES)


def kept(df):
    return sorted((r.doc_id, r.entity_type, r.text, r.raw_start, r.raw_end) for r in df.collect())


def test_contained_spans_go_even_with_higher_scores(spark):
    out = spans.drop_contained(table(spark, [span(1, 0, "phone_number", "X", 0, 20, [1], 0.6), span(1, 1, "phone_number", "Y", 5, 10, [1], 1.0), span(1, 2, "date", "Z", 5, 10, [1], 1.0)]))
    assert kept(out) == [(1, "date", "Z", 5, 10), (1, "phone_number", "X", 0, 20)]


def test_containment_matches_nested_loops(spark):
    rng = random.Random(2)
    rows = [span(d, i, rng.choice(["url", "date"]), str(i), a := rng.randrange(20), a + rng.randrange(1, 9), [i], rng.choice([0.5, 1.0])) for d in range(60) for i in range(8)]
    want = []
    for d in range(60):
        left = []
        for r in sorted((x for x in rows if x[0] == d), key=lambda x: (x[5], -x[6], -x[9])):
            if not any(y[2] == r[2] and y[5] <= r[5] and y[6] >= r[6] for y in left):
                left.append(r)
        want += [(x[0], x[2], x[5], x[6]) for x in left]
    got = [(r.doc_id, r.entity_type, r.raw_start, r.raw_end) for r in spans.drop_contained(table(spark, rows)).collect()]
    assert sorted(got) == sorted(want)


def test_fragments_join_without_what_is_between(spark):
    out = spans.merge_fragments(table(spark, [span(1, 0, "email_address", ".go.kr", 754, 760, [145], 0.9, ocr_confidence=0.5), span(1, 1, "email_address", "home", 747, 751, [145], 1.0, ocr_confidence=0.8), span(1, 2, "email_address", "other", 800, 805, [145, 146], 0.7)]))
    rows = {r.text: r for r in out.collect()}
    assert set(rows) == {"home.go.kr", "other"}
    r = rows["home.go.kr"]
    assert (r.raw_start, r.raw_end, r.detector_confidence, r.ocr_confidence) == (747, 760, 1.0, 0.8)


def test_places_by_confidence_then_category(spark):
    a = table(spark, [span(1, 0, "resident_registration_number", "a", 0, 14, [1], 0.7), span(1, 1, "corporate_registration_number", "b", 0, 14, [1], 1.0), span(2, 0, "corporate_registration_number", "c", 0, 14, [1], 0.65), span(2, 1, "resident_registration_number", "d", 0, 14, [1], 0.65), span(3, 0, "age", "e", 0, 2, [1], 0.5), span(3, 1, "height", "f", 0, 2, [1], 0.5)])
    assert [r[2] for r in kept(spans.resolve_places(a))] == ["b", "d", "e"]


def test_replaced_spans_do_not_come_back(spark):
    a = table(spark, [span(1, 0, "url", "A", 0, 10, [1], 0.8), span(1, 1, "url", "B", 5, 20, [2], 0.9), span(1, 2, "url", "C", 15, 30, [3], 1.0), span(2, 0, "url", "A", 0, 10, [1], 0.8), span(2, 1, "url", "B", 5, 15, [2], 0.8)])
    assert [r[2] for r in kept(spans.resolve_overlaps(a))] == ["C", "A"]


def test_map_span_bounds(spark):
    df = spark.createDataFrame([([5, 6, None, 9], [1, 1, None, 2])], "raw array<int>, tok array<int>")
    at = lambda a, b: df.select(spans.map_span(F.col("raw"), F.col("tok"), F.lit(a), F.lit(b)).alias("p")).first().p
    assert at(1, 4).asDict() == {"raw_start": 6, "raw_end": 10, "token_ids": [1, 2]}
    assert at(2, 3) is None and at(0, 5) is None and at(3, 3) is None and at(-1, 2) is None


def gate(spark, level, **settings):
    rows = table(spark, [
        span(1, 0, "resident_registration_number", "x", 0, 14, [1], 0.7, risk=5, evidence=["checksum:invalid"]), span(2, 0, "person_name", "x", 0, 3, [1], 0.88, risk=None, review=True),
        span(3, 0, "resident_registration_number", "x", 0, 14, [1], 1.0, risk=5, evidence=["checksum:valid"]), span(4, 0, "phone_number", "x", 0, 9, [1], 1.0, evidence=["field:전화"]),
        span(5, 0, "account_card_number", "x", 0, 9, [1], 0.9, rule="context:ACCOUNT_CONTEXT", risk=4, review=True),
    ])
    out = policy.evaluate(rows, policy.policies(spark, [replace(policy.preset(level), **settings)]))
    return {r.doc_id: (r.action, r.included) for r in out.collect()}


def test_gates_of_presets(spark):
    one, two, three, four = (gate(spark, i) for i in (1, 2, 3, 4))
    assert [g[1] for g in (one, two, three, four)] == [("exclude", False), ("review", True), ("mask", True), ("mask", True)]
    assert one[2] == ("review", False) and two[2] == ("review", True)
    assert two[3] == ("mask", True)  # a valid check digit stands in for context
    assert two[4] == ("review", True)  # a field label nearby is no context of its own
    assert two[5] == ("review", True)
    anchored = gate(spark, 3, anchor_required=("phone_number", "resident_registration_number"), missing_anchor="exclude")
    assert anchored[4] == ("mask", True) and anchored[3] == ("exclude", False)
    assert gate(spark, 2, review="review_only")[3] == ("mask", False)
    assert gate(spark, 3, categories=("person_name",))[3] == ("exclude", False)
    assert gate(spark, 3, min_confidence=0.95)[1] == ("exclude", False)


def test_policy_round_trip(tmp_path):
    p = replace(policy.preset(3), person_labels=("직 원", ""), anchor_required=("date",))
    path = str(tmp_path / "p.json")
    policy.save(p, path)
    assert policy.load(path) == p and p.person_labels == ("직원",)
    assert policy.load(str(tmp_path / "none.json")) == policy.Policy()
    for wrong in ({"schema_version": 2}, {"schema_version": 1, "policy": {"x": 1}}, {"schema_version": 1, "policy": {"min_risk": "3"}}, {"schema_version": 1, "policy": {"checksum": 1}}, []):
        with pytest.raises(ValueError):
            policy.from_json(json.dumps(wrong))
    assert set(policy.Policy(ner_entities=("IDCARD",)).ner_categories) == {"resident_registration_number", "foreigner_registration_number", "id_card_number"}


def test_combination_and_decisions(spark):
    rules = table(spark, [span(1, 0, "person_name", "a", 0, 3, [1], 0.85, "rule:PERSON"), span(1, 1, "phone_number", "b", 10, 20, [3], 1.0, "rule:PHONE")])
    model = table(spark, [span(1, 0, "person_name", "m", 0, 4, [1], 0.9, "ner:SURNAME", review=True, risk=None), span(1, 1, "address", "n", 12, 18, [3], 0.9, "ner:CITY", review=True, risk=None)])
    base = replace(policy.preset(3), ner_scope="semantic")
    merged = lambda **s: [r[2] for r in kept(policy.combine(rules, model, replace(base, **s)))]
    assert merged(merge="agreement") == ["a", "m"] and merged(merge="category_priority") == ["n", "m", "b"]
    assert merged(execution="category_routing") == ["n", "m", "b"] and len(merged(merge="any")) == 4
    run = detect.decide(spark.createDataFrame([(1,)], "doc_id long"), rules, model, base)
    by = {r.text: (r.action, r.included, r.reasons) for r in run.decisions.collect()}
    assert by["a"][:2] == ("exclude", False) and by["a"][2][-1] == "dropped by the merge"
    assert by["m"][1] and by["b"][1] and not by["n"][1]
    assert not policy.runs_rules(replace(base, execution="ner_only")) and policy.runs_rules(base)
    assert not policy.runs_rules(replace(base, execution="category_routing", categories=("person_name",)))


def box(i, text, x1, y1, x2, y2):
    return (i, text, 0.99, x1, y1, x2, y2)


def laid(spark, docs):
    return spark.createDataFrame(docs, f"doc_id long, tokens array<{layout.TOKEN}>")


def test_line_clustering_keeps_rows_apart(spark):
    tokens = [box(0, "a", 10, 10, 20, 30), box(1, "b", 30, 12, 40, 32), box(2, "tall", 50, 10, 60, 58), box(3, "c", 10, 40, 20, 60), box(4, "d", 30, 41, 40, 61)]
    out = layout.with_lines(laid(spark, [(1, tokens), (2, []), (3, None)])).orderBy("doc_id").collect()
    assert [[t.text for t in line.tokens] for line in out[0].lines] == [["a", "b", "tall"], ["c", "d"]]
    assert out[1].lines == [] and out[2].lines == []
    with pytest.raises(ValueError):
        layout.with_lines(laid(spark, []), 0)


def test_synthetic_layout_and_both_line_builders(spark):
    docs = spark.createDataFrame([(1, "one two\n\nthree  four five\n"), (2, None), (3, "")], "doc_id long, text string")
    rows = layout.with_lines(layout.synthetic(docs)).withColumn("fast", layout.lines_by_top(F.col("tokens")))
    for r in rows.collect():
        assert r.lines == r.fast
    at = layout.token_intervals(layout.placed_lines(rows)).where("doc_id = 1").orderBy("raw_start").collect()
    raw = rows.where("doc_id = 1").select(layout.raw_text().alias("t")).first().t
    assert raw == "one two\nthree four five" and all(raw[r.raw_start : r.raw_end] == r.text for r in at)


def test_rescale(spark):
    def size(w, h, gw=None, gh=None, edge=None):
        df = spark.createDataFrame([(w, h, gw, gh, edge)], "w int, h int, gw int, gh int, e int")
        return tuple(df.select(layout.ocr_size(*(F.col(c) for c in ("w", "h", "gw", "gh", "e"))).alias("s")).first().s)

    assert size(1000, 2000) == (640, 1280) and size(800, 600) == (800, 600) and size(800, 600, edge=960) == (960, 720) and size(4000, 3000, 1000, 750) == (1000, 750)
    df = spark.createDataFrame([([box(0, "t", 5, 5, 700, 20)],)], f"tokens array<{layout.TOKEN}>").withColumn("s", F.struct(F.lit(640).alias("w"), F.lit(480).alias("h")))
    assert df.select(layout.outside(F.col("tokens"), F.col("s")).alias("x")).first().x == [0]
    with pytest.raises(Exception, match="outside the OCR image"):
        df.select(layout.to_image(F.col("tokens"), F.lit(640), F.lit(480), F.col("s"))).collect()


def text_docs(spark, docs):
    return layout.with_lines(layout.synthetic(spark.createDataFrame(docs, "doc_id long, text string")))


def test_views_of_modes(spark):
    lines = layout.placed_lines(text_docs(spark, [(1, "계좌 123 - 456\nE-mail kim @b.co 끝"), (2, "12 가 3456")]))
    ready = views.ready_lines(lines)
    one = views.blocks(ready, 1)
    seen = {m: {(r.doc_id, r.line_id): r.v for r in one.select("doc_id", "line_id", views.view_of(F.col("ready"), m).alias("v")).collect()} for m in views.MODES[:4]}
    assert seen["token_spaced"][1, 1].text == "E-mail:kim @b.co 끝" and seen["format_compact"][1, 0].text == "계좌 123-456"
    assert seen["field_compact"][1, 1].text == "E-mail:kim@b.co끝" and seen["format_compact"][2, 0].text == "12가3456"
    v = seen["token_spaced"][1, 1]
    raw = "계좌 123 - 456\nE-mail kim @b.co 끝"
    assert len(v.text) == len(v.char_raw) == len(v.char_token) and all(p is None or raw[p] == c for c, p in zip(v.text, v.char_raw, strict=True))
    pair = views.blocks(ready, 2).select(views.view_of(F.col("ready"), "address_field").alias("a"), views.view_of(F.col("ready"), "token_spaced").alias("t")).first()
    assert "456 E-mail" in pair.a.text and "456\nE-mail" in pair.t.text
    with pytest.raises(ValueError):
        views.view_of(F.col("ready"), "nothing")


def test_recovered_views_keep_their_maps(spark):
    df = spark.createDataFrame([("9OO1--23", list(range(10, 18)), [1] * 8)], "text string, char_raw array<int>, char_token array<int>").select(F.struct("*").alias("v"))
    r = df.select(views.recovered(F.col("v"), True).alias("t"), views.recovered(F.col("v"), False).alias("p")).first()
    assert (r.t.text, r.t.char_raw) == ("9001-23", [10, 11, 12, 13, 14, 16, 17]) and r.p.text == "9OO1-23"


def test_strictness_levels_nest(spark):
    ready = views.ready_lines(layout.placed_lines(text_docs(spark, [(1, "성명 : 홍길동 전화 : O1O - 1234 -- 5678")])))
    modes = [{r["mode"] for r in views.line_views(ready, s).collect()} for s in policy.STRICTNESS]
    assert "format_compact" not in modes[0] and "format_compact" in modes[1] and "format_recovered" in modes[2] and "format_ocr_tolerant" in modes[3]
    assert all(a <= b for a, b in zip(modes, modes[1:], strict=False))


def account(spark, text):
    r = structure.account_blocks(spark.createDataFrame([(text,)], "text string")).first()
    return r.account, r.owner


def test_account_blocks(spark):
    a, o = account(spark, "국민은행\n123-456789-01-234\n홍길동")
    assert (a.value, a.confidence, o.value) == ("123-456789-01-234", 0.85, "홍길동") and a.start == 5 and o.start == 23
    a, o = account(spark, "신한은행 계좌번호: 110-123-456789 예금주: 김철수")
    assert a.confidence == 0.9 and "anchor:account-field" in a.evidence and o.value == "김철수" and o.confidence == 0.9
    assert account(spark, "소식\n123-456789-01-234") == (None, None) and account(spark, "a\nb\nc\n국민은행 1234567890123") == (None, None)
    a, _ = account(spark, "신형\n3333-01-1234567\n이영희")
    assert a.confidence == 0.6 and "bank:신한/신협" in a.evidence


def test_labelled_persons_and_address_fields(spark):
    df = spark.createDataFrame([("담 당 직원 : 홍 길동 입니다", " 서울특별시 중구 세종대로 110 전화 02-120")], "p string, a string")
    r = df.select(structure.labelled_persons(F.col("p"), ("담당직원",)).alias("p"), structure.address_field(F.col("a")).alias("a")).first()
    assert [(x.value, x.start, x.label) for x in r.p] == [("홍 길동", 9, "담당직원")] or r.p[0].value.startswith("홍 길동")
    assert (r.a.value, r.a.start) == ("서울특별시 중구 세종대로 110", 1)


def test_address_tail(spark):
    rows = ["길 12, 3층 (역삼동, 한빛빌딩) 끝", "길 12 (안내)", "길 12 끝", "길 12\n(역삼동)", "길 12 (역삼동\n한빛빌딩)"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").select("i", structure.address_tail(F.col("t"), F.lit(4)).alias("e"))
    assert [r.e for r in df.orderBy("i").collect()] == [len(rows[0]) - 2, 4, 4, 4, len(rows[4])]


def test_table_fields(spark):
    rows = [(1, 0, 0, 0, "구분", 10, 10, 50, 30), (1, 0, 1, 1, "전화", 200, 10, 240, 30), (1, 0, 2, 2, "번호", 242, 10, 280, 30), (1, 1, 0, 3, "본인", 10, 40, 50, 60), (1, 1, 1, 4, "010-1234-5678", 190, 40, 300, 60), (1, 2, 0, 5, "far", 190, 900, 300, 920)]
    t = spark.createDataFrame(rows, "doc_id long, line_id int, pos int, token_id int, text string, x1 int, y1 int, x2 int, y2 int")
    found = tables.headers(t, tables.label_table(spark))
    assert [(r.label, r.first, r.past) for r in found.collect()] == [("전화번호", 1, 3)]
    got = tables.field_texts(tables.fields(t, found, 3)).collect()
    assert [(r.spaced, r.token_ids) for r in got] == [("전화번호:\n010-1234-5678", [4])]


def test_address_extension():
    line = lambda i, *tokens: {"line_id": i, "tokens": [dict(zip(("token_id", "text", "confidence", "x1", "y1", "x2", "y2"), t, strict=True)) for t in tokens]}
    lines = [line(0, box(0, "세종대로", 10, 10, 90, 30), box(1, "110", 100, 10, 130, 30), box(2, "3층", 140, 10, 170, 30), box(3, "2020-01-02", 300, 10, 400, 30)), line(1, box(4, "201호(평촌동,", 10, 40, 120, 60), box(5, "끝", 130, 40, 150, 60)), line(2, box(6, "전화", 10, 70, 40, 90))]
    assert postprocess.extension(lines, [0, 1]) == [0, 1, 2, 4, 5]
    assert postprocess.extension(lines, [6]) == [6] and postprocess.extension([], [1]) == [1]


def test_checks_after_deduplication(spark):
    raw = "문의 1588-1234 그리고 고객센터 1599-0000 메일 a@b"
    rows = [span(1, 0, "phone_number", "1588-1234", 3, 12, [1], 1.0, "rule:PHONE"), span(2, 0, "email_address", "a@b", raw.index("a@b"), len(raw), [5], 0.9, "ner:EMAIL")]
    docs = spark.createDataFrame([(1, "문의 1588-1234"), (2, raw)], "doc_id long, raw string")
    assert postprocess.checked(table(spark, rows), docs).count() == 0
    docs = spark.createDataFrame([(1, "고객센터 1588-1234"), (2, raw)], "doc_id long, raw string")
    assert [r.evidence for r in postprocess.checked(table(spark, rows), docs).collect()] == [["field:고객센터"]]


def predictions(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, view_id long, seq int, entity string, bio string, start int, stop int, text string, confidence double")


def test_ner_pieces_merge(spark):
    rows = [(1, 1, 0, "SURNAME", "B", 0, 1, "김", 0.9), (1, 1, 1, "GIVENNAME", "B", 1, 3, "철수", 0.88), (1, 1, 2, "EMAIL", "B", 5, 8, "a@b", 0.9), (1, 1, 3, "EMAIL", "B", 8, 11, ".co", 0.9), (1, 1, 4, "STREET", "B", 20, 22, "로1", 0.9), (1, 1, 5, "SURNAME", "B", 30, 31, "이", 0.99), (1, 1, 6, "TIME", "B", 40, 42, "12", 0.5)]
    out = sorted((r.category, r.entities, r.start, r.stop, round(r.confidence, 4)) for r in ner.detections(ner.judged(predictions(spark, rows))).collect())
    assert out == [("email_address", ["EMAIL"], 5, 8, 0.9), ("email_address", ["EMAIL"], 8, 11, 0.9), ("person_name", ["SURNAME", "GIVENNAME"], 0, 3, 0.89)]
    assert ner.enabled("semantic") == ner.SEMANTIC and ner.enabled("semantic", ("TIME",)) == ("TIME",) and len(ner.LABELS) == 37
    trace = {r.seq: (r.threshold, r.passed) for r in ner.judged(predictions(spark, rows), delta=-0.5).collect()}
    assert trace[6] == (0.4, True) and len(trace) == 7


def response(**changes):
    words = [{"boundingBox": {"x1": 1, "y1": 2, "x2": 5, "y2": 9}, "inferText": "hi", "inferConfidence": 0.9}] * 2 + [{"boundingBox": {"x1": 9, "y1": 2, "x2": 5, "y2": 9}, "inferText": "bad", "inferConfidence": 0.9}]
    return {"resultCode": "0000", "formResult": {"fieldResults": [{"displayName": "full_text", "value": "hi"}, {"fieldId": 802, "value": words}, {"fieldId": "800", "koiOcrResult": {}}]}} | changes


def test_ocr_files(spark, tmp_path):
    (tmp_path / "a_results.json").write_text(json.dumps({"x/1.png": response(), "x/2.png": response(resultCode="1"), "x/3.png": response(error="no"), "x/4.png": "text", "x/5.png": response(formResult={})}))
    (tmp_path / "other.json").write_text("{}")
    out = {r.image: r for r in ocr.parse(ocr.read(spark, str(tmp_path))).collect()}
    assert {k: r.status for k, r in out.items()} == {"x/1.png": "ok", "x/2.png": "failed", "x/3.png": "failed", "x/4.png": "malformed", "x/5.png": "malformed"}
    good = out["x/1.png"]
    assert [t.text for t in good.tokens] == ["hi"] and good.inverted == 1 and good.edge == 960
    with pytest.raises(Exception, match="x/5.png"):
        ocr.required(ocr.parse(ocr.read(spark, str(tmp_path))), skip_failed=True).collect()
    (tmp_path / "a_results.json").write_text(json.dumps({"x/1.png": response(), "x/2.png": response(resultCode="1")}))
    assert ocr.required(ocr.parse(ocr.read(spark, str(tmp_path))), skip_failed=True).count() == 1
    with pytest.raises(Exception, match="x/2.png"):
        ocr.required(ocr.parse(ocr.read(spark, str(tmp_path)))).collect()


def test_paths_and_images(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (640).to_bytes(4, "big") + (480).to_bytes(4, "big")
    jpg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + (48).to_bytes(2, "big") + (64).to_bytes(2, "big") + b"\0" * 9
    assert ocr.header_size(png) == (640, 480) and ocr.header_size(jpg) == (64, 48) and ocr.header_size(b"GIF89a") == (None, None)
    (tmp_path / "a.png").write_bytes(png)
    assert [(r.width, r.height) for r in ocr.image_sizes(spark, str(tmp_path)).collect()] == [(640, 480)]
    images = spark.createDataFrame([("p/a.png",), ("q/b.png",)], "image string")
    files = spark.createDataFrame([("/root2/a.png",), ("/other/b.png",)], "path string")
    assert {r.image: r.path for r in ocr.resolve(images, files, ["/root1", "/root2"]).collect()} == {"p/a.png": "/root2/a.png", "q/b.png": "/root1/q/b.png"}


def test_texts_and_sinks(spark, tmp_path):
    raw = spark.createDataFrame([('{"id":"1","text":"a"}',), ('[{"id":"2","text":"b"},{"text":"c"}]',), ('{"items":[{"id":"4","text":"d"}]}',)], "value string")
    assert sorted((r.id, r.text) for r in texts.normalise(raw).collect()) == [("1", "a"), ("1", "c"), ("2", "b"), ("4", "d")]
    case = {"case_id": "1", "scenario": "plain", "expectation": "required", "expected_categories": ["date"], "ocr_lines": [["a", {"text": "b", "x": 3}]]}
    lines = lambda *x: spark.createDataFrame([(json.dumps(v),) for v in x] + [(" ",)], "value string")
    assert texts.cases(lines(case)).count() == 1
    for wrong in ({**case, "expected_categories": ["nothing"]}, {"case_id": "1"}):
        with pytest.raises(Exception, match="case|category"):
            texts.cases(lines(wrong)).collect()
    rows = table(spark, [span(1, 0, "date", "가", 0, 3, [1, 2], 0.9)])
    texts.write_csv(rows, str(tmp_path / "csv"))
    texts.write_json(rows, str(tmp_path / "json"))
    header = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "csv").glob("*.csv")))  # the rows may be in any part
    assert header.startswith("﻿doc_id") and "1|2" in header
    found = json.loads(next(p for p in (tmp_path / "json").iterdir() if p.suffix == ".txt").read_text(encoding="utf-8"))
    assert found["count"] == 1 and found["detections"][0]["text"] == "가"


def test_masking(spark):
    docs = spark.createDataFrame([(1, "abcdefghij"), (2, "né"), (3, None)], "doc_id long, text string")
    s = spark.createDataFrame([(1, 1, 4), (1, 3, 6), (1, 8, 99), (1, 1, 4)], "doc_id long, raw_start int, raw_end int")
    assert {r.doc_id: r.masked for r in masking.mask_text(docs, s).collect()}[2] == "né"
    assert {r.doc_id: r.masked for r in masking.mask_text(docs, s).collect()}[1] == "a*****gh**"
    boxes = spark.createDataFrame([(1, 0, [(0, 0, 10, 10), (95, 95, 100, 100)]), (1, 1, [(0, 0, 10, 10)])], "doc_id long, seq int, boxes array<struct<x1:int,y1:int,x2:int,y2:int>>")
    drawn = masking.rectangles(boxes, spark.createDataFrame([(1, 100, 100)], "doc_id long, width int, height int"))
    assert [tuple(r) for r in drawn.orderBy("n").collect()] == [(1, 0, 0, 0, 12, 12), (1, 1, 93, 93, 99, 99)]
    image = spark.createDataFrame([(1, 100, 100, b"\xff" * 30000)], "doc_id long, width int, height int, rgb binary")
    assert masking.paint(image, drawn).first().rgb.count(b"\0") == 3 * (13 * 13 + 7 * 7)


def test_streams_match_batches(spark, tmp_path):
    from veilgrid.streaming.detect import counts, once, stream_matches

    rows = [(1, "2026-01-01 00:00:01", "mail a@b.co"), (1, "2026-01-01 00:00:02", "mail a@b.co"), (2, "2026-01-01 00:00:30", "1.2.3.4 and c@d.eu")]
    spark.createDataFrame(rows, "doc_id long, ts string, text string").select("doc_id", F.to_timestamp("ts").alias("ts"), "text").write.parquet(str(tmp_path / "in"))
    schema = "doc_id long, ts timestamp, text string"
    kinds = ["email_address", "ip_address"]
    stream = once(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "doc_id", "ts", "1 minute")
    q = stream_matches(stream, kinds, keep=("ts",)).writeStream.format("memory").queryName("found").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.doc_id, r.category, r.value) for r in spark.table("found").collect())
    assert got == [(1, "email_address", "a@b.co"), (2, "email_address", "c@d.eu"), (2, "ip_address", "1.2.3.4")]
    batch = stream_matches(spark.read.schema(schema).parquet(str(tmp_path / "in")), kinds, keep=("ts",))
    n = {(str(r.start), r.category): r.n for r in counts(batch, "ts", "1 minute", "1 minute").collect()}
    assert n == {("2026-01-01 00:00:00", "email_address"): 3, ("2026-01-01 00:00:00", "ip_address"): 1}


def test_catalogue_rules(spark):
    text = "주민등록번호 900101-1234568 여권 M12345678 https://a.example/b. 우편번호 04524 010-1234-5678 12가3456 1.2.3.4 token = \"" + "ab" * 20 + '"'
    found = {(r.label, r.value) for r in catalog.detect(spark.createDataFrame([(1, text)], "doc_id long, text string"), relaxed=True).collect()}
    assert {("RRN", "900101-1234568"), ("PASSPORT", "M12345678"), ("URL", "https://a.example/b"), ("POSTAL_CODE", "04524"), ("PHONE", "010-1234-5678"), ("VEHICLE", "12가3456"), ("IP", "1.2.3.4"), ("SECRET", "ab" * 20)} <= found
    names = {r.category for r in catalog.catalogue(spark).collect()}
    assert len(names) == 32


def number(front, tail):
    d = [int(c) for c in front + tail]
    return f"{front}-{tail}{(11 - sum(a * b for a, b in zip(d, [2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5], strict=True)) % 11) % 10}"


def test_cases_end_to_end(spark):
    """Made-up identifier cases through tokens, lines, views, rules, deduplication and the policy."""
    r, f = number("900101", "123456"), number("800215", "523456")
    cases = [
        ("plain", f"{r}", ["resident_registration_number"]), ("split_tokens", f"주민등록번호 {r[:6]} - {r[7:]}", ["resident_registration_number"]), ("foreigner", f"외국인등록번호 {f}", ["foreigner_registration_number"]),
        ("full_width", "".join(chr(ord(c) + 0xFEE0) if c.isdigit() else c for c in r), ["resident_registration_number"]), ("duplicate_separator", r.replace("-", "--"), ["resident_registration_number"]),
        ("confusion", r.replace("0", "O", 1), ["resident_registration_number"]), ("passport", "여권번호 M12345678", ["passport_number"]), ("licence", "운전면허 11-12-345678-90", ["driver_license_number"]),
        ("wrong_prefix", "QX12345678", []), ("long_run", f"9{r.replace('-', '')}9", []), ("bad_date", "901301-1234567", []), ("unanchored", "111234567890", []),
    ]
    docs = text_docs(spark, [(i, t) for i, (_, t, _) in enumerate(cases)])
    done = detect.run(docs, policy.preset(4), None, "2026-01-01")
    found = done.final.select(F.col("doc_id").cast("string").alias("case_id"), F.col("entity_type").alias("category"))
    table_ = spark.createDataFrame([(str(i), n, "required", want, None) for i, (n, _, want) in enumerate(cases)], "case_id string, scenario string, expectation string, expected_categories array<string>, expected_categories_checksum_off array<string>")
    scored = evaluate.results(table_, found).collect()
    assert {x.scenario: x.detected for x in scored if not x.passed and x.scenario != "bad_date"} == {}
