"""Whole runs, and the parts of them that plain texts do not reach: two lines, growth, boxes, models that fail."""

import json
import random
from dataclasses import replace
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilgrid.functions import offsets
from veilgrid.functions.labels import parse_field_labels
from veilgrid.operators import catalog, evaluate, layout, masking, ner, policy, postprocess, spans, structure, views
from veilgrid.plans import detect
from veilgrid.sources import documents, texts

RULES = replace(policy.preset(2), execution="rules_only")


def token(i, text, x1, y1, width=40, confidence=0.9):
    return {"token_id": i, "text": text, "confidence": confidence, "x1": x1, "y1": y1, "x2": x1 + width, "y2": y1 + 20}


def document(spark, *lines):
    """One document of given lines of tokens."""
    rows = [{"line_id": i, "tokens": x} for i, x in enumerate(lines)]
    tokens = [t for x in lines for t in x]
    return spark.createDataFrame([(1, tokens, rows)], f"doc_id long, tokens array<{layout.TOKEN}>, lines {layout.LINES}")


def found(run_or_spans):
    return {(r.entity_type, r.text) for r in run_or_spans.collect()}


def test_matches_have_their_places(spark):
    """Thousands of matches in one text, against places by definition."""
    import re

    rng = random.Random(1)
    text = "".join(rng.choice(["a1", " ", "é", "😀", "22", "b"]) for _ in range(3000))
    out = spark.createDataFrame([(text,), ("none",), (None,)], "t string").select(offsets.located(F.col("t"), "[0-9]+").alias("m")).collect()
    assert [(m.start, m.stop, m.value) for m in out[0].m] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)] and out[1].m == [] and not out[2].m


def test_values_on_the_second_line_stay(spark):
    """A label on one line and its value on the next: the whole first line is the label."""
    near = document(spark, [token(0, "주민등록번호", 30, 30, 120)], [token(1, "800110-1234561", 32, 60, 150)])
    far = document(spark, [token(0, "여권번호", 30, 30, 60)], [token(1, "M12345678", 900, 300, 150)])
    assert ("resident_registration_number", "800110-1234561") in found(detect.ocr_spans(near, RULES))
    rows = detect.ocr_spans(near, RULES).where("entity_type = 'resident_registration_number'").collect()
    assert [b.asDict() for b in rows[0].boxes] == [{"x1": 32, "y1": 60, "x2": 182, "y2": 80}] and rows[0].line_ids == [1]
    assert detect.ocr_spans(far, RULES).count() <= 1


def test_closeness_of_lines(spark):
    """2.5 heights down, and left or right edges 4 heights apart, by the boxes round all tokens."""
    rows = [((0, 0, 100, 20), (0, 70, 100, 90), True), ((0, 0, 100, 20), (0, 71, 100, 91), False), ((0, 0, 100, 20), (80, 30, 500, 50), True), ((0, 0, 100, 20), (81, 30, 500, 50), False), ((0, 0, 100, 20), (300, 30, 20, 50), True), ((0, 0, 500, 20), (200, 30, 580, 50), True)]
    box = "struct<x1:int,y1:int,x2:int,y2:int>"
    df = spark.createDataFrame(rows, f"a {box}, b {box}, want boolean")
    assert all(r.got == r.want for r in df.select(spans.cross_line_close(F.col("a"), F.col("b")).alias("got"), "want").collect())


def test_addresses_grow_in_every_column(spark):
    first = [token(0, "서울특별시", 30, 30, 80), token(1, "중구", 120, 30), token(2, "세종대로", 170, 30, 60), token(3, "110", 240, 30)]
    docs = document(spark, first, [token(4, "3층", 30, 60), token(5, "201호", 80, 60, confidence=0.5)])
    row = (1, 0, "address", "서울특별시 중구 세종대로 110", "x", 0, 16, [0, 1, 2, 3], [0], 0.8, 0.9, "rule:ADDRESS", False, 3, ["type:road"], [])
    out = postprocess.extend_addresses(spark.createDataFrame([row], detect.SPAN_TYPES), docs).collect()[0]
    text = "서울특별시 중구 세종대로 110\n3층 201호"
    assert (out.raw_start, out.raw_end, text[out.raw_start : out.raw_end]) == (0, len(text), text)
    assert out.text == text.replace("\n", " ") and out.line_ids == [0, 1] and out.token_ids == [0, 1, 2, 3, 4, 5] and out.ocr_confidence == 0.5 and len(out.boxes) == 6
    masked = masking.mask_text(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, out.raw_start, out.raw_end)], "doc_id long, raw_start int, raw_end int")).collect()[0].masked
    assert set(masked) == {"*"}


def test_repairs_only_reach_addresses_and_names(spark):
    df = spark.createDataFrame([("종로.12 1.2.3.4",), ("세종대로 .\n110",), ("성명.홍길동 a.b@c.de",), ("101,3동 x",)], "t string")
    out = df.select(structure.address_text(F.col("t")).alias("a"), structure.person_text(F.col("t")).alias("p")).collect()
    assert [r.a for r in out] == ["종로 12 1.2.3.4", "세종대로  \n110", "성명.홍길동 a.b@c.de", "101 3동 x"]
    assert [r.p for r in out] == ["종로.12 1.2.3.4", "세종대로 .\n110", "성명 홍길동 a.b@c.de", "101,3동 x"]


def test_labels_before_mixed_separators(spark):
    rows = [("계좌번호: - 123", 8, True), ("계좌번호 -: 123", 8, True), ("계좌번호x 123", 7, False), ("계 좌 번 호 : 1", 10, True)]
    df = spark.createDataFrame(rows, "t string, s int, want boolean")
    assert all(r.got == r.want for r in df.select(catalog.near_prefix(F.col("t"), F.col("s"), ["계좌번호"]).alias("got"), "want").collect())


def test_colon_windows_have_label_and_value(spark):
    docs = document(spark, [token(i, t, 30 + 60 * i, 30) for i, t in enumerate(["a", "b:", "c", "d"])])
    rows = views.colon_windows(views.ready_lines(layout.placed_lines(docs))).select(F.transform("ready", lambda t: t["text"]).alias("w")).collect()
    assert sorted(tuple(r.w) for r in rows) == [("a", "b:", "c"), ("a", "b:", "c", "d")]
    alone = document(spark, [token(0, ":", 30, 30), token(1, "x", 90, 30)], [token(2, "y", 30, 60), token(3, "z:", 90, 60)])
    assert views.colon_windows(views.ready_lines(layout.placed_lines(alone))).count() == 0


def test_lines_match_the_definition():
    """Clustering with sorted lists and dropped lines against the plain walk over all lines."""

    def plain(tokens, overlap):
        groups = []
        for t in sorted(tokens, key=lambda t: ((t["y1"] + t["y2"]) / 2, t["x1"], t["token_id"])):
            best, most = None, 0.0
            for g in groups:
                middle, half = median((x["y1"] + x["y2"]) / 2 for x in g), median(max(1, x["y2"] - x["y1"]) for x in g) / 2
                top, bottom = int((middle - half) // 1), int(-(-(middle + half) // 1))
                share = max(0, min(t["y2"], bottom) - max(t["y1"], top)) / min(max(1, t["y2"] - t["y1"]), max(1, bottom - top))
                if share >= overlap and share > most:
                    best, most = g, share
            if best is None:
                best = []
                groups.append(best)
            best.append(t)
        return sorted(sorted(t["token_id"] for t in g) for g in groups)

    rng = random.Random(2)
    for _ in range(30):
        tokens = []
        for i in range(rng.randrange(1, 80)):
            y, h = rng.randrange(0, 300), rng.choice([8, 20, 22, 25, 60])
            tokens.append({"token_id": i, "text": "t", "confidence": 1.0, "x1": rng.randrange(500), "y1": y, "x2": 600, "y2": y + h})
        assert sorted(sorted(t["token_id"] for t in g) for g in layout.cluster(tokens)) == plain(tokens, 0.6)


def test_tokens_of_repeated_matches(spark):
    docs = document(spark, [token(0, "ab", 0, 0), token(1, "cd", 50, 0)], [token(2, "ef", 0, 30)])
    at = layout.token_intervals(layout.placed_lines(docs))
    rows = spark.createDataFrame([(1, 1, 4), (1, 1, 4), (1, 6, 8), (1, 50, 60), (None, 0, 1)], "doc_id long, raw_start int, raw_end int")
    out = layout.tokens_of(rows, at).collect()
    assert sorted((r.raw_start, r.token_ids or []) for r in out) == [(0, []), (1, [0, 1]), (1, [0, 1]), (6, [2]), (50, [])]


def failing(view_rows):
    raise RuntimeError("no model here")


def test_a_failing_model_leaves_the_rules(spark):
    docs = layout.with_lines(layout.synthetic(spark.createDataFrame([(1, "연락처 010-1234-5678")], "doc_id long, text string")))
    chosen = replace(policy.preset(3), execution="both")
    with pytest.raises(RuntimeError):
        detect.run(docs, chosen, failing)
    done = detect.run(docs, chosen, failing, fall_back=True)
    assert "no model here" in done.problem and ("phone_number", "010-1234-5678") in found(done.final) and done.ner_spans.count() == 0
    written = json.loads(documents.run_document(docs, done, {"rules": 0.5}).first().json)
    assert written["problem"] == done.problem and written["seconds"] == {"rules": 0.5} and written["token_count"] == 2
    assert [f["text"] for f in written["final_findings"]] == ["010-1234-5678"] and written["final_findings"][0]["source"] == "rule" and written["model_findings"] == []
    assert written["lines"] == [{"line_id": 0, "text": "연락처 010-1234-5678"}]


def test_logits_become_predictions(spark):
    labels = ner.LABELS
    at = {x: i for i, x in enumerate(labels)}

    def load():
        def model(batch):
            out = []
            for text in batch:
                logits = np.zeros((3, len(labels)))
                logits[0, at["B-SURNAME"]] = 9.0
                logits[1, at["O"]] = 9.0
                logits[2, at["I-GIVENNAME"]] = 9.0
                out.append(([(0, 1), (1, 2), (2, 2)], logits))
            return out

        return model

    rows = spark.createDataFrame([(1, 7, "kim"), (1, 8, None)], "doc_id long, view_id long, text string")
    out = ner.logits_provider(load)(rows).collect()
    assert [(r.doc_id, r.view_id, r.entity, r.bio, r.start, r.stop, r.text) for r in out] == [(1, 7, "SURNAME", "B", 0, 1, "k")]
    assert out[0].confidence == pytest.approx(float(np.exp(9) / (np.exp(9) + len(labels) - 1)))
    assert ner.named_tokens("", [], np.zeros((0, len(labels)))) == []


def test_small_parts(spark):
    assert parse_field_labels(" a, b\nb\r\n,c ,") == ("a", "b", "c")
    df = spark.createDataFrame([("rule:X",), ("context:Y",), ("ner:A+B",), ("other:z",)], "r string")
    assert [r.s for r in df.select(spans.source(F.col("r")).alias("s")).collect()] == ["rule", "context", "model", "other"]
    docs = document(spark, [token(0, "a", 0, 0, confidence=0.5), token(1, "b", 50, 0)])
    assert [(r.token_id, r.text) for r in spans.low_confidence(docs).collect()] == [(0, "a")]


def test_cases_are_written_and_read(spark, tmp_path):
    rows = documents.cases(spark, 2)
    documents.write_cases(rows, str(tmp_path / "cases"))
    back = texts.read_cases(spark, str(tmp_path / "cases"))
    assert back.count() == rows.count() and {r.case_id for r in back.collect()} == {r.case_id for r in rows.collect()}
    scored = evaluate.results(back, rows.select("case_id", F.explode(F.filter(F.split("want", ","), lambda x: x != "")).alias("category")))
    documents.write_evaluation(scored, str(tmp_path / "out"))
    total = json.loads(spark.read.text(str(tmp_path / "out/summary")).first().value)
    assert total["pass_rate"] == 1.0 and total["total"] == rows.count()
    assert documents.failures(scored).count() == 0


def test_intermediate_tables_are_cleared(spark):
    from veilgrid import session

    df = session.kept(spark.range(5), "some")
    path = df.inputFiles()[0]
    session.remove(spark, path.rsplit("/", 1)[0])
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
