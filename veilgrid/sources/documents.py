"""The document of a run, evaluation cases made by rule, and the evaluator's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilgrid.functions.identifiers import CORPORATE_WEIGHTS, RESIDENT_WEIGHTS
from veilgrid.operators import evaluate, masking, spans
from veilgrid.operators.layout import line_text

FINDING = ("seq", "entity_type", "text", "token_ids", "boxes", "ocr_confidence", "detector_confidence", "rule_id", "review_required")


def run_document(docs: DataFrame, run, seconds: dict[str, float] | None = None, masked: DataFrame | None = None) -> DataFrame:
    """``doc_id, json``: a document for each input document (``doc_id, tokens, lines``, and ``image``, ``scale_x``, ``scale_y`` where known).

    It has the scale, tokens, lines, the findings of the rules, of the model and of both after the policy, what
    recognition was unsure of, the seconds of each stage, and the masked image's path (``masked``: ``doc_id, path``).
    """
    out = docs

    def listed(rows: DataFrame, name: str) -> DataFrame:
        item = F.struct(*FINDING, spans.source(F.col("rule_id")).alias("source"))
        return rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias(name))

    for name, rows in (("rule_findings", run.rule_spans), ("model_findings", run.ner_spans), ("final_findings", run.final)):
        out = out.join(listed(rows, name), "doc_id", "left")
    if masked is not None:
        out = out.join(masked.select("doc_id", F.col("path").alias("masked_image")), "doc_id", "left")
    own = [F.col(c) for c in ("image", "scale_x", "scale_y", "masked_image") if c in out.columns]
    empty = lambda c: F.when(F.col(c).isNull(), F.from_json(F.lit("[]"), out.schema[c].dataType)).otherwise(F.col(c)).alias(c)
    unsure = F.transform(F.filter("tokens", lambda t: t["confidence"] < 0.8), lambda t: t["token_id"])
    times = [F.struct(*(F.lit(float(v)).alias(k) for k, v in seconds.items())).alias("seconds")] if seconds else []
    lines = F.transform("lines", lambda x: F.struct(x["line_id"].alias("line_id"), line_text(x).alias("text"))).alias("lines")
    whole = F.struct("doc_id", *own, F.size("tokens").alias("token_count"), lines, *map(empty, ("rule_findings", "model_findings", "final_findings")), unsure.alias("low_confidence_tokens"), *times, F.lit(run.problem).alias("problem"))
    return out.select("doc_id", F.to_json(whole, {"ignoreNullFields": "false"}).alias("json"))


def write_run(docs: DataFrame, run, path: str, seconds: dict[str, float] | None = None, images: DataFrame | None = None) -> None:
    """The documents of a run as JSON lines, and its rectangles beside them where images (``doc_id, width, height``) are given."""
    run_document(docs, run, seconds).select("json").write.text(f"{path}/documents")
    if images is not None:
        masking.of_run(run.final, images).write.json(f"{path}/rectangles")


def write_evaluation(scored: DataFrame, path: str) -> None:
    """The evaluator's files: each case, the totals, the totals by scenario, counts by category, and the first 30 failures."""
    scored.write.json(f"{path}/details")
    evaluate.summary(scored).write.json(f"{path}/summary")
    evaluate.summary(scored, ("scenario",)).write.json(f"{path}/scenarios")
    evaluate.by_category(scored).write.json(f"{path}/categories")
    failures(scored).write.json(f"{path}/failures")


def failures(scored: DataFrame, most: int = 30) -> DataFrame:
    """The first cases that failed, by id."""
    return scored.where("not passed").orderBy("case_id").limit(most)


def registration_number(front: str, seventh: str, tail: str) -> str:
    """Made up, with a right check digit."""
    digits = [int(c) for c in front + seventh + tail]
    return f"{front}-{seventh}{tail}{(11 - sum(a * b for a, b in zip(digits, RESIDENT_WEIGHTS, strict=True)) % 11) % 10}"


def corporate_number(front: str, tail: str) -> str:
    """Made up, with the check digit of a corporate number."""
    digits = [int(c) for c in front + tail]
    return f"{front}-{tail}{(10 - sum(a * b for a, b in zip(digits, CORPORATE_WEIGHTS, strict=True)) % 10) % 10}"


def apart(front: str, seventh: str, tail: str) -> str:
    """A registration number that is no corporate one as well: where both check digits fit, no rule can tell which it is."""
    while (x := registration_number(front, seventh, tail)) == corporate_number(front, seventh + tail):
        tail = f"{(int(tail) + 1) % 100_000:05d}"
    return x


RESIDENT, FOREIGNER, PASSPORT, LICENCE = evaluate.IDENTIFIERS

#: The labels of the four identifiers.
LABELS = {RESIDENT: "주민등록번호", FOREIGNER: "외국인등록번호", PASSPORT: "여권번호", LICENCE: "운전면허번호"}


def case_rows(each: int = 4) -> list[tuple[str, str, str, str, str, str]]:
    """Evaluation cases by rule: ``case_id, scenario, expectation, want, want_off, text``; ``want`` lists categories with commas.

    Identifiers of each kind (``each`` of them) behind their label, with and without a hyphen, over a line's end, with a
    day that does not exist, a digit missing, inside longer numbers or words, and all kinds in one document.
    """
    made: dict[str, list[str]] = {
        RESIDENT: [apart(f"{80 + i:02d}{1 + i % 9:02d}{10 + i % 18:02d}", str(1 + i % 2), f"{23456 + 1111 * i}"[:5]) for i in range(each)],
        FOREIGNER: [apart(f"{81 + i:02d}{1 + i % 9:02d}{11 + i % 17:02d}", str(5 + i % 2), f"{12345 + 1313 * i}"[:5]) for i in range(each)],
        PASSPORT: [("M", "S", "G")[i % 3] + f"{12345678 + 7654321 * i}"[:8] for i in range(each)],
        LICENCE: [f"{11 + i % 17}-{10 + 7 * i % 80:02d}-{123456 + 54321 * i}"[:12] + f"-{12 + i:02d}" for i in range(each)],
    }
    out: list[tuple[str, str, str, str, str, str]] = []

    def add(kind: str, scenario: str, n: int, text: str, want: str, off: str | None = None, expectation: str = "required") -> None:
        out.append((f"{scenario}-{kind}-{n}", scenario, expectation, want, want if off is None else off, text))

    for kind, numbers in made.items():
        label = LABELS[kind]
        for n, x in enumerate(numbers):
            add(kind, "labelled", n, f"{label} : {x}", kind)
            add(kind, "over_lines", n, f"{label} :\n{x}", kind)
            add(kind, "short_by_one", n, f"{label} : {x[:-1]}", kind, expectation="known_limit")
            if kind == PASSPORT:
                add(kind, "inside_word", n, f"{label} : A{x}B", "")
            if kind in (RESIDENT, FOREIGNER):
                add(kind, "inside_number", n, f"{label} : 99{x.replace('-', '')}00", "")
                add(kind, "no_hyphen", n, f"{label} : {x.replace('-', '')}", kind)
                add(kind, "bad_day", n, f"{label} : 991332-{x[7:]}", "", kind)
    for n, (a, b, c, d) in enumerate(zip(*made.values(), strict=True)):
        add("all", "several", n, "\n".join(f"{LABELS[k]} : {x}" for k, x in zip(made, (a, b, c, d), strict=True)), ",".join(sorted(made)))
    add("none", "placeholder", 0, "여권번호 : M00000000", "")
    add("none", "prefix", 0, "여권번호 : X12345678", "")
    add("none", "corporate", 0, f"법인등록번호 : {corporate_number('110111', '543210')}", "")
    return out


CASE_COLUMNS = "case_id string, scenario string, expectation string, want string, want_off string, text string"


def cases(spark: SparkSession, each: int = 4) -> DataFrame:
    """The rows of :func:`case_rows`, with a number to use as a document's id."""
    return spark.createDataFrame([(n, *r) for n, r in enumerate(case_rows(each))], "doc_id long, " + CASE_COLUMNS)


def write_cases(rows: DataFrame, path: str) -> None:
    """Cases as JSON lines that :func:`veilgrid.sources.texts.read_cases` reads."""
    split = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    lines = F.transform(F.split("text", "\n"), lambda x: F.split(x, " "))
    made = F.struct("case_id", "scenario", "expectation", split("want").alias("expected_categories"), split("want_off").alias("expected_categories_checksum_off"), lines.alias("ocr_lines"), F.col("scenario").alias("description"), F.lit(True).alias("synthetic"))
    rows.select(F.to_json(made).alias("value")).write.text(path)


def pictures(docs: DataFrame, margin: int = 30) -> DataFrame:
    """``doc_id, width, height`` of the smallest picture that holds a document's tokens, where no image tells."""
    edge = lambda k: F.coalesce(F.array_max(F.transform("tokens", lambda t: t[k])), F.lit(0)) + margin
    return docs.select("doc_id", edge("x2").alias("width"), edge("y2").alias("height"))

