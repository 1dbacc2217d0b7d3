"""Plain texts, evaluation cases, and the sinks of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilgrid.functions.labels import CATEGORIES

CASE = "case_id string, scenario string, expectation string, expected_categories array<string>, expected_categories_checksum_off array<string>, ocr_lines variant, description string, synthetic boolean"


def normalise(raw: DataFrame) -> DataFrame:
    """``id, text`` from JSON texts (``value``) of three shapes: an object, an array of objects, or ``{items: [...]}``."""
    item = "struct<id:string,text:string>"
    v = F.col("value")
    listed = F.from_json(v, f"struct<items:array<{item}>>")["items"]
    rows = F.when(v.rlike("^\\s*\\["), F.from_json(v, f"array<{item}>")).when(listed.isNotNull(), listed).otherwise(F.array(F.from_json(v, item)))
    return raw.select(F.posexplode(rows).alias("n", "x")).select(F.coalesce("x.id", F.col("n").cast("string")).alias("id"), "x.text").where("text is not null")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    return normalise(spark.read.option("wholetext", True).text(path))


def cases(raw: DataFrame) -> DataFrame:
    """Evaluation cases from JSON lines (``value``): blank lines are skipped; a missing key or unknown category is an error."""
    rows = raw.where(F.trim("value") != "").select("value", F.from_json("value", CASE).alias("c"))
    missing = F.col("c").isNull() | F.col("c.case_id").isNull() | F.col("c.scenario").isNull() | F.col("c.expectation").isNull() | F.col("c.expected_categories").isNull() | F.col("c.ocr_lines").isNull()
    unknown = F.size(F.array_except("c.expected_categories", F.array(*map(F.lit, CATEGORIES)))) > 0
    problem = F.when(missing, F.concat(F.lit("incomplete case: "), F.col("value"))).when(unknown, F.concat(F.lit("unknown category in "), F.col("c.case_id")))
    return rows.select(F.when(problem.isNotNull(), F.raise_error(problem).cast("string")).otherwise(F.col("c.case_id")).alias("case_id"), "c.scenario", "c.expectation", "c.expected_categories", "c.expected_categories_checksum_off", F.to_json("c.ocr_lines").alias("ocr_lines"), "c.description", "c.synthetic")


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    return cases(spark.read.text(path))


def as_json(spans: DataFrame) -> DataFrame:
    """One JSON document for each document: its findings in order, with boxes where there are any."""
    columns = [c for c in spans.columns if c not in ("doc_id", "seq")]
    listed = spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", *columns))).alias("detections"), F.count("*").alias("count"))
    return listed.select("doc_id", F.to_json(F.struct("doc_id", "count", "detections")).alias("json"))


def write_json(spans: DataFrame, path: str) -> None:
    as_json(spans).select("json").write.text(path)


def write_csv(spans: DataFrame, path: str) -> None:
    """Scalar columns as CSV; arrays joined by a bar. A byte order mark begins the header so that spreadsheets read UTF-8."""
    flat = [F.array_join(F.col(c).cast("array<string>"), "|").alias(c) if t.startswith("array<") else F.col(c) for c, t in spans.dtypes]
    out = spans.select(*flat)
    out.toDF("﻿" + out.columns[0], *out.columns[1:]).write.option("header", True).csv(path)
