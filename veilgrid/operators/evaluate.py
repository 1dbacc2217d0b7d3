"""Evaluation of detections against cases, and counts by category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDENTIFIERS = ("resident_registration_number", "foreigner_registration_number", "passport_number", "driver_license_number")


def category_counts(matches: DataFrame) -> DataFrame:
    """Findings and documents of each category."""
    return matches.groupBy("category").agg(F.count("*").alias("n_matches"), F.countDistinct("doc_id").alias("n_docs"))


def results(cases: DataFrame, detected: DataFrame, checksum: bool = True) -> DataFrame:
    """Each case with the categories found and whether they are the expected ones; known limits are not scored.

    ``cases``: case_id, scenario, expectation, expected_categories, expected_categories_checksum_off; ``detected``: case_id, category.
    """
    want = F.col("expected_categories") if checksum else F.coalesce("expected_categories_checksum_off", "expected_categories")
    found = detected.where(F.col("category").isin(*IDENTIFIERS)).groupBy("case_id").agg(F.array_sort(F.collect_set("category")).alias("detected"))
    rows = cases.join(found, "case_id", "left").withColumn("expected", F.array_sort(F.array_distinct(want))).withColumn("detected", F.coalesce("detected", F.array().cast("array<string>")))
    passed = F.when(F.col("expectation") == "required", F.col("expected") == F.col("detected"))
    return rows.select("case_id", "scenario", "expectation", "expected", "detected", passed.alias("passed"))


def summary(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Totals, scored, passed and the pass rate to four places; by strictness, scenario or whatever columns are named."""
    n, ok = F.count("passed"), F.count_if("passed")
    positive = F.size("expected") > 0
    aggs = [
        F.count("*").alias("total"), n.alias("scored"), ok.alias("passed_cases"), F.when(n > 0, F.round(ok / n, 4)).alias("pass_rate"),
        F.count_if(positive & F.col("passed").isNotNull()).alias("positives"), F.count_if(positive & F.col("passed")).alias("positives_passed"),
        F.count_if(~positive & F.col("passed").isNotNull()).alias("negatives"), F.count_if(~positive & F.col("passed")).alias("negatives_passed"),
    ]
    return scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)


def by_category(scored: DataFrame) -> DataFrame:
    """How often each category was expected, found where expected, and found where not."""
    rows = scored.where("passed is not null")
    want = rows.select("case_id", F.explode("expected").alias("category"), F.lit(1).alias("w"))
    got = rows.select("case_id", F.explode("detected").alias("category"), F.lit(1).alias("g"))
    both = want.join(got, ["case_id", "category"], "full")
    return both.groupBy("category").agg(F.count("w").alias("expected"), F.count_if(F.col("w").isNotNull() & F.col("g").isNotNull()).alias("detected"), F.count_if(F.col("w").isNull()).alias("unexpected"))
