"""From matches to final spans: mapping, containment, fragments, places and overlaps.

Columns of a span table: ``doc_id, seq`` (order of arrival), ``entity_type, text, normalized_text, raw_start, raw_end,
token_ids, line_ids, boxes, detector_confidence, ocr_confidence, rule_id, review_required, risk_level, evidence``. Steps only use the
columns they need and carry all others along. Everything is partitioned by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilgrid.functions.labels import PRIORITY



def priority(entity: Column) -> Column:
    """The category's rank at a contested place; 0 for those without one."""
    pairs = [F.lit(x) for kv in PRIORITY.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), entity), F.lit(0))


def rank(entity: Column, confidence: Column, start: Column, end: Column) -> Column:
    """What decides between spans: confidence, then category, then length."""
    return F.struct(F.coalesce(confidence, F.lit(0.0)).alias("c"), priority(entity).alias("p"), (end - start).alias("n"))


def map_span(view_raw: Column, view_token: Column, start: Column, stop: Column) -> Column:
    """Place and tokens of a match by the maps of its view; null where it covers no original character."""
    raw = F.filter(F.slice(view_raw, start + 1, stop - start), lambda x: x.isNotNull())
    tokens = F.array_distinct(F.filter(F.slice(view_token, start + 1, stop - start), lambda x: x.isNotNull()))
    ok = (start >= 0) & (stop > start) & (stop <= F.size(view_raw)) & (F.size(raw) > 0) & (F.size(tokens) > 0)
    return F.when(ok, F.struct(F.array_min(raw).alias("raw_start"), (F.array_max(raw) + 1).alias("raw_end"), tokens.alias("token_ids")))


def drop_repeated(spans: DataFrame) -> DataFrame:
    """The first of each (type, place, rule)."""
    w = Window.partitionBy("doc_id", "entity_type", "raw_start", "raw_end", "rule_id").orderBy("seq")
    return spans.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def drop_contained(spans: DataFrame) -> DataFrame:
    """Spans inside an earlier span of their type go, even when they scored higher.

    In order of start (longest first) a span is inside some kept one exactly when an earlier end reaches its own.
    """
    order = Window.partitionBy("doc_id", "entity_type").orderBy("raw_start", F.desc("raw_end"), F.desc("detector_confidence"), "seq")
    reach = F.max("raw_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("_reach", reach).where("_reach is null or _reach < raw_end").drop("_reach")


def merge_fragments(spans: DataFrame) -> DataFrame:
    """Spans of one type on the very same tokens become one.

    Texts join in order of start without what lies between, both confidences are the greatest, and
    the rest is the first span's. Spans without tokens stay apart.
    """
    others = [c for c in spans.columns if c not in ("doc_id", "token_ids", "entity_type", "text", "normalized_text", "raw_start", "raw_end", "detector_confidence", "ocr_confidence")]
    alone = F.when(F.size("token_ids") == 0, F.col("seq"))
    order = F.struct("raw_start", "seq")
    parts = F.array_sort(F.collect_list(F.struct("raw_start", "seq", "text", "normalized_text")))
    grouped = spans.withColumn("_alone", alone).groupBy("doc_id", "token_ids", "entity_type", "_alone").agg(
        F.array_join(F.transform(parts, lambda x: F.coalesce(x["text"], F.lit(""))), "").alias("text"),
        F.array_join(F.transform(parts, lambda x: F.coalesce(x["normalized_text"], F.lit(""))), "").alias("normalized_text"),
        F.min("raw_start").alias("raw_start"),
        F.max("raw_end").alias("raw_end"),
        F.max(F.coalesce("detector_confidence", F.lit(0.0))).alias("detector_confidence"),
        F.max(F.coalesce("ocr_confidence", F.lit(0.0))).alias("ocr_confidence"),
        F.min_by(F.struct(*others), order).alias("_first"),
    )
    return grouped.select(*(F.col(f"_first.{c}").alias(c) if c in others else F.col(c) for c in spans.columns))


def resolve_places(spans: DataFrame) -> DataFrame:
    """One span for each place and tokens: the highest rank, the first on ties."""
    best = F.struct(rank(F.col("entity_type"), F.col("detector_confidence"), F.col("raw_start"), F.col("raw_end")).alias("r"), (-F.col("seq")).alias("s"))
    rows = spans.groupBy("doc_id", "raw_start", "raw_end", "token_ids").agg(F.max_by(F.struct(*spans.columns), best).alias("_best"))
    return rows.select("_best.*")


def resolve_overlaps(spans: DataFrame) -> DataFrame:
    """Left to right, a span that overlaps the last kept one takes its place only with a higher rank.

    What was replaced does not come back, so this is a fold over a document's spans, not a window.
    """
    ranked = spans.withColumn("_rank", rank(F.col("entity_type"), F.col("detector_confidence"), F.col("raw_start"), F.col("raw_end")))
    item = F.struct("raw_start", "raw_end", "seq", "_rank", F.struct(*spans.columns).alias("span"))
    docs = ranked.groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.filter(F.col("items"), lambda x: F.lit(False))

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        return (
            F.when(F.size(acc) == 0, F.array(x))
            .when(x["raw_start"] >= last["raw_end"], F.concat(acc, F.array(x)))
            .when(x["_rank"] > last["_rank"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(x)))
            .otherwise(acc)
        )

    kept = docs.select(F.explode(F.aggregate("items", none, step)).alias("x"))
    return kept.select("x.span.*")


def deduplicate(spans: DataFrame) -> DataFrame:
    """The whole chain; ``seq`` becomes the order of the final spans (start, end, type)."""
    out = resolve_overlaps(resolve_places(merge_fragments(drop_contained(drop_repeated(spans)))))
    order = Window.partitionBy("doc_id").orderBy("raw_start", "raw_end", "entity_type", "seq")
    return out.withColumn("seq", F.row_number().over(order) - 1)


def cross_line_close(a: Column, b: Column) -> Column:
    """Whether two boxes on neighbouring lines belong together: 2.5 heights down at most, and left or right edges 4 heights apart at most."""
    height = F.greatest(a["y2"] - a["y1"], b["y2"] - b["y1"], F.lit(1))
    return (b["y1"] - a["y2"] <= height * 2.5) & (F.least(F.abs(b["x1"] - a["x1"]), F.abs(b["x2"] - a["x2"])) <= height * 4)


def hull(boxes: Column) -> Column:
    """The box round some boxes; null for none."""
    edge = lambda k, f: f(F.transform(boxes, lambda b: b[k]))
    return F.when(F.size(boxes) > 0, F.struct(edge("x1", F.array_min).alias("x1"), edge("y1", F.array_min).alias("y1"), edge("x2", F.array_max).alias("x2"), edge("y2", F.array_max).alias("y2")))


def source(rule_id: Column) -> Column:
    """What found a span: a rule, the surroundings, the model, or another provider by its name."""
    return F.when(rule_id.startswith("rule:"), "rule").when(rule_id.startswith("context:"), "context").when(rule_id.startswith("ner:"), "model").otherwise(F.regexp_extract(rule_id, "^([^:]*)", 1))


def low_confidence(tokens: DataFrame, least: float = 0.8) -> DataFrame:
    """Tokens (``doc_id, tokens``) that recognition was less sure of than ``least``: what to look at before trusting a result."""
    return tokens.select("doc_id", F.explode(F.filter("tokens", lambda t: t["confidence"] < least)).alias("t")).select("doc_id", "t.token_id", "t.text", "t.confidence")


def trace(matches: DataFrame, final: DataFrame) -> DataFrame:
    """What became of each raw match: kept, or lost to deduplication, or never mapped."""
    key = lambda t: F.array_sort(t)
    kept = final.select("doc_id", F.col("entity_type"), key(F.col("token_ids")).alias("_tokens"), F.lit(True).alias("_kept")).distinct()
    left = matches.withColumn("_tokens", key(F.col("token_ids")))
    joined = left.join(kept, ["doc_id", "entity_type", "_tokens"], "left")
    outcome = F.when(F.col("token_ids").isNull() | (F.size("token_ids") == 0), "unmapped").when(F.col("_kept"), "kept").otherwise("deduplicated")
    return joined.withColumn("outcome", outcome).drop("_tokens", "_kept")
