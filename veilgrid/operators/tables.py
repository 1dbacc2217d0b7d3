"""Table fields: headers of a line joined to the values below them, by row distance and column bounds.

All on ``tokens`` rows: ``doc_id, line_id, pos, token_id, text, x1, y1, x2, y2``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilgrid.functions.labels import NEUTRAL_HEADERS, TABLE_LABELS
from veilgrid.functions.normalize import label_text

#: Fixed value: heights between a header and a value one row below.
ROW_GAP = 3


def label_table(spark: SparkSession, extra: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``label, category``; a label may have several categories. Fixed lists and the caller's own; bounded, so it is broadcast."""
    rows = [(label, c) for part in (TABLE_LABELS, extra or {}) for c, labels in part.items() for label in labels]
    return spark.createDataFrame(rows, "label string, category string").select(label_text(F.col("label")).alias("label"), "category").where("label <> ''").distinct()


def headers(tokens: DataFrame, labels: DataFrame) -> DataFrame:
    """Headers of each line: up to four tokens that make a label, the longest first, none inside another.

    A line counts as a header line with two of them, or one and a neutral header such as a sequence number.
    """
    order = Window.partitionBy("doc_id", "line_id").orderBy("pos")
    ahead = tokens.withColumn("_next", F.collect_list(F.struct("text", "x1", "y1", "x2", "y2")).over(order.rowsBetween(0, 3)))
    parts = ahead.select("doc_id", "line_id", F.col("pos").alias("first"), "_next", F.explode(F.sequence(F.lit(1), F.size("_next"))).alias("n"))
    parts = parts.withColumn("label", label_text(F.array_join(F.transform(F.slice("_next", F.lit(1), F.col("n")), lambda t: t["text"]), ""))).where("label <> ''")
    known = labels.groupBy("label").agg(F.sort_array(F.collect_set("category")).alias("categories"))
    hits = parts.join(F.broadcast(known), "label")
    longest = Window.partitionBy("doc_id", "line_id", "first").orderBy(F.desc("n"))
    hits = hits.withColumn("_k", F.row_number().over(longest)).where("_k = 1").drop("_k")
    # left to right, a header starts at or behind the end of the last one taken
    item = F.struct("first", "n", "label", "categories", F.slice("_next", F.lit(1), F.col("n")).alias("t"))
    lines = hits.groupBy("doc_id", "line_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.filter(F.col("items"), lambda x: F.lit(False))
    taken = F.aggregate("items", none, lambda acc, x: F.when((F.size(acc) == 0) | (x["first"] >= F.element_at(acc, -1)["first"] + F.element_at(acc, -1)["n"]), F.concat(acc, F.array(x))).otherwise(acc))
    neutral = tokens.where(label_text(F.col("text")).isin(*NEUTRAL_HEADERS)).groupBy("doc_id", "line_id").agg(F.count("*").alias("neutral"))
    lines = lines.withColumn("items", taken).join(neutral, ["doc_id", "line_id"], "left").where((F.size("items") >= 2) | (F.coalesce("neutral", F.lit(0)) > 0))
    flat = lines.select("doc_id", "line_id", F.explode("items").alias("h"))
    t = F.col("h.t")
    low, high = (lambda k: F.array_min(F.transform(t, lambda x: x[k]))), (lambda k: F.array_max(F.transform(t, lambda x: x[k])))
    out = flat.select("doc_id", "line_id", F.col("h.first").alias("first"), (F.col("h.first") + F.col("h.n")).alias("past"), F.col("h.label").alias("label"), F.col("h.categories").alias("categories"), ((low("x1") + high("x2")) / 2).alias("center"), F.greatest(F.lit(1), high("y2") - low("y1")).alias("height"), high("y2").alias("bottom"))
    # columns end half way to the tokens beside the header
    middle = tokens.select("doc_id", "line_id", F.col("pos").alias("_p"), ((F.col("x1") + F.col("x2")) / 2).alias("_c"))
    left = middle.select("doc_id", "line_id", (F.col("_p") + 1).alias("first"), F.col("_c").alias("_left"))
    right = middle.select("doc_id", "line_id", F.col("_p").alias("past"), F.col("_c").alias("_right"))
    out = out.join(left, ["doc_id", "line_id", "first"], "left").join(right, ["doc_id", "line_id", "past"], "left")
    return out.withColumn("left", (F.col("_left") + F.col("center")) / 2).withColumn("right", (F.col("_right") + F.col("center")) / 2).drop("_left", "_right")


def fields(tokens: DataFrame, found: DataFrame, max_lines: int = 3) -> DataFrame:
    """Values under each header: tokens whose centre is in its column, up to ``max_lines`` rows down, before the next header line."""
    stops = found.select("doc_id", F.col("line_id").alias("stop")).distinct()
    h = found.withColumn("_h", F.struct("line_id", "first")).alias("h")
    below = h.join(stops.alias("s"), (F.col("h.doc_id") == F.col("s.doc_id")) & (F.col("s.stop") > F.col("h.line_id")), "left").groupBy("h.doc_id", "h._h").agg(F.min("s.stop").alias("stop")).withColumnRenamed("_h", "_k")
    limited = found.withColumn("_k", F.struct("line_id", "first")).join(below, ["doc_id", "_k"]).drop("_k")
    top = tokens.groupBy("doc_id", "line_id").agg(F.min("y1").alias("top"))
    v = tokens.join(top, ["doc_id", "line_id"]).select(F.col("doc_id").alias("d"), F.col("line_id").alias("value_line"), "pos", "token_id", "text", "top", ((F.col("x1") + F.col("x2")) / 2).alias("c"))
    far = F.col("value_line") - F.col("line_id")
    cond = (F.col("doc_id") == F.col("d")) & (far >= 1) & (far <= max_lines) & (F.col("stop").isNull() | (F.col("value_line") < F.col("stop"))) & (F.col("top") - F.col("bottom") <= F.col("height") * ROW_GAP * far) & (F.col("left").isNull() | (F.col("c") >= F.col("left"))) & (F.col("right").isNull() | (F.col("c") <= F.col("right")))
    return limited.join(v, cond).groupBy("doc_id", "line_id", "first", "label", "categories", "value_line").agg(F.array_sort(F.collect_list(F.struct("pos", "token_id", "text"))).alias("values"))


def field_texts(joined: DataFrame) -> DataFrame:
    """``label:`` and the values below as a text, spaced and joined: what searches for a field's category run on."""
    words = F.transform("values", lambda v: v["text"])
    return joined.select("doc_id", "line_id", "value_line", "label", "categories", F.concat_ws("\n", F.concat("label", F.lit(":")), F.array_join(words, " ")).alias("spaced"), F.concat_ws("\n", F.concat("label", F.lit(":")), F.array_join(words, "")).alias("compact"), F.transform("values", lambda v: v["token_id"]).alias("token_ids"))
