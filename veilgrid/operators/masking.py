"""What a policy's final spans do to texts and images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def masked(text: Column, ranges: Column, sign: str = "*") -> Column:
    """A text of the same length with ``array<struct<start,stop>>`` replaced; ranges that overlap are masked once.

    With the matches of the same row this needs no shuffle.
    """

    def step(acc: Column, r: Column) -> Column:
        start = F.greatest(r["start"].cast("int"), acc["at"])
        stop = F.greatest(r["stop"].cast("int"), start)
        return F.struct(stop.alias("at"), F.concat(acc["out"], text.substr(acc["at"] + 1, start - acc["at"]), F.repeat(F.lit(sign), F.greatest(F.least(stop, F.length(text)) - start, F.lit(0)))).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(F.array_sort(ranges), begin, step, lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.greatest(F.length(text) - acc["at"], F.lit(0)))))
    return F.when(F.coalesce(F.size(ranges), F.lit(0)) == 0, text).otherwise(done)


def mask_text(docs: DataFrame, spans: DataFrame, sign: str = "*") -> DataFrame:
    """:func:`masked` for spans in a table of their own.

    ``docs`` has ``doc_id, text``; ``spans`` has ``doc_id, raw_start, raw_end``.
    """
    ranges = spans.groupBy("doc_id").agg(F.collect_set(F.struct(F.col("raw_start").alias("start"), F.col("raw_end").alias("stop"))).alias("_ranges"))
    joined = docs.join(ranges, "doc_id", "left")
    return joined.select("doc_id", masked(F.col("text"), F.col("_ranges"), sign).alias("masked"), F.coalesce(F.size("_ranges"), F.lit(0)).alias("n_spans"))


def rectangle(box: Column, padding: Column, width: Column, height: Column) -> Column:
    """A box grown by the padding and cut to the image; null when nothing is left."""
    x1, y1 = F.greatest(F.lit(0), box["x1"] - padding), F.greatest(F.lit(0), box["y1"] - padding)
    x2, y2 = F.least(width - 1, box["x2"] + padding), F.least(height - 1, box["y2"] + padding)
    return F.when((x1 <= x2) & (y1 <= y2), F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")))


def rectangles(spans: DataFrame, images: DataFrame, padding: int = 2) -> DataFrame:
    """Distinct rectangles of each document, in order of first sight: ``doc_id, n, x1, y1, x2, y2``.

    ``spans`` has ``doc_id, seq, boxes``; ``images`` has ``doc_id, width, height``.
    """
    boxes = spans.select("doc_id", "seq", F.posexplode("boxes").alias("k", "box")).groupBy("doc_id", "box").agg(F.min(F.struct("seq", "k")).alias("seen"))
    drawn = boxes.join(images, "doc_id").withColumn("r", rectangle(F.col("box"), F.lit(padding), F.col("width"), F.col("height"))).where("r is not null")
    listed = drawn.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seen", "r"))).alias("rs"))
    return listed.select("doc_id", F.posexplode("rs").alias("n", "x")).select("doc_id", "n", "x.r.*")


def of_run(final: DataFrame, images: DataFrame, padding: int = 2) -> DataFrame:
    """The rectangles of a run's final spans (``doc_id, seq, boxes``) on their images; spans without boxes, as in plain texts, draw nothing."""
    return rectangles(final.where(F.size("boxes") > 0).select("doc_id", "seq", "boxes"), images, padding)


def summary(spans: DataFrame, drawn: DataFrame) -> DataFrame:
    """Spans and rectangles drawn of each document."""
    a = spans.groupBy("doc_id").agg(F.count("*").alias("span_count"))
    b = drawn.groupBy("doc_id").agg(F.count("*").alias("box_count"))
    return a.join(b, "doc_id", "left").select("doc_id", "span_count", F.coalesce("box_count", F.lit(0)).alias("box_count"))


def output_path(image: Column, root: str = "") -> Column:
    """Where a masked image goes: folders kept below ``data/images``, no way out of the root, ``_masked`` before the suffix.

    Null for absolute paths outside the root and for paths with ``..``.
    """
    base = root.rstrip("/")
    inside = F.regexp_replace(image, "^\\Q" + base + "\\E/", "") if base else image
    inside = F.regexp_replace(inside, "^(?:\\./)?(?:data/)?images/", "")
    bad = inside.startswith("/") | inside.rlike("(?:^|/)\\.\\.(?:/|$)")
    named = F.when(inside.rlike("[^/]\\.[^./]+$"), F.regexp_replace(inside, "\\.([^./]+)$", "_masked.$1")).otherwise(F.concat(inside, F.lit("_masked")))
    return F.when(~bad, named)


def paint(images: DataFrame, drawn: DataFrame) -> DataFrame:
    """Black rectangles on raw RGB images (``doc_id, width, height, rgb``); the size must fit the bytes."""
    boxes = drawn.groupBy("doc_id").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("boxes"))

    @F.arrow_udf("binary")
    def fill(rgb, width, height, todo):
        import numpy as np
        import pyarrow as pa

        out = []
        for raw, w, h, rs in zip(rgb.to_pylist(), width.to_pylist(), height.to_pylist(), todo.to_pylist(), strict=True):
            if len(raw) != w * h * 3:
                raise ValueError("image size does not fit its pixels")
            pixels = np.frombuffer(raw, np.uint8).reshape(h, w, 3).copy()
            for r in rs or []:
                pixels[r["y1"] : r["y2"] + 1, r["x1"] : r["x2"] + 1] = 0
            out.append(pixels.tobytes())
        return pa.array(out, pa.binary())

    return images.join(boxes, "doc_id", "left").select("doc_id", "width", "height", fill("rgb", "width", "height", "boxes").alias("rgb"))
