"""Tokens, boxes, lines and the places of characters.

A document is one row with its tokens nested: ``tokens: array<struct<token_id,text,confidence,x1,y1,x2,y2>>``, so lines
and indexes need no shuffle. ``synthetic`` lays plain text out by a fixed rule, for texts without OCR.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The server's long edge for plain and for table OCR, and the share of overlap that makes a line.
GENERAL_EDGE, TABLE_EDGE = 1280, 960
OVERLAP = 0.6

TOKEN = "struct<token_id:int,text:string,confidence:double,x1:int,y1:int,x2:int,y2:int>"

#: Fixed values of the synthetic layout: margins, line step, height, width of a character and its least, gap.
LEFT, TOP, STEP, HEIGHT, CHAR, LEAST, GAP = 30, 30, 48, 26, 15, 14, 14


def synthetic(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tokens`` laid out line by line: words from the left margin, their width by their length."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)

    def line(x: Column, n: Column) -> Column:
        words = F.filter(F.split(x, "[ \\t\\r]+", -1), lambda w: w != "")
        width = lambda w: F.greatest(F.lit(LEAST), F.length(w) * CHAR)

        def add(acc: Column, w: Column) -> Column:
            item = F.struct(w.alias("text"), acc["x"].alias("x1"), (acc["x"] + width(w)).alias("x2"), (n * STEP + TOP).alias("y1"))
            return F.struct((acc["x"] + width(w) + GAP).alias("x"), F.concat(acc["out"], F.array(item)).alias("out"))

        none = F.from_json(F.lit("[]"), "array<struct<text:string,x1:int,x2:int,y1:int>>")
        return F.aggregate(words, F.struct(F.lit(LEFT).alias("x"), none.alias("out")), add, lambda acc: acc["out"])

    flat = F.flatten(F.transform(lines, line))
    tokens = F.transform(flat, lambda t, i: F.struct(i.alias("token_id"), t["text"].alias("text"), F.lit(0.99).alias("confidence"), t["x1"].alias("x1"), t["y1"].alias("y1"), t["x2"].alias("x2"), (t["y1"] + HEIGHT).alias("y2")))
    return df.select(F.col(id_col).alias("doc_id"), tokens.cast(f"array<{TOKEN}>").alias("tokens"))


def ocr_size(width: Column, height: Column, given_width: Column, given_height: Column, edge: Column) -> Column:
    """Size of the image the OCR saw: as told; else the long edge at ``edge`` (table OCR, always) or 1280 (only larger images)."""
    target = F.coalesce(edge, F.lit(GENERAL_EDGE))
    scale = target / F.greatest(width, height).cast("double")
    resized = F.when(height > width, F.struct(F.floor(width * scale).cast("int").alias("w"), target.cast("int").alias("h"))).otherwise(F.struct(target.cast("int").alias("w"), F.floor(height * scale).cast("int").alias("h")))
    told = (F.coalesce(given_width, F.lit(0)) > 0) & (F.coalesce(given_height, F.lit(0)) > 0)
    return (
        F.when(told, F.struct(given_width.cast("int").alias("w"), given_height.cast("int").alias("h")))
        .when(edge.isNotNull() | (F.greatest(width, height) >= target), resized)
        .otherwise(F.struct(width.cast("int").alias("w"), height.cast("int").alias("h")))
    )


def to_image(tokens: Column, width: Column, height: Column, ocr: Column) -> Column:
    """Boxes in pixels of the original: starts floored, ends raised, inside the image; a box outside the OCR image is an error."""
    sx, sy = width / ocr["w"].cast("double"), height / ocr["h"].cast("double")

    def box(t: Column) -> Column:
        outside = (t["x1"] < 0) | (t["y1"] < 0) | (t["x2"] > ocr["w"]) | (t["y2"] > ocr["h"])
        x1 = F.when(outside, F.raise_error(F.concat(F.lit("token outside the OCR image: "), t["token_id"].cast("string"))).cast("int")).otherwise(F.greatest(F.lit(0), F.floor(t["x1"] * sx)).cast("int"))
        return F.struct(t["token_id"], t["text"], t["confidence"], x1.alias("x1"), F.greatest(F.lit(0), F.floor(t["y1"] * sy)).cast("int").alias("y1"), F.least(width, F.ceil(t["x2"] * sx)).cast("int").alias("x2"), F.least(height, F.ceil(t["y2"] * sy)).cast("int").alias("y2"))

    return F.transform(tokens, box)


def outside(tokens: Column, ocr: Column) -> Column:
    """Ids of tokens outside the OCR image, for those who would rather filter than fail."""
    return F.transform(F.filter(tokens, lambda t: (t["x1"] < 0) | (t["y1"] < 0) | (t["x2"] > ocr["w"]) | (t["y2"] > ocr["h"])), lambda t: t["token_id"])


class _Group:
    """Tokens of a line in the making; its band follows from the medians of two lists that stay sorted."""

    __slots__ = ("tokens", "top", "bottom", "middles", "heights")

    def __init__(self) -> None:
        self.tokens: list[dict] = []
        self.middles: list[float] = []
        self.heights: list[int] = []

    def add(self, t: dict) -> None:
        self.tokens.append(t)
        insort(self.middles, (t["y1"] + t["y2"]) / 2)
        insort(self.heights, max(1, t["y2"] - t["y1"]))
        middle, half = _middle(self.middles), _middle(self.heights) / 2
        self.top, self.bottom = int((middle - half) // 1), int(-(-(middle + half) // 1))


def _middle(x: list) -> float:
    """The median of a sorted list."""
    n = len(x)
    return x[n // 2] if n % 2 else (x[n // 2 - 1] + x[n // 2]) / 2


def cluster(tokens: list[dict], overlap: float = OVERLAP) -> list[list[dict]]:
    """Lines of tokens: top to bottom, each token joins the line it overlaps most (0.6 of the smaller height or more).

    Tokens come by their middles, so a line that ends above all that the tallest token could still reach is not looked at again.
    """
    groups: list[_Group] = []
    near: list[_Group] = []
    tallest = max((t["y2"] - t["y1"] for t in tokens), default=0)
    for t in sorted(tokens, key=lambda t: ((t["y1"] + t["y2"]) / 2, t["x1"], t["token_id"])):
        best, most = None, 0.0
        height = max(1, t["y2"] - t["y1"])
        reach = (t["y1"] + t["y2"]) / 2 - tallest / 2
        if near and near[0].bottom < reach:
            near = [g for g in near if g.bottom >= reach]
        for g in near:
            shared = min(t["y2"], g.bottom) - max(t["y1"], g.top)
            share = max(0, shared) / min(height, max(1, g.bottom - g.top))
            if share >= overlap and share > most:
                best, most = g, share
        if best is None:
            best = _Group()
            groups.append(best)
            near.append(best)
        best.add(t)
    ordered = [sorted(g.tokens, key=lambda t: (t["x1"], t["y1"], t["token_id"])) for g in groups]
    return [g for _, _, _, g in sorted((min(t["y1"] for t in g), min(t["x1"] for t in g), i, g) for i, g in enumerate(ordered))]


LINES = f"array<struct<line_id:int,tokens:array<{TOKEN}>>>"


def with_lines(df: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """``doc_id, tokens, lines`` by vertical overlap. The medians depend on the order of tokens, hence a Python fold, in Arrow batches."""
    if not 0 < overlap <= 1:
        raise ValueError("overlap must be over 0 and at most 1")
    token = pa.struct([("token_id", pa.int32()), ("text", pa.string()), ("confidence", pa.float64()), *((k, pa.int32()) for k in ("x1", "y1", "x2", "y2"))])
    kind = pa.list_(pa.struct([("line_id", pa.int32()), ("tokens", pa.list_(token))]))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[{"line_id": i, "tokens": g} for i, g in enumerate(cluster(row or [], overlap))] for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=["doc_id", "tokens", "lines"])

    rows = df.select("doc_id", F.col("tokens").cast(f"array<{TOKEN}>").alias("tokens"))
    return rows.mapInArrow(grouped, f"doc_id {dict(df.dtypes)['doc_id']}, tokens array<{TOKEN}>, lines {LINES}")


def lines_by_top(tokens: Column) -> Column:
    """Lines of tokens that share their top edge: what clustering gives for laid-out text, in built-in functions."""
    tops = F.array_sort(F.array_distinct(F.transform(tokens, lambda t: t["y1"])))
    own = lambda y: F.transform(F.array_sort(F.transform(F.filter(tokens, lambda t: t["y1"] == y), lambda t: F.struct(t["x1"].alias("k"), t["token_id"].alias("i"), t.alias("t")))), lambda s: s["t"])
    return F.transform(tops, lambda y, n: F.struct(n.alias("line_id"), own(y).alias("tokens"))).cast(LINES)


def line_text(line: Column) -> Column:
    return F.array_join(F.transform(line["tokens"], lambda t: t["text"]), " ")


def placed_lines(df: DataFrame, lines_col: str = "lines") -> DataFrame:
    """One row a line: ``doc_id, line_id, text, raw_offset, tokens`` where lines join by a newline in the document's text."""
    texts = F.transform(lines_col, line_text)
    starts = F.aggregate(texts, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x) + 1)))
    zipped = F.arrays_zip(F.col(lines_col).alias("line"), texts.alias("text"), F.slice(starts, 1, F.size(lines_col)).alias("raw_offset"))
    return df.select("doc_id", F.explode(zipped).alias("z")).select("doc_id", F.col("z.line.line_id").alias("line_id"), F.col("z.text").alias("text"), F.col("z.raw_offset").alias("raw_offset"), F.col("z.line.tokens").alias("tokens"))


def raw_text(lines_col: str = "lines") -> Column:
    return F.array_join(F.transform(lines_col, line_text), "\n")


def token_intervals(lines_df: DataFrame) -> DataFrame:
    """``doc_id, line_id, token_id, text, raw_start, raw_end`` from :func:`placed_lines`."""
    ends = F.aggregate(F.transform("tokens", lambda t: F.length(t["text"])), F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n + 1)))
    z = F.arrays_zip(F.col("tokens").alias("t"), F.slice(ends, 1, F.size("tokens")).alias("o"))
    return lines_df.select("doc_id", "line_id", "raw_offset", F.explode(z).alias("z")).select("doc_id", "line_id", F.col("z.t.token_id").alias("token_id"), F.col("z.t.text").alias("text"), (F.col("raw_offset") + F.col("z.o")).alias("raw_start"), (F.col("raw_offset") + F.col("z.o") + F.length("z.t.text")).alias("raw_end"))


def tokens_of(matches: DataFrame, intervals: DataFrame) -> DataFrame:
    """Each match (``doc_id, raw_start, raw_end``) with the tokens whose characters it meets, in reading order."""
    m, t = matches.distinct().alias("m"), intervals.alias("t")
    hit = (F.col("m.doc_id") == F.col("t.doc_id")) & (F.col("t.raw_start") < F.col("m.raw_end")) & (F.col("m.raw_start") < F.col("t.raw_end"))
    own = [F.col(f"m.`{c}`").alias(c) for c in matches.columns]  # the row itself is the key: a number given to it could change when a task runs again
    met = m.join(t, hit).select(*own, F.struct("t.raw_start", "t.token_id").alias("_at"))
    ids = met.groupBy(*matches.columns).agg(F.array_sort(F.collect_list("_at")).alias("_t")).withColumn("token_ids", F.transform("_t", lambda x: x["token_id"])).drop("_t")
    a, b = matches.alias("a"), ids.alias("b")
    same = F.lit(True)
    for c in matches.columns:
        same = same & F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`"))
    return a.join(b, same, "left").select(*(F.col(f"a.`{c}`").alias(c) for c in matches.columns), F.col("b.token_ids").alias("token_ids"))
