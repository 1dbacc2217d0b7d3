"""OCR results: JSON files that map an image's path to a response.

Responses become rows with a status, so one bad response does not fail a job; ``required`` fails it where asked for.
The values of fields are strings or arrays, so they are parsed as variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilgrid.operators.layout import TABLE_EDGE, TOKEN

#: Names and numbers of fields, and the code of success.
FIELDS = {"full_text": "801", "word_boxes": "802", "image_width": "803", "image_height": "804"}
TABLE_FIELD = "800"
SUCCESS = "0000"
PATTERNS = ("*_results.json", "*_result.json")

RESPONSE = "struct<resultCode:string,error:string,formResult:struct<type:string,fieldResults:array<struct<fieldId:string,displayName:string,value:variant,koiOcrResult:variant>>>>"
BOX = "struct<boundingBox:struct<x1:int,y1:int,x2:int,y2:int>,inferText:string,inferConfidence:double>"


def read(spark: SparkSession, path: str) -> DataFrame:
    """``file, image, response`` (JSON text): every entry of all result files under a folder, or of one file."""
    reader = spark.read.option("wholetext", True)
    if not path.endswith(".json"):
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "{" + ",".join(PATTERNS) + "}")
    return entries(reader.text(path).select(F.col("_metadata.file_path").alias("file"), "value"))


def entries(files: DataFrame) -> DataFrame:
    """``file, image, response`` from ``file, value``; a file that is no object gives one row without an image."""
    parsed = F.from_json("value", "map<string,string>")
    return files.select("file", F.explode_outer(parsed).alias("image", "response"))


def field(results: Column, name: str) -> Column:
    """A field's value by its name, else by its number; null where there is none."""
    by = lambda key, value: F.get(F.filter(results, lambda f: f[key] == value), F.lit(0))["value"]
    return F.coalesce(by("displayName", name), by("fieldId", FIELDS[name]))


def _int(v: Column) -> Column:
    return F.try_variant_get(v, "$", "int")


def parse(raw: DataFrame) -> DataFrame:
    """``file, image, status, problem, form_type, full_text, tokens, given_width, given_height, edge, inverted``.

    ``status`` is ok, failed (the server says so) or malformed. Boxes whose corners are swapped are dropped and
    counted; of equal boxes with equal text the first stays; ids number what is left.
    """
    r = F.from_json("response", RESPONSE)
    rows = raw.withColumn("r", r).withColumn("results", F.col("r.formResult.fieldResults"))
    text, boxes = field(F.col("results"), "full_text"), field(F.col("results"), "word_boxes")
    rows = rows.withColumn("full_text", F.try_variant_get(text, "$", "string")).withColumn("boxes", F.try_variant_get(boxes, "$", f"array<{BOX}>"))
    for name in ("image_width", "image_height"):
        rows = rows.withColumn(name, _int(field(F.col("results"), name)))
    incomplete = F.exists("boxes", lambda b: b["boundingBox"].isNull() | b["inferText"].isNull() | b["inferConfidence"].isNull() | b["boundingBox"]["x1"].isNull() | b["boundingBox"]["y1"].isNull() | b["boundingBox"]["x2"].isNull() | b["boundingBox"]["y2"].isNull())
    problem = (
        F.when(F.col("image").isNull(), "not an object")
        .when(F.col("r").isNull() | ~F.coalesce(F.col("response").rlike("^\\s*\\{"), F.lit(False)), "response is not an object")
        .when(F.col("r.error").isNotNull(), F.concat(F.lit("error: "), F.col("r.error")))
        .when(F.coalesce(F.col("r.resultCode"), F.lit("")) != SUCCESS, F.concat(F.lit("result code: "), F.coalesce(F.col("r.resultCode"), F.lit("none"))))
        .when(F.col("results").isNull(), "no field results")
        .when(F.col("full_text").isNull(), "no full_text")
        .when(F.col("boxes").isNull(), "no word_boxes")
        .when(incomplete, "incomplete word box")
    )
    rows = rows.withColumn("problem", problem)
    failed = F.col("problem").startswith("error: ") | F.col("problem").startswith("result code: ")
    status = F.when(F.col("problem").isNull(), "ok").when(failed, "failed").otherwise("malformed")
    good = F.filter("boxes", lambda b: (b["boundingBox"]["x1"] <= b["boundingBox"]["x2"]) & (b["boundingBox"]["y1"] <= b["boundingBox"]["y2"]))
    key = lambda b: F.struct(b["boundingBox"], b["inferText"])
    keys = F.transform(good, key)
    first = F.filter(F.transform(good, lambda b, i: F.struct(i.alias("i"), b.alias("b"))), lambda x: F.array_position(keys, key(x["b"])) == x["i"] + 1)
    tokens = F.transform(first, lambda x, i: F.struct(i.alias("token_id"), x["b"]["inferText"].alias("text"), x["b"]["inferConfidence"].alias("confidence"), x["b"]["boundingBox"]["x1"].alias("x1"), x["b"]["boundingBox"]["y1"].alias("y1"), x["b"]["boundingBox"]["x2"].alias("x2"), x["b"]["boundingBox"]["y2"].alias("y2")))
    table = F.exists("results", lambda f: (f["fieldId"] == TABLE_FIELD) & f["koiOcrResult"].isNotNull())
    ok = F.col("problem").isNull()
    return rows.select(
        "file", "image", status.alias("status"), "problem", F.col("r.formResult.type").alias("form_type"), "full_text",
        F.when(ok, tokens.cast(f"array<{TOKEN}>")).alias("tokens"), F.col("image_width").alias("given_width"), F.col("image_height").alias("given_height"),
        F.when(table, F.lit(TABLE_EDGE)).alias("edge"), F.when(ok, F.size("boxes") - F.size(good)).otherwise(0).alias("inverted"),
    )


def required(parsed: DataFrame, skip_failed: bool = False) -> DataFrame:
    """Good responses; the job fails on a malformed one, on a failed one unless skipped, and where none is good.

    All problems of a file are named in one message. Evaluated with the rows, so nothing is collected.
    """
    bad = (F.col("status") == "malformed") | ((F.col("status") == "failed") & F.lit(not skip_failed))
    w = Window.partitionBy("file")
    told = parsed.withColumn("_bad", F.array_sort(F.collect_set(F.when(bad, F.concat_ws(": ", "image", "problem"))).over(w))).withColumn("_good", F.count_if(F.col("status") == "ok").over(w))
    message = F.when(F.size("_bad") > 0, F.concat_ws("; ", "_bad")).when(F.col("_good") == 0, F.concat(F.lit("no good response in "), F.col("file")))
    checked = told.withColumn("image", F.when(message.isNotNull(), F.raise_error(message).cast("string")).otherwise(F.col("image")))
    return checked.where((F.col("status") == "ok") & F.coalesce(F.length("image") >= 0, F.lit(True))).drop("_bad", "_good")


def candidates(image: Column, roots: list[str]) -> Column:
    """Places to look for an image, best first: as given, then under each root with and without the first folder."""
    tail = F.regexp_replace(image, "^[^/]+/", "")
    out = [F.when(image.startswith("/"), image)]
    for root in roots:
        out += [F.concat(F.lit(root.rstrip("/") + "/"), image), F.concat(F.lit(root.rstrip("/") + "/"), tail)]
    return F.array_distinct(F.filter(F.array(*out), lambda x: x.isNotNull()))


def resolve(images: DataFrame, files: DataFrame, roots: list[str]) -> DataFrame:
    """Adds ``path``: the first candidate among the files there are (``path`` of ``files``), else the first candidate."""
    c = images.withColumn("_c", candidates(F.col("image"), roots))
    flat = c.select("image", F.posexplode("_c").alias("rank", "path")).distinct()
    found = flat.join(files.select("path").distinct(), "path", "left_semi").groupBy("image").agg(F.min_by("path", "rank").alias("_found"))
    return c.join(found, "image", "left").withColumn("path", F.coalesce("_found", F.get("_c", F.lit(0)))).drop("_c", "_found")


def image_sizes(spark: SparkSession, path: str, glob: str = "*.{png,jpg,jpeg}") -> DataFrame:
    """``path, width, height`` of PNG and JPEG files, read from their headers; null for other content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)

    @F.arrow_udf("struct<width:int,height:int>")
    def size(column):
        import pyarrow as pa

        rows = [dict(zip(("width", "height"), header_size(x), strict=True)) for x in column.to_pylist()]
        return pa.array(rows, pa.struct([("width", pa.int32()), ("height", pa.int32())]))

    return files.select("path", size("content").alias("s")).select("path", "s.width", "s.height")


def header_size(data: bytes) -> tuple[int | None, int | None]:
    """Width and height in a PNG or JPEG header."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data):
            if data[at] != 0xFF:
                return None, None
            kind = data[at + 1]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
            at += 2 if kind == 0xFF or 0xD0 <= kind <= 0xD8 else 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return None, None
