"""Checks and evidence after deduplication, and the extension of addresses over their units."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilgrid.functions import identifiers as ids
from veilgrid.functions.labels import DOCUMENT_FIELDS, SERVICE_LINE_FIELDS
from veilgrid.functions.normalize import searchable

#: Characters looked at before and after a span.
BEFORE, AFTER = 64, 24


def context(text: Column, start: Column, end: Column) -> Column:
    begin = F.greatest(start - BEFORE, F.lit(0))
    return text.substr(begin + 1, end + AFTER - begin)


def _bare(x: Column) -> Column:
    return F.upper(F.regexp_replace(x, "(?U)\\s", ""))


def nearest_label(entity: Column, near: Column) -> Column:
    """The longest label of the category that the context holds; null without one."""
    bare = _bare(near)
    out = F.lit(None).cast("string")
    for category, labels in DOCUMENT_FIELDS.items():
        known = F.array(*(F.lit(x) for x in sorted(dict.fromkeys(labels), key=lambda x: (-len(x), x))))
        out = F.when(entity == category, F.get(F.filter(known, lambda k: F.contains(bare, _bare(k))), F.lit(0))).otherwise(out)
    return out


def checked(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Drops a model's e-mail addresses and licences of wrong form and unlabelled service numbers; adds ``field:`` evidence.

    ``texts`` has ``doc_id, raw``; spans of rules keep their e-mail addresses and licences.
    """
    rows = spans.join(texts.select("doc_id", "raw"), "doc_id")
    near = context(F.col("raw"), F.col("raw_start"), F.col("raw_end"))
    by_model = F.col("rule_id").startswith("ner:")
    label = nearest_label(F.col("entity_type"), near)
    licence_label = F.coalesce(F.when(F.col("entity_type") == "driver_license_number", label).isNotNull(), F.lit(False))
    bad_mail = by_model & (F.col("entity_type") == "email_address") & ~ids.email(F.col("text"))
    bad_licence = by_model & (F.col("entity_type") == "driver_license_number") & ~ids.license_number(F.regexp_replace("text", "\\s", ""), licence_label)
    service = F.lit(False)
    for k in SERVICE_LINE_FIELDS:
        service = service | F.contains(_bare(near), F.lit(k.upper()))
    bad_phone = (F.col("entity_type") == "phone_number") & ids.representative_phone(F.col("text")) & ~service
    told = F.when(label.isNotNull(), F.array_distinct(F.concat("evidence", F.array(F.concat(F.lit("field:"), label))))).otherwise(F.col("evidence"))
    return rows.where(~(bad_mail | bad_licence | bad_phone)).withColumn("evidence", told).select(*spans.columns)


#: What a token of an address unit and a day look like: a number with an optional second one, a number with a unit, or a building.
UNIT = re.compile(r"\d+(?:[-/]\d+)?(?:번지)?|\d+(?:동|층|호)(?:[가-힣A-Za-z0-9].*)?|[가-힣A-Za-z0-9]{1,20}(?:아파트|빌딩|타워|센터|오피스텔|상가|플라자)")
DAY = re.compile(r"(?:19|20)\d{2}(?:[-./]\d{1,2}){1,2}")
_NOISE = str.maketrans("", "", ",.;:·ㆍ()[]{}")


def _form(token: dict) -> str:
    return searchable(token["text"]).translate(_NOISE)


def _follows(above: list[dict], below: list[dict]) -> bool:
    """Whether a line continues the one above: 1.5 heights down at most, and back under it or 4 heights aside at most."""
    height = max([1, *(t["y2"] - t["y1"] for t in (*above, *below))])
    if min(t["y1"] for t in below) - max(t["y2"] for t in above) > 1.5 * height:
        return False
    left, right = min(t["x1"] for t in above), max(t["x2"] for t in above)
    under, end = min(t["x1"] for t in below), max(t["x2"] for t in below)
    return under <= left and min(right, end) > max(left, under) or abs(under - left) <= 4 * height


def extension(lines: list[dict], token_ids: list[int], most: int = 3) -> list[int]:
    """The address's tokens with the unit tokens that follow on its line and up to two more, up to a date."""
    chosen = set(token_ids)
    held = [i for i, line in enumerate(lines) if any(t["token_id"] in chosen for t in line["tokens"])]
    if not held:
        return token_ids
    out, at = list(token_ids), held[-1]
    row = lines[at]["tokens"]
    last = max(k for k, t in enumerate(row) if t["token_id"] in chosen)
    above = [t for t in row if t["token_id"] in chosen]

    def take(tokens: list[dict]) -> list[dict]:
        taken = []
        for t in tokens:
            if DAY.fullmatch(_form(t)):
                break
            taken.append(t)
        out.extend(t["token_id"] for t in taken)
        return taken

    if last + 1 < len(row) and UNIT.fullmatch(_form(row[last + 1])):
        above = above + take(row[last + 1 :])
    for below in (x["tokens"] for x in lines[at + 1 : at + most]):
        if not below or not UNIT.fullmatch(_form(below[0])) or not _follows(above, below):
            break
        take(below)
        above = below
    return out


def grown(lines: list[dict], token_ids: list[int]) -> dict | None:
    """All that changes in an address span that grows over its units; null where it does not."""
    ids = extension(lines, token_ids)
    if len(ids) <= len(token_ids):
        return None
    chosen, at, places, tokens, held = set(ids), 0, [], {}, []
    for line in lines:
        for k, t in enumerate(line["tokens"]):
            at += k > 0  # tokens are joined by a space, lines by their end
            if t["token_id"] in chosen:
                places.append((at, at + len(t["text"])))
                tokens[t["token_id"]] = t
                if line["line_id"] not in held:
                    held.append(line["line_id"])
            at += len(t["text"])
        at += 1
    text = " ".join(tokens[i]["text"].strip() for i in ids).strip()
    return {
        "text": text, "normalized_text": "".join(map(searchable, text)), "raw_start": min(a for a, _ in places), "raw_end": max(z for _, z in places), "token_ids": ids, "line_ids": held,
        "boxes": [{k: tokens[i][k] for k in ("x1", "y1", "x2", "y2")} for i in ids], "ocr_confidence": min(tokens[i]["confidence"] for i in ids),
    }


GROWN = "struct<text:string,normalized_text:string,raw_start:int,raw_end:int,token_ids:array<int>,line_ids:array<int>,boxes:array<struct<x1:int,y1:int,x2:int,y2:int>>,ocr_confidence:double>"


def extend_addresses(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """Address spans grown over their units, in every column. The walk down the lines keeps state, hence an Arrow function.

    ``docs`` has ``doc_id, lines``.
    """
    box = pa.struct([(k, pa.int32()) for k in ("x1", "y1", "x2", "y2")])
    kind = pa.struct([("text", pa.string()), ("normalized_text", pa.string()), ("raw_start", pa.int32()), ("raw_end", pa.int32()), ("token_ids", pa.list_(pa.int32())), ("line_ids", pa.list_(pa.int32())), ("boxes", pa.list_(box)), ("ocr_confidence", pa.float64())])

    @F.arrow_udf(GROWN)
    def wider(lines: pa.Array, tokens: pa.Array) -> pa.Array:
        return pa.array([grown(a or [], b or []) for a, b in zip(lines.to_pylist(), tokens.to_pylist(), strict=True)], kind)

    address = spans.where("entity_type = 'address'").join(docs.select("doc_id", "lines"), "doc_id")
    new = address.withColumn("_new", wider("lines", F.col("token_ids").cast("array<int>")))
    more = F.col("_new").isNotNull()
    told = F.array_distinct(F.concat("evidence", F.array(F.lit("postprocess:address_unit_continuation"))))
    own = {c: F.when(more, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in ("text", "normalized_text", "raw_start", "raw_end", "token_ids", "line_ids", "boxes", "ocr_confidence")}
    own["evidence"] = F.when(more, told).otherwise(F.col("evidence")).alias("evidence")
    done = new.select(*(own.get(c, F.col(c)) for c in spans.columns))
    return spans.where("entity_type <> 'address' or entity_type is null").unionByName(done)
