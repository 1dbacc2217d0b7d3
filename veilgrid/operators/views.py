"""Search views: texts to search whose characters know where they come from.

A view has ``text`` and, aligned with it, ``char_raw`` (place in the document's text) and ``char_token``; separators that a
view adds have neither. Views of a line, of neighbouring lines, round a colon, behind a person's label, and the
recovered forms of numbers are built from nested tokens, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilgrid.functions.identifiers import EMAIL
from veilgrid.functions.labels import EMAIL_LABELS, FORMAT_CATEGORIES, LINE_CATEGORIES, OTHER_FIELDS, PERSON_LABELS
from veilgrid.functions.normalize import RECOVERABLE, collapse_separators, restore_digits, search_pieces

MODES = ("token_spaced", "format_compact", "field_compact", "structured_block", "address_field", "format_recovered", "format_ocr_tolerant", "table_field", "table_field_compact")

#: What may be found in a view of each mode.
ALLOWED = {
    "token_spaced": LINE_CATEGORIES, "format_compact": FORMAT_CATEGORIES, "field_compact": LINE_CATEGORIES, "format_recovered": RECOVERABLE,
    "format_ocr_tolerant": RECOVERABLE, "structured_block": ("account_card_number", "person_name"), "address_field": ("address",),
}

NEXT_SIGNS = "@:/._+-"


def searchable_tokens(lines_df: DataFrame) -> DataFrame:
    """Lines (``doc_id, line_id, raw_offset, tokens``) exploded to tokens with their searchable form and places."""
    z = F.posexplode("tokens").alias("pos", "t")
    flat = lines_df.select("doc_id", "line_id", "raw_offset", z)
    w = Window.partitionBy("doc_id", "line_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("raw_offset") + F.coalesce(F.sum(F.length("t.text") + 1).over(w), F.lit(0)).cast("int")
    return flat.withColumn("raw_start", start).withColumn("s", search_pieces(F.col("t.text")))


def is_piece(text: Column) -> Column:
    """Whether a token may be part of a number or address: a digit, one of its signs, or ASCII letters only."""
    return (text != "") & text.rlike("(?U)\\p{Nd}|[@:/._+-]|^[A-Za-z]+$")


def with_pieces(tokens: DataFrame) -> DataFrame:
    """Adds ``piece``: as above, or a single Hangul syllable between two pieces."""
    w = Window.partitionBy("doc_id", "line_id").orderBy("pos")
    own = tokens.withColumn("_own", is_piece(F.col("s.text")))
    between = F.col("s.text").rlike("^[가-힣]$") & F.lag("_own").over(w) & F.lead("_own").over(w)
    return own.withColumn("piece", F.col("_own") | F.coalesce(between, F.lit(False))).drop("_own")


def with_email_starts(tokens: DataFrame) -> DataFrame:
    """Adds ``email_start``: the token begins an address right behind an e-mail label.

    The label is the longest of up to three tokens that makes one; up to eight tokens may make the address.
    """
    order = Window.partitionBy("doc_id", "line_id").orderBy("pos")
    after, before = F.collect_list("s.text").over(order.rowsBetween(0, 7)), F.collect_list("s.text").over(order.rowsBetween(-3, -1))
    rows = tokens.withColumn("_after", after).withColumn("_before", before).withColumn("_next", F.lead("s.text", 1).over(order))
    label = lambda x: F.regexp_replace(F.lower(F.array_join(x, "")), "[:：]+$", "").isin(*EMAIL_LABELS)
    n = F.size("_before")
    here = F.lit(False)
    for k in (1, 2, 3):  # a longer label that starts at the same token would take this token in
        start = F.slice("_before", F.greatest(n - k + 1, F.lit(1)), k)
        longer = F.lit(False)
        for extra in range(1, 4 - k):
            longer = longer | label(F.concat(start, F.slice("_after", 1, extra)))
        here = here | ((n >= k) & label(start) & ~longer)
    value = F.exists(F.sequence(F.lit(1), F.size("_after")), lambda i: F.array_join(F.slice("_after", F.lit(1), i), "").rlike(EMAIL))
    return rows.withColumn("email_start", here & value).drop("_after", "_before", "_next")


def separator(mode: str, previous: Column, token: Column, so_far_colon: Column) -> Column:
    """What a mode puts between two tokens; the first rule that fits counts."""
    out = F.when(F.lit(mode in ("token_spaced", "format_compact", "field_compact")) & token["email_start"], F.when(so_far_colon, "").otherwise(":"))
    out = out.when(previous["line_id"] != token["line_id"], " " if mode == "address_field" else "\n")
    if mode in ("token_spaced", "structured_block", "address_field"):
        return out.otherwise(" ")
    if mode == "format_compact":
        return out.otherwise(F.when(previous["piece"] & token["piece"], "").otherwise(" "))
    return out.otherwise("")


VIEW = "struct<text:string,char_raw:array<int>,char_token:array<int>>"


def view_of(tokens: Column, mode: str) -> Column:
    """A view of ``array<struct<token_id, line_id, raw_start, text, source, piece, email_start>>`` in reading order; empty tokens have no part."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    some = F.filter(tokens, lambda t: t["text"] != "")

    def part(t: Column, i: Column) -> Column:
        previous = F.get(some, i - 1)
        sep = F.when(i == 0, "").otherwise(separator(mode, previous, t, previous["text"].rlike("[:：]$")))
        gap = F.transform(F.sequence(F.lit(1), F.length(sep)), lambda x: F.lit(None).cast("int"))
        gap = F.when(F.length(sep) > 0, gap).otherwise(F.array().cast("array<int>"))
        return F.struct(
            F.concat(sep, t["text"]).alias("text"),
            F.concat(gap, F.transform(t["source"], lambda s: s + t["raw_start"])).alias("raw"),
            F.concat(gap, F.transform(t["source"], lambda s: t["token_id"])).alias("token"),
        )

    parts = F.transform(some, part)
    return F.struct(
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"),
        F.flatten(F.transform(parts, lambda p: p["raw"])).alias("char_raw"),
        F.flatten(F.transform(parts, lambda p: p["token"])).alias("char_token"),
    )


def _token() -> Column:
    return F.struct(F.col("pos"), F.col("t.token_id").alias("token_id"), F.col("line_id"), F.col("raw_start"), F.col("s.text").alias("text"), F.col("s.source").alias("source"), F.col("piece"), F.col("email_start"))


def ready_lines(lines_df: DataFrame) -> DataFrame:
    """``doc_id, line_id, ready``: each line's tokens with all that views need."""
    tokens = with_email_starts(with_pieces(searchable_tokens(lines_df)))
    return tokens.groupBy("doc_id", "line_id").agg(F.array_sort(F.collect_list(_token())).alias("ready"))


def blocks(lines: DataFrame, count: int) -> DataFrame:
    """Every ``count`` lines in a row as one: ``doc_id, line_id`` of the first, ``line_ids``, ``ready`` of all."""
    w = Window.partitionBy("doc_id").orderBy("line_id")
    out = lines
    for k in range(1, count):
        out = out.withColumn(f"_r{k}", F.lead("ready", k).over(w)).withColumn(f"_l{k}", F.lead("line_id", k).over(w))
    if count > 1:
        out = out.where(F.col(f"_r{count - 1}").isNotNull())
    ids = F.array("line_id", *(f"_l{k}" for k in range(1, count)))
    return out.select("doc_id", "line_id", ids.alias("line_ids"), F.concat("ready", *(f"_r{k}" for k in range(1, count))).alias("ready"))


def recovered(view: Column, tolerant: bool) -> Column:
    """Repeated separators collapse, and in tolerant views confused letters become digits; maps keep the first of a run."""
    again = F.transform(F.sequence(F.lit(0), F.length(view["text"]) - 1), lambda i: (i > 0) & view["text"].substr(i + 1, F.lit(1)).isin("-", ".", "/") & (view["text"].substr(i + 1, F.lit(1)) == view["text"].substr(i, F.lit(1))))
    keep = lambda a: F.transform(F.filter(F.arrays_zip(a.alias("v"), again.alias("d")), lambda x: ~x["d"]), lambda x: x["v"])
    text = restore_digits(view["text"]) if tolerant else view["text"]
    return F.when(F.length(view["text"]) > 0, F.struct(collapse_separators(text).alias("text"), keep(view["char_raw"]).alias("char_raw"), keep(view["char_token"]).alias("char_token"))).otherwise(view)


def colon_windows(lines: DataFrame, before: int = 5, after: int = 10) -> DataFrame:
    """Token windows round a token that holds a colon: one to ``before`` tokens of label, one to ``after`` of value."""
    at = F.posexplode("ready").alias("c", "tok")
    rows = lines.select("doc_id", "line_id", "ready", at).where(F.col("tok.text").rlike("[:：]"))
    rows = rows.where((F.col("c") > 0) & (F.col("c") + 2 <= F.size("ready")))
    starts = rows.withColumn("a", F.explode(F.sequence(F.greatest(F.col("c") - before, F.lit(0)), F.col("c") - 1)))
    ends = starts.withColumn("z", F.explode(F.sequence(F.col("c") + 2, F.least(F.col("c") + 1 + after, F.size("ready")))))
    return ends.select("doc_id", "line_id", F.array("line_id").alias("line_ids"), F.slice("ready", F.col("a") + 1, F.col("z") - F.col("a")).alias("ready")).distinct()


def person_windows(lines: DataFrame, labels: Iterable[str] = PERSON_LABELS, reach: int = 7) -> DataFrame:
    """Windows from a person's label (up to four tokens) over up to ``reach`` tokens more, ending before another field."""
    rows = lines.select("doc_id", "line_id", "ready", F.posexplode("ready").alias("a", "tok")).withColumn("k", F.explode(F.sequence(F.lit(1), F.least(F.lit(4), F.size("ready") - F.col("a")))))
    joined = F.array_join(F.transform(F.slice("ready", F.col("a") + 1, F.col("k")), lambda t: t["text"]), "")
    bare = F.regexp_replace(joined, "^[.,·ㆍ:;()\\[\\]{}<>_●■□※@#*-]+", "")
    found = bare.rlike("^(?:" + "|".join(sorted(labels, key=len, reverse=True)) + ")(?:$|(?U)[^\\p{Alnum}])")
    first = Window.partitionBy("doc_id", "line_id", "a").orderBy("k")
    hits = rows.where(found).withColumn("_n", F.row_number().over(first)).where("_n = 1")
    label_end = F.col("a") + F.col("k")
    others = "^[.,·ㆍ:;()\\[\\]{}<>_-]*(?:" + "|".join(OTHER_FIELDS) + ")"
    tail = F.slice("ready", label_end + 1, reach)
    stop = F.array_position(F.transform(tail, lambda t: t["text"].rlike(others)), True)
    length = F.when(stop > 0, stop - 1).otherwise(F.size(tail)).cast("int")
    ends = hits.withColumn("n", F.explode(F.sequence(F.lit(0), length)))
    return ends.select("doc_id", "line_id", F.array("line_id").alias("line_ids"), F.slice("ready", F.col("a") + 1, F.col("k") + F.col("n")).alias("ready"))


def _as(rows: DataFrame, mode: str, allowed: tuple[str, ...]) -> DataFrame:
    return rows.select("doc_id", "line_ids", F.lit(mode).alias("mode"), view_of(F.col("ready"), mode).alias("view"), F.array(*map(F.lit, allowed)).alias("allowed"))


def line_views(ready: DataFrame, strictness: str = "normalized", max_lines: int = 3, person_labels: Iterable[str] = PERSON_LABELS, windows: bool = True) -> DataFrame:
    """All views of documents' ready lines for a strictness: ``doc_id, view_id, mode, text, char_raw, char_token, line_ids, allowed``.

    exact: spaced lines. normalized: also compact ones and windows round colons. recovered: also collapsed
    separators. ocr_tolerant: also restored digits. Each level keeps what the ones before it have.
    """
    one = blocks(ready, 1)
    pair = blocks(ready, 2) if max_lines > 1 else None
    out = [_as(r, "token_spaced", ALLOWED["token_spaced"]) for r in (one, pair) if r is not None]
    persons = person_windows(ready, person_labels)
    out += [_as(persons, m, ("person_name",)) for m in ("token_spaced", "field_compact")]
    if strictness != "exact":
        compact = [_as(r, "format_compact", ALLOWED["format_compact"]) for r in (one, pair) if r is not None]
        out += compact
        if windows:
            out.append(_as(colon_windows(ready), "field_compact", ALLOWED["field_compact"]))
        for mode, tolerant in (("format_recovered", False), ("format_ocr_tolerant", True)):
            if strictness == "ocr_tolerant" or strictness == "recovered" and not tolerant:
                out += [c.select("doc_id", "line_ids", F.lit(mode).alias("mode"), recovered(F.col("view"), tolerant).alias("view"), F.array(*map(F.lit, ALLOWED[mode])).alias("allowed")) for c in compact]
    views = out[0]
    for v in out[1:]:
        views = views.unionByName(v)
    views = views.select("doc_id", "mode", "line_ids", "view.*", "allowed")
    views = views.dropDuplicates(["doc_id", "text", "char_raw", "allowed"])
    return views.withColumn("view_id", F.xxhash64("mode", "text", "char_raw", "allowed"))
