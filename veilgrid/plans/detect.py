"""From documents to decisions: the whole plan, composed of operators.

Entry points: :func:`text_spans` for plain texts, :func:`ocr_spans` for tokens with boxes, and :func:`run` for rules, a
model and a policy over either. Everything is a DataFrame; no step collects.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilgrid.operators import catalog, layout, ner, policy, postprocess, spans, structure, tables, views
from veilgrid.operators.policy import Policy
from veilgrid.session import kept

SPAN_COLUMNS = ("doc_id", "seq", "entity_type", "text", "normalized_text", "raw_start", "raw_end", "token_ids", "line_ids", "detector_confidence", "ocr_confidence", "rule_id", "review_required", "risk_level", "evidence", "boxes")

BOXES = "array<struct<x1:int,y1:int,x2:int,y2:int>>"
SPAN_TYPES = "doc_id long, seq long, entity_type string, text string, normalized_text string, raw_start int, raw_end int, token_ids array<int>, line_ids array<int>, detector_confidence double, ocr_confidence double, rule_id string, review_required boolean, risk_level int, evidence array<string>, boxes array<struct<x1:int,y1:int,x2:int,y2:int>>"


def text_spans(docs: DataFrame, relaxed: bool = False, as_of: str = catalog.AS_OF, id_col: str = "doc_id", text_col: str = "text", categories: tuple[str, ...] | None = None, rules: tuple[catalog.Rule, ...] | None = None) -> DataFrame:
    """Raw spans of plain texts: each match is one span whose token is its own start.

    With ``categories`` only their rules run. That is a faster path to ask for, not an equal one: a rule of another category may
    take a place from them when all run, as in :func:`ocr_spans`, which always detects all first. ``rules`` run in place of the catalogue's.
    """
    m = catalog.detect(docs, categories, relaxed, as_of, id_col, text_col, rules)
    return m.select(
        "doc_id", F.col("seq").cast("long").alias("seq"), F.col("category").alias("entity_type"), F.col("value").alias("text"), F.regexp_replace("value", "\\s", "").alias("normalized_text"),
        F.col("start").alias("raw_start"), F.col("stop").alias("raw_end"), F.array("start").alias("token_ids"), F.array().cast("array<int>").alias("line_ids"), F.from_json(F.lit("[]"), BOXES).alias("boxes"),
        F.col("confidence").alias("detector_confidence"), F.lit(1.0).alias("ocr_confidence"), F.concat(F.lit("rule:"), F.col("label")).alias("rule_id"), F.lit(False).alias("review_required"), F.col("risk").alias("risk_level"), "evidence",
    )


def _found(view_rows: DataFrame, lines_df: DataFrame, relaxed: bool, as_of: str, person_labels: tuple[str, ...]) -> DataFrame:
    """Matches of all rules, and of the structure rules in their own modes, in views. Only address and person rules read repaired texts."""
    plain = view_rows.where("mode not in ('address_field', 'structured_block')")
    fixed = kept(plain.withColumns({"_address": structure.address_text(F.col("text")), "_person": structure.person_text(F.col("text"))}), "prepared")
    instead = {"address": F.col("_address"), "person_name": F.col("_person")}
    regular = None
    for rules in catalog.rule_groups(relaxed):  # a few rules at a time: one expression of all would be too large to compile
        found = F.filter(catalog.applied(F.col("text"), rules, as_of, instead), lambda m: F.array_contains("allowed", m["category"]))
        part = fixed.withColumn("m", F.explode(found))
        if any(r.category == "address" for r in rules):
            part = part.where("m.category <> 'address'").unionByName(_with_tails(part.where("m.category = 'address'"), lines_df))
        part = part.drop("_address", "_person")
        regular = part if regular is None else regular.unionByName(part)
    if person_labels:
        named = F.transform(structure.labelled_persons(F.col("text"), person_labels), lambda p: F.struct(F.lit("CUSTOM_PERSON_FIELD").alias("label"), F.lit("person_name").alias("category"), p["start"].alias("start"), p["stop"].alias("stop"), p["value"].alias("value"), F.lit(structure.LABELLED).alias("confidence"), F.lit(catalog.MEDIUM).alias("risk"), F.array(F.lit("structure:custom-person-field"), F.concat(F.lit("field:"), p["label"])).alias("evidence")))
        custom = view_rows.where("array_contains(allowed, 'person_name') and mode in ('token_spaced', 'field_compact') and size(line_ids) = 1").withColumn("m", F.explode(named))
        regular = regular.unionByName(custom)
    blocks = structure.account_blocks(view_rows.where("mode = 'structured_block'"))
    parts = []
    for column, label, category, risk in (("account", "ACCOUNT_CONTEXT", "account_card_number", catalog.HIGH), ("owner", "PERSON_ACCOUNT_OWNER", "person_name", catalog.MEDIUM)):
        x = F.col(column)
        parts.append(F.when(x.isNotNull(), F.struct(F.lit(label).alias("label"), F.lit(category).alias("category"), x["start"].cast("int").alias("start"), x["stop"].cast("int").alias("stop"), x["value"].alias("value"), x["confidence"].alias("confidence"), F.lit(risk).alias("risk"), x["evidence"].alias("evidence"))))
    structured = blocks.withColumn("m", F.explode(F.filter(F.array(*parts), lambda m: m.isNotNull()))).drop("account", "owner")
    field = structure.address_field(F.col("text"))
    address = view_rows.where("mode = 'address_field'").withColumn("f", field).where("f is not null")
    address = address.withColumn("m", F.struct(F.lit("ADDRESS_FIELD").alias("label"), F.lit("address").alias("category"), F.col("f.start").cast("int").alias("start"), F.col("f.stop").cast("int").alias("stop"), F.col("f.value").alias("value"), F.lit(structure.LABELLED).alias("confidence"), F.lit(catalog.MEDIUM).alias("risk"), F.array(F.lit("structure:address-field"), F.lit("layout:aligned-value-lines")).alias("evidence"))).drop("f")
    return regular.unionByName(structured).unionByName(address)


def _with_tails(rows: DataFrame, lines_df: DataFrame) -> DataFrame:
    """Addresses with the units and the parenthesis behind them; on the next line these must begin within 3 heights of the address's left edge."""
    end = structure.address_tail(F.col("_address"), F.col("m.stop"))
    rows = rows.withColumn("_end", end).withColumn("_break", F.instr(F.col("text").substr(F.col("m.stop") + 1, F.col("_end") - F.col("m.stop")), "\n"))
    first = lambda a, start, stop: F.get(F.filter(F.slice(a, start + 1, stop - start), lambda x: x.isNotNull()), F.lit(0))
    rows = rows.withColumn("_a", first(F.col("char_token"), F.col("m.start"), F.col("m.stop"))).withColumn("_b", F.when(F.col("_break") > 0, first(F.col("char_token"), F.col("m.stop") + F.col("_break"), F.col("_end"))))
    over = rows.where("_break > 0")
    box = lines_df.select("doc_id", F.explode("tokens").alias("t")).select("doc_id", F.col("t.token_id").alias("_t"), F.struct("t.x1", F.greatest(F.col("t.y2") - F.col("t.y1"), F.lit(1)).alias("h")).alias("_box"))
    for k in ("_a", "_b"):
        over = over.join(box.withColumnRenamed("_t", k).withColumnRenamed("_box", f"{k}_box"), ["doc_id", k], "left")
    near = F.abs(F.col("_b_box.x1") - F.col("_a_box.x1")) <= 3 * F.greatest(F.col("_a_box.h"), F.col("_b_box.h"))
    over = over.withColumn("_end", F.when(F.coalesce(near, F.lit(False)), F.col("_end")).otherwise(F.col("m.stop"))).drop("_a_box", "_b_box")
    both = rows.where("_break = 0").unionByName(over)
    longer = F.col("m").withField("stop", F.col("_end")).withField("value", F.col("text").substr(F.col("m.start") + 1, F.col("_end") - F.col("m.start")))
    return both.withColumn("m", longer).drop("_end", "_break", "_a", "_b")


def spans_from(matched: DataFrame, lines_df: DataFrame) -> DataFrame:
    """Matches in views (``m``) to spans of the document, with tokens, lines, text and the least OCR confidence.

    A match of a two-line view must reach its second line, as views of one line have all others, and what it has on both lines must
    be close: where it has nothing on the first, all of that line is its label.
    """
    placed = matched.withColumn("p", spans.map_span(F.col("char_raw"), F.col("char_token"), F.col("m.start"), F.col("m.stop"))).where("p is not null")
    paired = (F.size("line_ids") == 2) & F.col("mode").isin("token_spaced", "format_compact", "format_recovered", "format_ocr_tolerant")
    ends = F.instr("text", "\n") - 1
    placed = placed.withColumn("_pair", paired).where(~F.col("_pair") | ((ends >= 0) & (F.col("m.stop") > ends)))
    tokens = lines_df.select("doc_id", "line_id", F.explode("tokens").alias("t"))
    line = F.struct("line_id", "text", spans.hull(F.transform("tokens", lambda t: F.struct(t["x1"].alias("x1"), t["y1"].alias("y1"), t["x2"].alias("x2"), t["y2"].alias("y2")))).alias("box"))
    raw = lines_df.groupBy("doc_id").agg(F.array_sort(F.collect_list(line)).alias("_l")).select("doc_id", "_l", F.array_join(F.transform("_l", lambda x: x["text"]), "\n").alias("raw"))
    keyed = placed.withColumn("_id", F.xxhash64("doc_id", "mode", "char_raw", "m"))
    at = keyed.select("doc_id", "_id", F.posexplode("p.token_ids").alias("k", "token_id")).distinct()
    boxed = at.join(tokens.select("doc_id", "line_id", F.col("t.token_id").alias("token_id"), F.col("t.confidence").alias("confidence"), F.struct("t.x1", "t.y1", "t.x2", "t.y2").alias("box"), F.col("t.text").alias("token_text")), ["doc_id", "token_id"])
    items = F.array_sort(F.collect_list(F.struct("k", "line_id", "confidence", "box", "token_text")))
    about = boxed.groupBy("doc_id", "_id").agg(items.alias("_b"))
    rows = keyed.join(about, ["doc_id", "_id"]).join(raw, "doc_id")
    apart = F.col("mode").isin("address_field", "table_field", "table_field_compact")
    text = F.when(apart, F.array_join(F.transform("_b", lambda b: b["token_text"]), " ")).otherwise(F.col("raw").substr(F.col("p.raw_start") + 1, F.col("p.raw_end") - F.col("p.raw_start")))
    lines = F.array_distinct(F.transform("_b", lambda b: b["line_id"]))
    on = lambda k: spans.hull(F.transform(F.filter("_b", lambda b: b["line_id"] == F.try_element_at("line_ids", F.lit(k))), lambda b: b["box"]))
    whole = F.get(F.filter("_l", lambda x: x["line_id"] == F.try_element_at("line_ids", F.lit(1))), F.lit(0))["box"]
    close = spans.cross_line_close(F.coalesce(on(1), whole), on(2))
    rows = rows.where(~F.col("_pair") | F.coalesce(close, F.lit(False)))
    return rows.select(
        "doc_id", F.xxhash64("_id", "view_id").alias("seq"), F.col("m.category").alias("entity_type"), text.alias("text"), F.col("m.value").alias("normalized_text"), F.col("p.raw_start").alias("raw_start"), F.col("p.raw_end").alias("raw_end"),
        F.col("p.token_ids").alias("token_ids"), lines.alias("line_ids"), F.transform("_b", lambda b: b["box"]).alias("boxes"), F.col("m.confidence").alias("detector_confidence"), F.array_min(F.transform("_b", lambda b: b["confidence"])).alias("ocr_confidence"),
        F.concat(F.when(F.col("mode").isin("structured_block", "address_field"), "context:").otherwise("rule:"), F.col("m.label")).alias("rule_id"), F.lit(False).alias("review_required"), F.col("m.risk").alias("risk_level"), F.col("m.evidence").alias("evidence"),
    )


def all_views(lines_df: DataFrame, ready: DataFrame, chosen: Policy) -> DataFrame:
    """Views of lines and blocks, table fields and address fields, for a policy's strictness."""
    from veilgrid.functions.labels import ADDRESS_LABELS, PERSON_LABELS

    out = views.line_views(ready, chosen.strictness, chosen.max_lines, (*PERSON_LABELS, *chosen.person_labels))
    for n in range(1, chosen.max_lines + 1):
        block = views._as(views.blocks(ready, n), "structured_block", views.ALLOWED["structured_block"])
        out = out.unionByName(_flat(block))
    out = out.unionByName(table_views(lines_df, ready, chosen))
    return out.unionByName(_flat(address_views(lines_df, ready, (*ADDRESS_LABELS, *chosen.address_labels), chosen)))


def _flat(rows: DataFrame) -> DataFrame:
    v = rows.select("doc_id", "mode", "line_ids", "view.*", "allowed")
    return v.withColumn("view_id", F.xxhash64("mode", "text", "char_raw", "allowed"))


def flat_tokens(lines_df: DataFrame) -> DataFrame:
    return lines_df.select("doc_id", "line_id", F.posexplode("tokens").alias("pos", "t")).select("doc_id", "line_id", "pos", "t.token_id", "t.text", "t.x1", "t.y1", "t.x2", "t.y2")


def table_views(lines_df: DataFrame, ready: DataFrame, chosen: Policy) -> DataFrame:
    """``label:``, a newline and the values below, which keep their places; the header's own tokens are only named."""
    tokens = flat_tokens(lines_df)
    joined = tables.fields(tokens, tables.headers(tokens, tables.label_table(lines_df.sparkSession, {"person_name": chosen.person_labels, "address": chosen.address_labels})), chosen.max_lines)
    parts = ready.select("doc_id", F.col("line_id").alias("value_line"), "ready")
    rows = joined.join(parts, ["doc_id", "value_line"]).withColumn("ready", F.filter("ready", lambda t: F.exists("values", lambda v: v["token_id"] == t["token_id"])))
    out = None
    for mode in ("table_field", "table_field_compact"):
        v = views.view_of(F.col("ready"), "structured_block" if mode == "table_field" else "field_compact")
        head = F.concat("label", F.lit(":\n"))
        pad = F.transform(F.sequence(F.lit(1), F.length(head)), lambda x: F.lit(None).cast("int"))
        one = rows.withColumn("view", v).select("doc_id", F.lit(mode).alias("mode"), F.array("line_id", "value_line").alias("line_ids"), F.struct(F.concat(head, F.col("view.text")).alias("text"), F.concat(pad, F.col("view.char_raw")).alias("char_raw"), F.concat(pad, F.col("view.char_token")).alias("char_token")).alias("view"), F.col("categories").alias("allowed"))
        out = one if out is None else out.unionByName(one)
    return _flat(out)


def address_views(lines_df: DataFrame, ready: DataFrame, labels: tuple[str, ...], chosen: Policy) -> DataFrame:
    """From an address label (up to five tokens) to the next stop label or date, over up to three lines that read like addresses.

    A label alone on its line takes the next line as its value. Labels of six or more characters may be one edit off;
    in tolerant mode shorter ones may lack or repeat one.
    """
    from veilgrid.functions.labels import ADDRESS_STOPS, PLACE_ENDS, ROAD_ENDS, UNIT_ENDS
    from veilgrid.functions.normalize import label_text

    block = views.blocks(ready, 1)
    for n in (2, 3):
        block = block.unionByName(views.blocks(ready, n))
    longest = block.withColumn("_n", F.row_number().over(views.Window.partitionBy("doc_id", "line_id").orderBy(F.desc(F.size("line_ids"))))).where("_n = 1").drop("_n")
    own = F.filter("ready", lambda t: t["line_id"] == F.col("line_id"))
    known = F.array(*map(F.lit, labels))

    def matches(c, k):
        close = F.levenshtein(c, k, 1) >= 0
        fuzzy = (F.length(k) >= 6) & close
        if chosen.strictness == "ocr_tolerant":
            fuzzy = fuzzy | ((F.length(k) >= 2) & (F.length(c) != F.length(k)) & close)
        return (c == k) | fuzzy

    rows = longest.withColumn("_own", own).where(F.size("_own") > 0)
    starts = rows.select("*", F.explode(F.sequence(F.lit(0), F.size("_own") - 1)).alias("_a"))
    ends = starts.withColumn("_k", F.explode(F.sequence(F.lit(1), F.least(F.lit(5), F.size("_own") - F.col("_a")))))
    ends = ends.withColumn("_c", label_text(F.array_join(F.transform(F.slice("_own", F.col("_a") + 1, F.col("_k")), lambda t: t["text"]), "")))
    hits = ends.where(F.exists(known, lambda k: matches(F.col("_c"), k)))
    best = views.Window.partitionBy("doc_id", "line_id").orderBy(F.desc(F.length("_c")), "_a")
    one = hits.withColumn("_r", F.row_number().over(best)).where("_r = 1")
    rest = F.slice("ready", F.col("_a") + F.col("_k") + 1, F.size("ready"))
    lead = F.filter(F.transform(rest, lambda t, i: F.struct(i.alias("i"), t["text"].rlike("(?U)\\p{Alnum}").alias("v"))), lambda x: x["v"])
    rest = F.when(F.size(lead) > 0, F.slice(rest, F.get(lead, F.lit(0))["i"] + 1, F.size(rest)))
    stop = "^.{0,4}" + structure.one_of(ADDRESS_STOPS)
    day = "^(?:19|20)\\d\\d(?:[-./]\\d{1,2}){2}$"
    starts_value = F.get(F.col("_rest"), F.lit(0))["line_id"]
    word = "[A-Za-z가-힣0-9]{1,30}"
    number, lot = "\\d+[-/]\\d+", "\\d+(?:[-/]\\d+)?번지"
    inside = f"\\d+{structure.one_of(UNIT_ENDS)}[A-Za-z가-힣0-9]{{0,30}}"
    road = f"{word}{structure.one_of((*ROAD_ENDS, '번길'))}\\d+(?:-\\d+)?"
    unit = f"^(?:{number}|{lot}|{inside}|{road}|{word}{structure.one_of(PLACE_ENDS)})$"
    first_of = lambda n: F.get(F.filter("_rest", lambda t: (t["line_id"] == starts_value + n) & t["text"].rlike("(?U)\\p{Alnum}")), F.lit(0))["text"]
    follows = lambda n: F.coalesce(F.regexp_replace(first_of(n), "(?U)[^\\p{Alnum}/-]", "").rlike(unit), F.lit(False))
    lines_on = F.when(~follows(1), 0).when(~follows(2), 1).otherwise(2)
    out = one.withColumn("_rest", rest).where("_rest is not null and size(_rest) > 0")
    cut = F.array_position(F.transform("_rest", lambda t: label_text(t["text"]).rlike(stop) | t["text"].rlike(day)), True)
    out = out.withColumn("_on", lines_on).withColumn("_cut", cut).withColumn("ready", F.when(F.col("_cut") > 0, F.slice("_rest", F.lit(1), (F.col("_cut") - 1).cast("int"))).otherwise(F.col("_rest")))
    out = out.withColumn("ready", F.filter("ready", lambda t: t["line_id"] <= starts_value + F.col("_on"))).where("size(ready) > 0")
    return views._as(out.select("doc_id", "line_id", F.array_distinct(F.transform("ready", lambda t: t["line_id"])).alias("line_ids"), "ready"), "address_field", views.ALLOWED["address_field"])


def ocr_spans(docs: DataFrame, chosen: Policy, as_of: str = catalog.AS_OF) -> DataFrame:
    """Final rule spans of documents with ``lines``: views, rules, deduplication, address growth and checks."""
    lines_df = kept(layout.placed_lines(docs), "lines")
    ready = kept(views.ready_lines(lines_df), "ready")
    seen = kept(all_views(lines_df, ready, chosen), "views")
    matched = kept(_found(seen, lines_df, not chosen.checksum, as_of, chosen.person_labels), "matches")
    final = kept(spans.deduplicate(kept(spans_from(matched, lines_df), "raw-spans")), "spans")
    grown = postprocess.extend_addresses(final, docs)
    return postprocess.checked(grown, docs.select("doc_id", layout.raw_text().alias("raw")))


def ner_spans(docs: DataFrame, chosen: Policy, provider: ner.Provider, as_of: str = catalog.AS_OF) -> DataFrame:
    """Final spans of a model's provider over the same views; all ask for review, none has a risk level."""
    lines_df = kept(layout.placed_lines(docs), "lines")
    ready = kept(views.ready_lines(lines_df), "ready")
    seen = kept(all_views(lines_df, ready, chosen).where("mode in ('token_spaced', 'table_field')"), "views")
    found = ner.detections(ner.judged(ner.distinct_inference(seen, provider), chosen.ner_delta, chosen.ner_scope, chosen.ner_entities), seen.select("doc_id", "view_id", F.col("text").alias("view_text")).distinct(), as_of)
    rows = seen.join(found.withColumnRenamed("text", "value").drop("rule_id"), ["doc_id", "view_id"]).where("array_contains(allowed, category)")
    m = F.struct(F.array_join("entities", "+").alias("label"), "category", "start", "stop", "value", "confidence", F.lit(None).cast("int").alias("risk"), F.array(F.lit("ner:model")).alias("evidence"))
    raw = kept(spans_from(rows.withColumn("m", m).select(*seen.columns, "m"), lines_df), "raw-spans")
    final = spans.deduplicate(raw.withColumn("rule_id", F.regexp_replace("rule_id", "^rule:", "ner:")).withColumn("review_required", F.lit(True)))
    return postprocess.checked(postprocess.extend_addresses(final, docs), docs.select("doc_id", layout.raw_text().alias("raw")))


@dataclass
class Run:
    """The tables of a run."""

    rule_spans: DataFrame
    ner_spans: DataFrame
    final: DataFrame
    decisions: DataFrame
    ner_plan: DataFrame
    problem: str = ""


def decide(docs: DataFrame, rule_spans: DataFrame, model_spans: DataFrame, chosen: Policy) -> Run:
    """Gates, the merge of both providers, and a decision for each span."""
    plan = policy.ner_wanted(chosen, docs, rule_spans)
    if chosen.execution == "rules_then_ner":
        model_spans = model_spans.join(plan.where("run_ner").select("doc_id"), "doc_id", "left_semi")
    table = policy.policies(docs.sparkSession, [chosen])
    judged_rules, judged_ner = policy.evaluate(rule_spans, table), policy.evaluate(model_spans, table)
    passed = lambda d: d.where("included").withColumn("review_required", F.col("effective_review")).select(*rule_spans.columns)
    final = spans.deduplicate(policy.combine(passed(judged_rules), passed(judged_ner), chosen))
    both = judged_rules.unionByName(judged_ner)
    return Run(rule_spans, model_spans, final, policy.decisions(both, final), plan)


def run(docs: DataFrame, chosen: Policy, provider: ner.Provider | None = None, as_of: str = catalog.AS_OF, fall_back: bool = False) -> Run:
    """Rules, the model where it is wanted, and the policy over documents with ``lines``.

    With ``fall_back`` a model that fails leaves the spans of the rules, and its message in ``problem``; where
    only the model was asked for there are none, so that results mean what they say.
    """
    rules = kept(ocr_spans(docs, chosen, as_of), "rule-spans") if policy.runs_rules(chosen) else None
    if rules is None:
        rules = docs.sparkSession.createDataFrame([], SPAN_TYPES)
    wants = bool(policy.ner_targets(chosen)) and chosen.execution != "rules_only" and provider is not None
    if wants:
        model_docs = docs.join(policy.ner_wanted(chosen, docs, rules).where("run_ner").select("doc_id"), "doc_id", "left_semi")
        try:
            model = kept(ner_spans(model_docs, chosen, provider, as_of), "ner-spans")  # runs the model, so its errors show here
        except Exception as e:
            if not fall_back:
                raise
            done = decide(docs, rules, rules.limit(0), replace(chosen, execution="rules_only") if chosen.execution != "ner_only" else chosen)
            return replace(done, problem=str(e).splitlines()[0] if str(e) else type(e).__name__)
    else:
        model = rules.limit(0)
    return decide(docs, rules, model, chosen)
