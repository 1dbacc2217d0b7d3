"""Policies: configuration, gates, combination of providers, and decisions.

A policy is a row; many policies can be evaluated over the same spans in one job by a cross of spans with the
few policy rows (their number is checked before they are broadcast).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilgrid.functions.labels import CATEGORIES, ENTITIES, SEMANTIC

#: The enumerations of a policy.
EXECUTION = ("rules_only", "ner_only", "both", "rules_then_ner", "category_routing")
MERGE = ("any", "agreement", "category_priority")
ACTIONS = ("mask", "review", "exclude")
REVIEWS = ("mask_all", "exclude_review", "review_only")
STRICTNESS = ("exact", "normalized", "recovered", "ocr_tolerant")
MAX_POLICIES = 1000


@dataclass(frozen=True)
class Policy:
    """All knobs of a policy; checked as it is made."""

    name: str = "default"
    execution: str = "both"
    merge: str = "any"
    categories: tuple[str, ...] = (*CATEGORIES, "username", "time", "company_name", "id_card_number")
    sensitivity: int = 2
    strictness: str = "normalized"
    ner_scope: str = "all"
    ner_entities: tuple[str, ...] = ()
    ner_delta: float = 0.0
    min_confidence: float = 0.0
    min_risk: int = 1
    checksum: bool = True
    invalid_checksum: str = "review"
    min_context: int = 0
    missing_context: str = "mask"
    anchor_required: tuple[str, ...] = ()
    missing_anchor: str = "review"
    review: str = "mask_all"
    max_lines: int = 3
    person_labels: tuple[str, ...] = ()
    address_labels: tuple[str, ...] = ()
    padding: int = 2

    def __post_init__(self) -> None:
        known = {*CATEGORIES, *(c for c, _ in ENTITIES.values())}
        for name, allowed in (("execution", EXECUTION), ("merge", MERGE), ("invalid_checksum", ACTIONS), ("missing_context", ACTIONS), ("missing_anchor", ACTIONS), ("review", REVIEWS), ("strictness", STRICTNESS), ("ner_scope", ("semantic", "all"))):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}")
        for name, low, high in (("min_confidence", 0, 1), ("min_risk", 1, 5), ("min_context", 0, 3), ("ner_delta", -0.5, 0.5), ("max_lines", 1, 3), ("padding", 0, 50), ("sensitivity", 1, 4)):
            if not low <= getattr(self, name) <= high:
                raise ValueError(f"{name} must be between {low} and {high}")
        for c in (*self.categories, *self.anchor_required):
            if c not in known:
                raise ValueError(f"unknown category: {c}")
        for e in self.ner_entities:
            if e not in ENTITIES:
                raise ValueError(f"unknown entity: {e}")
        for name in ("person_labels", "address_labels"):
            object.__setattr__(self, name, tuple(dict.fromkeys(x for x in ("".join(v.split()) for v in getattr(self, name)) if x)))

    @property
    def ner_categories(self) -> tuple[str, ...]:
        """Categories that the model's entities of this policy may give."""
        chosen = self.ner_entities or (SEMANTIC if self.ner_scope == "semantic" else tuple(ENTITIES))
        out: list[str] = []
        for e in chosen:
            out += ["resident_registration_number", "foreigner_registration_number", "id_card_number"] if e == "IDCARD" else [ENTITIES[e][0]]
        return tuple(dict.fromkeys(out))


#: What each sensitivity level sets.
PRESETS = {
    1: Policy(name="precise", sensitivity=1, strictness="exact", checksum=True, min_risk=3, invalid_checksum="exclude", min_context=1, missing_context="exclude", ner_delta=0.05, review="exclude_review"),
    2: Policy(name="standard", sensitivity=2, strictness="normalized", checksum=True, min_risk=2, invalid_checksum="review", min_context=1, missing_context="review", ner_delta=0.0, review="mask_all"),
    3: Policy(name="sensitive", sensitivity=3, strictness="recovered", checksum=True, min_risk=1, invalid_checksum="mask", min_context=0, missing_context="mask", ner_delta=-0.05, review="mask_all"),
    4: Policy(name="maximum", sensitivity=4, strictness="ocr_tolerant", checksum=False, min_risk=1, invalid_checksum="mask", min_context=0, missing_context="mask", ner_delta=-0.15, review="mask_all"),
}


def preset(level: int) -> Policy:
    if level not in PRESETS:
        raise ValueError("sensitivity levels are 1 to 4")
    return PRESETS[level]


def fixed_policy(checksum: bool) -> Policy:
    """The demonstration policy: normalised forms, all entities, invalid check digits out while they are checked."""
    return Policy(name="fixed", strictness="normalized", ner_scope="all", ner_entities=tuple(ENTITIES), checksum=checksum, invalid_checksum="exclude" if checksum else "mask")


SCHEMA_VERSION = 1


def to_json(policy: Policy) -> str:
    return json.dumps({"schema_version": SCHEMA_VERSION, "policy": asdict(policy)}, ensure_ascii=False, indent=2, sort_keys=True)


def from_json(text: str) -> Policy:
    """A policy from its JSON; missing keys take defaults, unknown or ill-typed ones are refused."""
    data = json.loads(text)
    if not isinstance(data, dict) or data.get("schema_version") != SCHEMA_VERSION:
        raise ValueError(f"schema_version must be {SCHEMA_VERSION}")
    given = data.get("policy", {})
    if not isinstance(given, dict):
        raise ValueError("policy must be an object")
    kinds = {f.name: type(getattr(Policy(), f.name)) for f in fields(Policy)}
    for k, v in given.items():
        if k not in kinds:
            raise ValueError(f"unknown setting: {k}")
        want = (list, tuple) if kinds[k] is tuple else (int, float) if kinds[k] is float else kinds[k]
        if not isinstance(v, want) or isinstance(v, bool) and kinds[k] is not bool:
            raise ValueError(f"{k} must be of type {kinds[k].__name__}")
    return replace(Policy(), **{k: tuple(v) if kinds[k] is tuple else v for k, v in given.items()})


def load(path: str) -> Policy:
    """The policy in a file; without the file, the default."""
    try:
        with open(path, encoding="utf-8") as f:
            return from_json(f.read())
    except FileNotFoundError:
        return Policy()


def save(policy: Policy, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write(to_json(policy) + "\n")


def policies(spark: SparkSession, chosen: list[Policy]) -> DataFrame:
    """Policies as rows."""
    if len(chosen) > MAX_POLICIES:
        raise ValueError(f"at most {MAX_POLICIES} policies at once")
    rows = [(p.name, list(p.categories), p.min_confidence, p.min_risk, p.checksum, p.invalid_checksum, p.min_context, p.missing_context, list(p.anchor_required), p.missing_anchor, p.review) for p in chosen]
    return spark.createDataFrame(rows, "policy string, categories array<string>, min_confidence double, min_risk int, checksum boolean, invalid_checksum string, min_context int, missing_context string, anchor_required array<string>, missing_anchor string, review string")


def _some(evidence: Column, *starts: str) -> Column:
    test = lambda e: F.coalesce(e.rlike("^(?:" + "|".join(x.replace("*", ".*") for x in starts) + ")"), F.lit(False))
    return F.exists(evidence, test)


def gates(evidence: Column, rule_id: Column) -> Column:
    """Sorted kinds of context that the evidence holds: context, field, keyword."""
    by_field = rule_id.startswith("context:") | _some(evidence, "anchor:prefix$", "pos:field_label", "structure:address-field$")
    by_keyword = F.exists(evidence, lambda e: e.startswith("keyword:") & (e != "keyword:None")) | _some(evidence, "anchor:context_keyword", "anchor:주소", "pos:title", "marker:")
    by_context = _some(evidence, "dict:", "layout:", "purpose:", "type:", "position:", "pos:name_", "pos:surname", "pos:particle", "pos:co_occurrence", "pos:deterministic")
    return F.filter(F.array(F.when(by_context, "context"), F.when(by_field, "field"), F.when(by_keyword, "keyword")), lambda x: x.isNotNull())


def anchored(evidence: Column, rule_id: Column) -> Column:
    return rule_id.startswith("context:") | _some(evidence, "anchor:", "keyword:", "context:", "field:")


def _level(action: Column) -> Column:
    return F.when(action == "exclude", 2).when(action == "review", 1).otherwise(0)


def decide(spans: DataFrame) -> DataFrame:
    """Evaluate the gates of each row's policy (columns of :func:`policies` beside those of a span).

    Adds ``action``, ``included``, ``effective_review`` and ``reasons``. A missing category, confidence or risk ends the
    evaluation; after that every gate may raise the action, and reviews are handled last.
    """
    e, rule = F.coalesce("evidence", F.array().cast("array<string>")), F.coalesce("rule_id", F.lit(""))
    risk = F.col("risk_level")
    valid, invalid = F.exists(e, lambda x: x == "checksum:valid"), _some(e, "checksum:invalid", "checksum:fail")
    skipped = F.exists(e, lambda x: x == "checksum:skipped")
    found = gates(e, rule)
    out = (
        F.when(~F.array_contains("categories", F.col("entity_type")), "category not selected")
        .when(F.coalesce("detector_confidence", F.lit(0.0)) < F.col("min_confidence"), "confidence below minimum")
        .when(risk.isNotNull() & (risk < F.col("min_risk")), "risk below minimum")
    )
    bad_sum = F.col("checksum") & ~valid & invalid
    no_context = risk.isNotNull() & (F.col("min_context") > 0) & (F.size(found) < F.col("min_context")) & ~(F.col("checksum") & valid)
    needs_anchor = risk.isNotNull() & F.array_contains("anchor_required", F.col("entity_type"))
    no_anchor = needs_anchor & ~anchored(e, rule)
    explicit = bad_sum | no_context | no_anchor
    level = F.greatest(F.when(bad_sum, _level(F.col("invalid_checksum"))).otherwise(0), F.when(no_context, _level(F.col("missing_context"))).otherwise(0), F.when(no_anchor, _level(F.col("missing_anchor"))).otherwise(0))
    asked = F.coalesce("review_required", F.lit(False))
    waived = asked & explicit & (level == 0)
    final = F.when(asked & ~waived, F.greatest(level, F.lit(1))).otherwise(level)
    included = (final < 2) & ~((final == 1) & (F.col("review") == "exclude_review")) & ~((final != 1) & (F.col("review") == "review_only"))
    told = F.array(
        F.when(F.size(found) > 0, F.concat(F.lit("context: "), F.array_join(found, ", "))),
        F.when(_some(e, "pattern:", "format:", "checksum:", "date_valid:", "date:"), "format evidence"),
        F.when(~F.col("checksum") & (valid | invalid | skipped), "checksum not checked").when(F.col("checksum") & valid, "checksum valid").when(bad_sum, F.concat(F.lit("checksum invalid: "), F.col("invalid_checksum"))),
        F.when(no_context, F.concat(F.lit("context missing: "), F.size(found).cast("string"), F.lit("/"), F.col("min_context").cast("string"), F.lit(": "), F.col("missing_context"))),
        F.when(no_anchor, F.concat(F.lit("anchor missing: "), F.col("missing_anchor"))).when(needs_anchor, "anchor found"),
        F.when(waived, "review waived by an explicit gate").when(asked, "detector asks for review"),
        F.when((final == 1) & (F.col("review") == "exclude_review"), "reviews are excluded").when((final == 1) & (F.col("review") == "review_only"), "reviews only").when(final == 1, "masked, marked for review").when(F.col("review") == "review_only", "not a review"),
    )
    reasons = F.filter(told, lambda x: x.isNotNull())
    reasons = F.when(F.size(reasons) == 0, F.array(F.lit("passed all gates"))).otherwise(reasons)
    review = F.when((final == 1) & ~asked, True).when((final == 0) & waived, False).otherwise(asked)
    return spans.select(
        "*",
        F.when(out.isNotNull(), "exclude").otherwise(F.element_at(F.array(*map(F.lit, ACTIONS)), final + 1)).alias("action"),
        F.when(out.isNotNull(), False).otherwise(included).alias("included"),
        F.when(out.isNotNull(), asked).otherwise(review).alias("effective_review"),
        F.when(out.isNotNull(), F.array(out)).otherwise(reasons).alias("reasons"),
    )


def evaluate(spans: DataFrame, chosen: DataFrame) -> DataFrame:
    """Every span under every policy; the policies are few (:data:`MAX_POLICIES`) and broadcast."""
    return decide(spans.crossJoin(F.broadcast(chosen)))


def included(spans: DataFrame, chosen: DataFrame) -> DataFrame:
    return evaluate(spans, chosen).where("included")


def runs_rules(policy: Policy) -> bool:
    """Whether rules run at all: not for a model alone, nor when routing leaves them no category."""
    if not policy.categories or policy.execution == "ner_only":
        return False
    return policy.execution != "category_routing" or bool(set(policy.categories) - set(policy.ner_categories))


def ner_targets(policy: Policy) -> tuple[str, ...]:
    return tuple(c for c in policy.categories if c in policy.ner_categories)


def ner_wanted(policy: Policy, docs: DataFrame, rule_spans: DataFrame) -> DataFrame:
    """``doc_id, run_ner, missing``: in fallback mode the model runs where a wanted category has no rule span."""
    targets = ner_targets(policy)
    wanted = F.array(*map(F.lit, targets)) if targets else F.array().cast("array<string>")
    if policy.execution != "rules_then_ner":
        run = bool(targets) and policy.execution != "rules_only"
        return docs.select("doc_id", F.lit(run).alias("run_ner"), wanted.alias("missing"))
    seen = rule_spans.groupBy("doc_id").agg(F.collect_set("entity_type").alias("seen"))
    missing = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return docs.select("doc_id").join(seen, "doc_id", "left").select("doc_id", (F.size(missing) > 0).alias("run_ner"), missing.alias("missing"))


def _meeting(a: str, b: str) -> Column:
    """Whether two spans of one document share a token or characters."""
    tokens = F.arrays_overlap(F.col(f"{a}.token_ids"), F.col(f"{b}.token_ids"))
    places = (F.col(f"{a}.raw_start") < F.col(f"{b}.raw_end")) & (F.col(f"{b}.raw_start") < F.col(f"{a}.raw_end"))
    return (F.col(f"{a}.doc_id") == F.col(f"{b}.doc_id")) & (F.coalesce(tokens, F.lit(False)) | places)


def agreeing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Spans of ``a`` with a span of their type in ``b`` that they meet."""
    return a.alias("a").join(b.alias("b"), _meeting("a", "b") & (F.col("a.entity_type") == F.col("b.entity_type")), "left_semi")


def giving_way(rules: DataFrame, ner: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """Rule spans without those of the model's categories that meet a span of the model."""
    contested = F.col("a.entity_type").isin(list(categories)) if categories else F.lit(False)
    return rules.alias("a").join(ner.alias("b"), _meeting("a", "b") & contested, "left_anti")


def combine(rules: DataFrame, ner: DataFrame, policy: Policy) -> DataFrame:
    """Spans of both providers as the policy merges them, before deduplication."""
    if policy.execution == "category_routing":
        own = F.col("entity_type").isin(list(policy.ner_categories)) if policy.ner_categories else F.lit(False)
        rules, ner = rules.where(~own), ner.where(own)
    if policy.merge == "agreement":
        rules, ner = agreeing(rules, ner), agreeing(ner, rules)
    elif policy.merge == "category_priority":
        rules = giving_way(rules, ner, ner_targets(policy))
    return rules.unionByName(ner)


def decisions(evaluated: DataFrame, final: DataFrame) -> DataFrame:
    """One decision for each input span; those included that the merge dropped are excluded with that reason."""
    key = ["doc_id", "entity_type", "token_ids", "rule_id"]
    there = final.select(*key).distinct().withColumn("_there", F.lit(True))
    lost = F.col("included") & F.col("_there").isNull()
    out = evaluated.join(there, key, "left")
    return out.select(
        *(c for c in evaluated.columns if c not in ("action", "included", "reasons")),
        F.when(lost, "exclude").otherwise(F.col("action")).alias("action"),
        (F.col("included") & ~lost).alias("included"),
        F.when(lost, F.concat("reasons", F.array(F.lit("dropped by the merge")))).otherwise(F.col("reasons")).alias("reasons"),
    )
