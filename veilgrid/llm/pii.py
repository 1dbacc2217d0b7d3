"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose candidate spans. Labelers (format, checksum, gazetteer, context, boundary, shape) each vote for,
against, or abstain. Expectation-maximisation estimates how reliable each labeler is from how votes agree over all
candidates of all documents. Its posteriors are the targets of the span classifier, a logistic model with features of its
own: the kind's length, separators, character mix and repetition of the value, the characters round it, and
the words before it. So a span that no labeler knows is judged by what it looks like and where it stands.

Candidates are counted by votes and features before they leave the executors. The estimation reads the counts by vote
pattern, kinds x 3^labelers rows at most, whatever the input's size; the classifier is fitted to at most ``max_patterns``
rows of equal votes and features, the most frequent ones.
No text and no value is ever written: candidates are found again when the classifier is applied.

The gazetteers hold domains, calling codes, card issuers and countries of account numbers. There are none of names or
places, as no kind here is one.

Base spans (valid e-mail addresses, IPv4 addresses, card and telephone numbers) always stay; the classifier
decides on the rest. Positions are code points, end exclusive.

Cases: a null or empty text has no spans. Repeated rows each get a row. Texts are read whole; patterns start only
where a run of their characters starts and use possessive repeats, so long runs cost one pass; places are added up in blocks of
128, whose copying grows with the square of the matches in one text (4,000 took 9 s). Without any candidate the classifier is never asked. An empty table gives an empty one. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _small(x: Column) -> Column:
    """A-Z as a-z: all that the words looked for need. ``lower`` first prepares tables of every character, seconds in each executor."""
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``there`` is a cheap test of a whole text, ``valid`` the format's own rule for a match."""

    name: str
    pattern: str
    there: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    base: bool = False


#: In the order of the result. The first four are the base kinds.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: F.contains(t, F.lit("@")), lambda v: F.lit(True), True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), lambda v: F.length(_digits(v)).between(16, 19) & _luhn(_digits(v)), True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: F.contains(t, F.lit("+")), lambda v: F.length(_digits(v)).between(8, 15), True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", lambda t: t.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"), lambda v: F.length(F.regexp_replace(v, " ", "")).between(15, 34)),
    Kind("local_phone", r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])", lambda t: t.rlike(r"[0-9]{3}[.-][0-9]{4}"), lambda v: ~_digits(v).rlike("^[01]")),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"), lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$")),
    Kind("secret", r"(?<![A-Za-z0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])", lambda t: t.rlike("[0-9a-f]{32}"), lambda v: v.rlike("[0-9]") & v.rlike("[a-f]")),
)
NAMES = tuple(k.name for k in KINDS)

#: Fixed values of the gazetteers: common top-level domains, calling codes and card issuers' first digits.
DOMAINS = "com|org|net|edu|gov|io|info|biz|int|eu|us|uk|de|fr|es|it|nl|ch|at|be|pl|se|no|dk|fi|pt|ie|ca|au|nz|jp|kr|cn|in|br|mx"
CALLING_CODES = "1|7|20|27|3[0-69]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|35|6011|64|65|62"
ACCOUNT_COUNTRIES = "AD|AE|AL|AT|AZ|BA|BE|BG|BH|BR|CH|CY|CZ|DE|DK|EE|EG|ES|FI|FO|FR|GB|GE|GI|GL|GR|HR|HU|IE|IL|IS|IT|KW|KZ|LB|LI|LT|LU|LV|MC|MD|ME|MK|MT|NL|NO|PK|PL|PT|QA|RO|RS|SA|SE|SI|SK|SM|TN|TR|UA|XK"

#: Words near a span that speak for its kind, and words that speak against any.
CUES = {
    "email": "mail|contact|write|reach|courriel|correo",
    "ip": "ip|host|server|address|login|client",
    "card": "card|visa|mastercard|credit|debit|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|mobile|fax|telefon|telefono",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "local_phone": "phone|tel|call|mobile|fax|telefon|telefono",
    "national_id": "ssn|social|security|id",
    "secret": "token|key|secret|password|apikey|bearer",
}
AGAINST = "version|release|isbn|issn|order|invoice|build|commit|sha1|md5|sha256|page|section|checksum"

LABELERS = ("format", "checksum", "gazetteer", "context", "boundary", "shape")
BEFORE = 48

#: Matches added up at once: each step of a fold copies what it has so far, so blocks are folded before they are joined.
BLOCK = 128

FEATURES = ("valid", "length", "signs", "mix", "variety", "left", "right", "word", "line")


def _once(value: Column) -> Column:
    """The value, worked out once for all that read it: projections are merged with their readers unless they look random."""
    return F.when(F.rand(0) >= 0, value)


def _spans(found: Column, gaps: Column) -> Column:
    """Matches with their places, by a running length over the text between them, block by block."""
    kind = "array<struct<start:bigint,stop:bigint,value:string,before:string,after:string>>"

    def add(acc: Column, i: Column) -> Column:
        gap, value = F.get(gaps, i), F.get(found, i)
        start = acc["pos"] + F.length(gap)
        stop = start + F.length(value)
        item = F.struct(start.alias("start"), stop.alias("stop"), value.alias("value"), F.right(gap, F.lit(BEFORE)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))
        return F.struct(stop.alias("pos"), F.concat(acc["out"], F.array(item)).alias("out"))

    empty, blocks = F.from_json(F.lit("[]"), kind), F.from_json(F.lit("[]"), f"array<{kind}>")

    def add_block(acc: Column, b: Column) -> Column:
        block = F.aggregate(F.sequence(b, F.least(b + BLOCK, F.size(found)) - 1), F.struct(acc["pos"].alias("pos"), empty.alias("out")), add)
        return F.struct(block["pos"].alias("pos"), F.concat(acc["out"], F.array(block["out"])).alias("out"))

    begin = F.struct(F.lit(0).cast("bigint").alias("pos"), blocks.alias("out"))
    folded = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1, F.lit(BLOCK)), begin, add_block, lambda acc: F.flatten(acc["out"]))
    return F.when(F.size(found) > 0, folded).otherwise(empty)


def candidates(df: DataFrame) -> DataFrame:
    """``doc_id`` and all candidates in ``spans``: kind, start, stop, value, context, and whether it is a base span."""
    t = F.col("t")
    texts = df.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    none = F.array().cast("array<string>")
    parts = [F.col("doc_id")]
    for k in KINDS:
        there = k.there(t)
        # patterns run once for each text, not once for each match
        parts.append(_once(F.when(there, F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))).otherwise(none)).alias(f"m_{k.name}"))
        parts.append(_once(F.when(there, F.split(t, k.pattern, -1)).otherwise(none)).alias(f"g_{k.name}"))
    split = texts.select(*parts)
    placed = split.select("doc_id", *(_spans(F.col(f"m_{k.name}"), F.col(f"g_{k.name}")).alias(k.name) for k in KINDS))

    def named(k: Kind) -> Column:
        return F.transform(k.name, lambda x: F.struct(F.lit(k.name).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"), k.valid(x["value"]).alias("valid"), (F.lit(k.base) & k.valid(x["value"])).alias("base")))

    spans = F.concat(*(named(k) for k in KINDS))
    return placed.select("doc_id", _once(spans).alias("spans"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(x: Column) -> list[Column]:
    """One vote of each labeler on a candidate: 1, -1, or 0 where it abstains."""
    kind, value = x["kind"], x["value"]
    digits = _digits(value)
    is_card, is_mail, is_phone, is_ip, is_secret = (kind == k for k in ("card", "email", "phone", "ip", "secret"))
    before = _small(x["before"])
    cue = F.coalesce(*(F.when(kind == k, before.rlike(rf"(?:^|[^a-z])(?:{words})[^a-z]*(?:[a-z]+[^a-z]+)?$")) for k, words in CUES.items()))
    against = before.rlike(rf"(?:^|[^a-z])(?:{AGAINST})[^a-z]*$")
    first = F.when(is_phone, digits.rlike(f"^(?:{CALLING_CODES})")).when(is_card, digits.rlike(f"^(?:{ISSUERS})")).when(is_mail, _small(value).rlike(rf"\.(?:{DOMAINS})$")).when(is_ip, ~value.rlike(r"^(?:0|127|255|22[4-9]|23[0-9])\.")).when(kind == "iban", value.rlike(f"^(?:{ACCOUNT_COUNTRIES})"))
    edge = F.regexp_extract(x["before"], "(.)$", 1).rlike("[A-Za-z0-9]") | x["after"].rlike("[A-Za-z0-9]")
    flat = digits.rlike(r"^([0-9])\1+$") | digits.rlike("^0?12345678")
    long_enough = F.when(is_card, F.length(digits).between(15, 19)).when(is_phone, F.length(digits).between(10, 13)).when(is_secret, F.length(value).isin(32, 40, 64, 128))
    return [
        _vote(x["valid"], ~x["valid"]),
        F.when(is_card, _vote(_luhn(digits), ~_luhn(digits))).otherwise(0),
        F.when(first.isNull(), 0).otherwise(_vote(first, ~first)),
        _vote(cue & ~against, against),
        _vote(~edge, edge),
        F.when(flat, -1).when(long_enough.isNull(), 0).otherwise(_vote(long_enough, ~long_enough)),
    ]


def features(x: Column) -> list[Column]:
    """What the classifier sees of a candidate: short names of few values each."""
    value, before = x["value"], _small(x["before"])
    bare = F.regexp_replace(value, "[^A-Za-z0-9]", "")
    size = F.length(value)
    length = F.when(size < 8, "under 8").when(size < 12, "8").when(size < 16, "12").when(size < 20, "16").when(size < 32, "20").otherwise("32")
    sign = lambda c, name: F.when(F.contains(value, F.lit(c)), F.lit(name)).otherwise(F.lit(""))
    signs = F.concat(sign(" ", "space "), sign("-", "hyphen "), sign(".", "dot "), sign("(", "bracket "))
    mix = F.concat(*(F.when(value.rlike(p), F.lit(n)).otherwise(F.lit("")) for p, n in (("[0-9]", "0"), ("[a-z]", "a"), ("[A-Z]", "A"))))
    distinct = F.size(F.array_distinct(F.split(bare, ""))) - 1
    variety = F.when(distinct * 4 <= F.length(bare), "low").when(distinct * 2 <= F.length(bare), "middle").otherwise("high")
    kind_of = lambda c: F.when(c == "", "edge").when(c.rlike("[\\s]"), "space").when(c.rlike("[A-Za-z0-9]"), "letter").when(c.rlike("[\"'(\\[<{}>\\])]"), "bracket").otherwise("sign")
    word = F.regexp_extract(before, r"([a-z][a-z0-9]*)[^a-z]*$", 1)
    near = F.when(word == "", "none").when(word.rlike(rf"^(?:{AGAINST})"), "against").when(F.coalesce(*(F.when(x["kind"] == k, word.rlike(rf"^(?:{w})")) for k, w in CUES.items())), "own").when(word.rlike("^(?:" + "|".join(CUES.values()) + ")"), "other kind").otherwise("other")
    line = F.when(before.rlike(r"(?:^|\n)\s*$"), "first").when(before.rlike(r"[:=]\s*[\"']?$"), "after a sign").otherwise("inside")
    return [x["valid"].cast("string"), length, signs, mix, variety, kind_of(F.right(x["before"], F.lit(1))), kind_of(x["after"]), near, line]


@dataclass(frozen=True)
class Classifier:
    """Logistic weights: one for each kind, and one for each value of each feature within a kind."""

    kind: dict[str, float]
    weights: dict[tuple[str, str, str], float]
    reliability: tuple[tuple[float, float], ...]

    def probability(self, x: Column) -> Column:
        z = F.coalesce(*(F.when(x["kind"] == k, F.lit(w)) for k, w in self.kind.items()), F.lit(0.0))
        for name, value in zip(FEATURES, features(x), strict=True):
            own = [(f"{k} {v}", w) for (k, n, v), w in self.weights.items() if n == name]
            if own:
                table = F.create_map(*(F.lit(v) for pair in own for v in pair))
                z = z + F.coalesce(F.try_element_at(table, F.concat_ws(" ", x["kind"], value)), F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def logistic(rows: list[tuple[str, tuple[str, ...], float, float]], decay: float = 1e-3, rounds: int = 300) -> tuple[dict[str, float], dict[tuple[str, str, str], float]]:
    """Weights for rows of (kind, features, target, weight), by gradient steps of the mean logistic loss of each kind."""
    kinds: dict[str, float] = {}
    weights: dict[tuple[str, str, str], float] = {}
    for kind in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == kind]
        names = sorted({(n, v) for _, f, _, _ in own for n, v in zip(FEATURES, f, strict=True)})
        place = {x: i for i, x in enumerate(names)}
        at = np.array([[place[x] for x in zip(FEATURES, f, strict=True)] for _, f, _, _ in own])
        target, share = np.array([r[2] for r in own]), np.array([r[3] for r in own], float)
        share /= share.sum()
        w, bias = np.zeros(len(names)), 0.0
        for _ in range(rounds):
            g = (1 / (1 + np.exp(-np.clip(bias + w[at].sum(1), -60, 60))) - target) * share
            step = np.bincount(at.ravel(), np.repeat(g, at.shape[1]), len(names))
            bias -= 0.8 * float(g.sum())
            w -= 0.8 * (step + decay * w)
        kinds[kind] = bias
        weights |= {(kind, n, v): float(w[i]) for (n, v), i in place.items()}
    return kinds, weights


def estimate(counts: list[tuple[str, tuple[int, ...], int]], rounds: int = 60) -> tuple[list[float], tuple[tuple[float, float], ...]]:
    """Expectation-maximisation over counted votes: posteriors by pattern, and each labeler's two reliabilities.

    Begins at the majority of votes. A kind has a share of true spans of its own; a labeler that abstains says nothing.
    """
    q = [min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for _, v, _ in counts]
    width = len(LABELERS)
    rates: list[tuple[float, float]] = []
    for _ in range(rounds):
        rates = []
        for j in range(width):
            hit = [[1.0, 1.0], [1.0, 1.0]]  # [class][vote for], with a prior count each
            for p, (_, v, n) in zip(q, counts, strict=True):
                if v[j]:
                    hit[1][v[j] > 0] += p * n
                    hit[0][v[j] > 0] += (1 - p) * n
            rates.append((hit[1][1] / sum(hit[1]), hit[0][1] / sum(hit[0])))
        share: dict[str, list[float]] = {}
        for p, (k, _, n) in zip(q, counts, strict=True):
            s = share.setdefault(k, [1.0, 2.0])
            s[0] += p * n
            s[1] += n
        new = []
        for k, v, _ in counts:
            a = math.log(share[k][0]) - math.log(share[k][1] - share[k][0] + 1e-9)
            for j in range(width):
                if v[j]:
                    t, f = rates[j]
                    a += math.log(t / f) if v[j] > 0 else math.log((1 - t) / (1 - f))
            new.append(1 / (1 + math.exp(-max(-60.0, min(60.0, a)))))
        moved = max((abs(a - b) for a, b in zip(q, new, strict=True)), default=0.0)
        q = new
        if moved < 1e-6:
            break
    return q, tuple(rates)


def train(found: DataFrame, max_patterns: int = 20_000) -> Classifier:
    """Estimate reliabilities from all candidates, then fit the span classifier to the posteriors."""
    x = F.col("x")
    named = [v.alias(n) for v, n in zip(votes(x), LABELERS, strict=True)] + [v.alias(f"f_{n}") for v, n in zip(features(x), FEATURES, strict=True)]
    flat = found.select(F.explode("spans").alias("x")).select(x["kind"].alias("kind"), *named)
    own = [f"f_{n}" for n in FEATURES]
    counted = flat.groupBy("kind", *LABELERS, *own).agg(F.count("*").alias("n"))  # counts of names, no values
    # few rows: a file for each core at most, not for each shuffle partition, as on a local disk each file makes the executor start processes (chmod)
    patterns = common.stored(counted.coalesce(found.sparkSession.sparkContext.defaultParallelism), "pii-patterns")
    rows = patterns.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")).orderBy("kind", *LABELERS).collect()  # kinds x 3^labelers rows at most
    counts = [(r["kind"], tuple(int(r[n]) for n in LABELERS), int(r["n"])) for r in rows]
    q, rates = estimate(counts)
    target = {(k, v): p for p, (k, v, _) in zip(q, counts, strict=True)}
    some = patterns.orderBy(F.col("n").desc(), "kind", *LABELERS, *own).limit(max_patterns).collect()  # bounded by max_patterns
    common.drop(patterns)
    kinds, weights = logistic([(r["kind"], tuple(r[n] for n in own), target[r["kind"], tuple(int(r[n]) for n in LABELERS)], r["n"]) for r in some])
    return Classifier(kinds, weights, rates)


def detect(df: DataFrame, threshold: float = 0.5, model: Classifier | None = None) -> DataFrame:
    """``doc_id`` and the accepted ``spans`` of each document: base spans, and others the classifier takes."""
    found = candidates(df)
    model = model or train(found)
    taken = F.filter("spans", lambda x: x["base"] | (model.probability(x) >= threshold))
    return found.select("doc_id", _once(taken).alias("spans"))


def digest(df: DataFrame) -> DataFrame:
    """Counts and digests of :func:`detect`."""
    found = detect(df)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long")

    base = F.filter("spans", lambda x: x["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in NAMES[:4]), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
