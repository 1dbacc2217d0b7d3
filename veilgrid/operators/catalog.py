"""The rule catalogue as data, and its evaluation over texts.

A rule proposes spans by pattern and may ask for a valid value and for a label right before it. Scores and risks
follow the documented levels (format 1.0, context 0.9, weaker formats 0.85, identity numbers 1.0 or 0.7 by
check digit). Rules whose wording is this project's own, for want of a public definition, are marked ``own``.
All patterns are Java regular expressions over code points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilgrid.functions import identifiers as ids
from veilgrid.functions.labels import SURNAMES
from veilgrid.functions.offsets import located

#: Risk levels, from information to critical.
INFO, LOW, MEDIUM, HIGH, CRITICAL = 1, 2, 3, 4, 5
AS_OF = "2026-01-01"

Check = Callable[[Column, str], Column]


@dataclass(frozen=True)
class Rule:
    """``valid`` must hold; ``checksum`` only moves the score between ``score`` and ``weak`` and adds evidence.

    ``around``: characters at the front and the back of what the pattern takes that are not part of the value.
    """

    label: str
    category: str
    pattern: str
    score: float
    risk: int
    valid: Check | None = None
    checksum: Check | None = None
    weak: float | None = None
    anchors: tuple[str, ...] = ()
    evidence: str = "format:full"
    own: bool = False
    around: tuple[int, int] = (0, 0)


NUMBER_EDGE = r"(?<![0-9])", r"(?![0-9])"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
REGION = "(?:서울|부산|대구|인천|광주|대전|울산|세종|경기|강원|충북|충남|전북|전남|경북|경남|제주)(?:특별자치시|특별자치도|특별시|광역시|도)?"


def _long(least: int, most: int) -> Check:
    return lambda v, as_of: F.length(ids.digits(v)).between(least, most)


RULES: tuple[Rule, ...] = (
    Rule("RRN", "resident_registration_number", r"(?<![0-9])[0-9]{6}[-./]?[0-9]{7}(?![0-9])", 1.0, CRITICAL, lambda v, d: ids.resident_shape(v, d, False), lambda v, d: ids.resident_check(v), 0.7),
    Rule("FRN", "foreigner_registration_number", r"(?<![0-9])[0-9]{6}[-./]?[0-9]{7}(?![0-9])", 1.0, CRITICAL, lambda v, d: ids.resident_shape(v, d, True), lambda v, d: ids.resident_check(v), 0.7),
    Rule("BUSINESS_REG", "business_registration_number", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{5}(?![0-9-])", 1.0, MEDIUM, lambda v, d: ids.business_check(v), evidence="checksum:valid"),
    Rule("CORP_REG", "corporate_registration_number", r"(?<![0-9-])[0-9]{6}-?[0-9]{7}(?![0-9-])", 1.0, MEDIUM, lambda v, d: ids.corporate_check(v), evidence="checksum:valid"),
    Rule("CARD", "account_card_number", r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])", 1.0, HIGH, lambda v, d: ids.luhn(v), evidence="checksum:valid"),
    Rule("ACCOUNT", "account_card_number", r"(?<![0-9-])[0-9]{2,6}(?:-[0-9]{2,6}){1,4}(?![0-9-])", 0.9, HIGH, _long(10, 16), anchors=("계좌번호", "계좌", "예금", "account", "Account"), evidence="anchor:prefix"),
    Rule("PASSPORT", "passport_number", r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{8}(?![A-Za-z0-9])", 0.9, HIGH, lambda v, d: ids.passport(v)),
    Rule("DRIVER_LICENSE", "driver_license_number", r"(?<![0-9-])[0-9]{2}-[0-9]{2}-[0-9]{6}-[0-9]{2}(?![0-9-])", 0.85, HIGH, lambda v, d: ids.license_number(v, F.lit(False))),
    Rule("DRIVER_LICENSE", "driver_license_number", r"(?<![0-9-])[0-9]{12}(?![0-9-])", 0.85, HIGH, lambda v, d: ids.license_number(v, F.lit(True)), anchors=("운전면허번호", "면허번호", "운전면허"), evidence="anchor:prefix"),
    Rule("EMAIL", "email_address", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+", 1.0, MEDIUM, lambda v, d: ids.email(v)),
    Rule("PHONE", "phone_number", r"(?<![0-9-])(?:\+82[ .-]?|0)(?:1[016789]|2|[3-6][1-5]|70|50[2-8])[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9-])", 1.0, MEDIUM),
    Rule("PHONE", "phone_number", r"\+(?!82)[1-9][0-9 ().-]{6,20}[0-9](?![0-9])", 1.0, MEDIUM, _long(8, 15)),
    Rule("PHONE", "phone_number", r"(?<![0-9A-Za-z-])1[5-8][0-9]{2}-?[0-9]{4}(?![0-9A-Za-z-])", 0.85, LOW),
    Rule("FAX", "phone_number", r"(?<![0-9-])0[2-7][0-9]?[ .)-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9-])", 0.85, LOW, anchors=("팩스", "FAX", "Fax"), evidence="anchor:prefix"),
    Rule("IP", "ip_address", rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9.]*[0-9])", 1.0, LOW),
    Rule("URL", "url", r"(?i)\b(?:https?://|www\.)[^\s<>\"'가-힣]+[^\s<>\"'가-힣.,;:!?)]", 0.9, INFO),
    Rule("VEHICLE", "vehicle_plate_number", r"(?<![0-9가-힣])(?:[가-힣]{2})?[0-9]{2,3}[가-힣][0-9]{4}(?![0-9])", 0.85, MEDIUM),
    Rule("MEDICAL_INSURANCE", "health_insurance_number", r"(?<![0-9-])[1-9][0-9]{10}(?![0-9-])|(?<![0-9-])[0-9]-[0-9]{10}(?![0-9-])", 0.9, HIGH, anchors=("건강보험증번호", "건강보험번호", "보험증번호"), evidence="anchor:prefix"),
    Rule("DT_BIRTH", "date", r"(?<![0-9])(?:19|20)[0-9]{2}(?:[-./] ?[0-9]{1,2}[-./] ?[0-9]{1,2}|년 ?[0-9]{1,2}월 ?[0-9]{1,2}일)(?![0-9])", 0.95, MEDIUM, anchors=("생년월일", "출생연월일", "출생일", "생일"), evidence="anchor:prefix"),
    Rule("ADDRESS", "address", rf"{REGION} ?(?:[가-힣]{{1,10}}[시군구] ?){{1,2}}(?:[가-힣0-9]{{1,12}}[읍면동] ?)?[가-힣0-9]{{1,16}}(?:대로|번길|로|길) ?[0-9]{{1,5}}(?:-[0-9]{{1,5}})?", 0.8, MEDIUM, evidence="type:road", own=True),
    Rule("ADDRESS", "address", rf"{REGION} ?(?:[가-힣]{{1,10}}[시군구] ?){{1,2}}[가-힣0-9]{{1,12}}[읍면동리가] ?(?:산 ?)?[0-9]{{1,5}}(?:-[0-9]{{1,5}})?(?:번지)?", 0.75, MEDIUM, evidence="type:lot", own=True),
    Rule("PERSON", "person_name", rf"(?<![가-힣])[{SURNAMES}][가-힣]{{1,3}}(?![가-힣])", 0.85, MEDIUM, anchors=("대표이사", "대표자", "성명", "이름", "신청인", "신청자", "예금주", "보호자", "대리인", "담당자", "원고", "피고"), evidence="pos:field_label", own=True),
    Rule("SECRET", "credential_secret", r"(?<![A-Za-z0-9])[0-9a-f]{40}(?![A-Za-z0-9])", 0.9, HIGH, anchors=('token="', 'token=', "token:", "secret=", "key="), evidence="anchor:prefix", own=True),
    Rule("PNU", "land_lot_number", r"(?<![0-9])[0-9]{19}(?![0-9])", 0.85, LOW, anchors=("토지고유번호", "고유번호", "PNU"), evidence="anchor:prefix", own=True),
    Rule("PRESCRIPTION_ID", "prescription_number", r"(?<![0-9])[0-9]{8}-?[0-9]{5}(?![0-9])", 0.85, MEDIUM, anchors=("처방전번호", "교부번호", "처방번호"), evidence="anchor:prefix", own=True),
    Rule("EDI_DRUG", "drug_code", r"(?<![0-9])[0-9]{9}(?![0-9])", 0.85, LOW, anchors=("약품코드", "보험코드", "의약품코드"), evidence="anchor:prefix", own=True),
    Rule("EMPLOYEE_ID", "employee_number", r"(?<![A-Za-z0-9])[A-Z]{0,3}[0-9]{4,10}(?![A-Za-z0-9])", 0.85, MEDIUM, anchors=("사번", "직원번호", "사원번호"), evidence="anchor:prefix", own=True),
    Rule("PETITION_ID", "petition_number", r"(?<![A-Z0-9])[0-9][A-Z]{2}-[0-9]{4}-[0-9]{6,7}(?![0-9])", 0.85, LOW, own=True),
    Rule("COURT_CASE", "court_case_number", r"(?<![0-9])(?:19|20)[0-9]{2}(?:가단|가합|가소|고단|고합|구합|구단|나|노|다|도|두|드단|드합|카합|카단|타경|머|차)[0-9]{1,7}(?![0-9])", 0.85, LOW, own=True),
    Rule("POSTAL_CODE", "postal_code", r"(?<![0-9-])[0-9]{5}(?![0-9-])", 0.85, INFO, anchors=("우편번호", "우"), evidence="anchor:prefix", own=True),
    Rule("DOC_ID", "document_number", r"(?<![가-힣A-Za-z0-9])(?:[가-힣A-Za-z]{1,12}-)?[0-9]{2,6}(?:-[0-9]{1,8}){0,2}(?![0-9-])", 0.85, INFO, anchors=("문서번호", "발급번호", "접수번호"), evidence="anchor:prefix", own=True),
    Rule("NATIONALITY", "nationality", r"(?<![가-힣])(?:대한민국|한국|미국|중국|일본|베트남|필리핀|태국|캐나다|영국|프랑스|독일)(?![가-힣])", 0.85, INFO, anchors=("국적",), evidence="anchor:prefix", own=True),
    Rule("EDUCATION", "education_history", r"[가-힣]{2,12}(?:대학교|대학원|고등학교)(?: ?(?:졸업|재학|수료|중퇴))?", 0.85, INFO, anchors=("학력", "최종학력", "출신학교"), evidence="anchor:prefix", own=True),
    Rule("MAJOR", "academic_major", r"[가-힣]{2,14}(?:학과|전공|공학|학부)", 0.85, INFO, anchors=("전공", "학과"), evidence="anchor:prefix", own=True),
    Rule("POSITION", "job_position", r"(?<![가-힣])(?:사원|주임|대리|과장|차장|부장|이사|상무|전무|부사장|사장|팀장|실장|본부장|연구원)(?![가-힣])", 0.85, INFO, anchors=("직책", "직위", "직급"), evidence="anchor:prefix", own=True),
    Rule("AGE", "age", r"(?<![0-9])1?[0-9]{1,2} ?세(?![가-힣])", 0.85, INFO, anchors=("나이", "연령", "만"), evidence="anchor:prefix", own=True),
    Rule("HEIGHT", "height", r"(?<![0-9.])[12]?[0-9]{2}(?:\.[0-9])? ?(?:cm|㎝|센티미터)", 0.85, INFO, anchors=("신장", "키"), evidence="anchor:prefix", own=True),
    Rule("WEIGHT", "weight", r"(?<![0-9.])[0-9]{2,3}(?:\.[0-9])? ?(?:kg|㎏|킬로그램)", 0.85, INFO, anchors=("체중", "몸무게"), evidence="anchor:prefix", own=True),
)

#: Patterns that stand in for a failed or skipped check digit; each needs its label or a hyphen.
RELAXED: tuple[Rule, ...] = (
    Rule("BUSINESS_REG", "business_registration_number", r"(?<![0-9])[0-9]{3}-?[0-9]{2}-?[0-9]{5}(?![0-9])", 0.65, MEDIUM, anchors=("사업자등록번호", "사업자번호"), evidence="checksum:skipped"),
    Rule("RRN", "resident_registration_number", r"(?<![0-9])[0-9]{6}-[0-49][0-9]{6}(?![0-9])", 0.65, CRITICAL, evidence="checksum:skipped"),
    Rule("FRN", "foreigner_registration_number", r"(?<![0-9])[0-9]{6}-[5-8][0-9]{6}(?![0-9])", 0.65, CRITICAL, evidence="checksum:skipped"),
    Rule("CORP_REG", "corporate_registration_number", r"(?<![0-9])[0-9]{6}-?[0-9]{7}(?![0-9])", 0.65, MEDIUM, anchors=("법인등록번호", "법인번호"), evidence="checksum:skipped"),
    Rule("CARD", "account_card_number", r"(?<![0-9])(?:[0-9][ -]?){12,18}[0-9](?![0-9])", 0.65, HIGH, anchors=("카드번호", "신용카드번호"), evidence="checksum:skipped"),
)
#: One rule for each kind that plain tables are counted by, as their SQL states it: no national forms, ASCII word edges, and each match
#: the longest from the leftmost place behind the last one, so that a match that fails its check is not retried.
PLAIN: tuple[Rule, ...] = (
    Rule("EMAIL", "email_address", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 1.0, MEDIUM, lambda v, d: ids.email(v)),
    Rule("IP", "ip_address", r"(?<![0-9])[0-9]++(?:\.[0-9]++)++", 1.0, LOW, lambda v, d: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
    Rule("PHONE", "phone_number", r"\+[1-9][0-9 ().-]{6,20}[0-9]", 1.0, MEDIUM, _long(8, 15)),
    Rule("CARD", "account_card_number", r"(?<![0-9A-Za-z_])[0-9]{13,19}(?![0-9A-Za-z_])", 1.0, HIGH, lambda v, d: ids.luhn(v), evidence="checksum:valid"),
    Rule("SECRET", "credential_secret", r"token = [^\n][0-9a-f]{40}[^\n]", 0.9, HIGH, evidence="anchor:prefix", own=True, around=(9, 1)),
)

#: Relaxed identity numbers are not taken right behind a corporate label.
RELAXED_NOT_AFTER = {"RRN": ("법인등록번호", "법인번호"), "FRN": ("법인등록번호", "법인번호")}

MATCH = "struct<label:string,category:string,start:int,stop:int,value:string,confidence:double,risk:int,evidence:array<string>>"


def near_prefix(text: Column, start: Column, labels: Iterable[str], reach: int = 32) -> Column:
    """Whether one of the labels stands right before ``start``: white space goes first, then the separators at the end."""
    begin = F.greatest(start - reach, F.lit(0))
    prefix = F.regexp_replace(F.regexp_replace(text.substr(begin + 1, start - begin), "(?U)\\s", ""), "[:：-]+$", "")
    return prefix.rlike("(?:" + "|".join("\\Q" + "".join(x.split()) + "\\E" for x in labels) + ")$")


def _applied(text: Column, rule: Rule, as_of: str) -> Column:
    """All matches of a rule in a text."""

    def keep(x: Column) -> Column:
        ok = F.lit(True) if rule.valid is None else F.coalesce(rule.valid(x["value"], as_of), F.lit(False))
        if rule.anchors:
            ok = ok & near_prefix(text, x["start"], rule.anchors)
        not_after = RELAXED_NOT_AFTER.get(rule.label, ()) if rule.evidence == "checksum:skipped" else ()
        return ok & ~near_prefix(text, x["start"], not_after) if not_after else ok

    def named(x: Column) -> Column:
        if rule.checksum is None:
            score, told = F.lit(rule.score), F.array(F.lit(rule.evidence))
        else:
            passed = F.coalesce(rule.checksum(x["value"], as_of), F.lit(False))
            score = F.when(passed, rule.score).otherwise(rule.weak)
            told = F.array(F.lit("date_valid:birth"), F.when(passed, "checksum:valid").otherwise("checksum:invalid"))
        return F.struct(F.lit(rule.label).alias("label"), F.lit(rule.category).alias("category"), x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), score.cast("double").alias("confidence"), F.lit(rule.risk).alias("risk"), told.alias("evidence"))

    def inner(x: Column) -> Column:
        front, back = rule.around
        return F.struct((x["start"] + front).alias("start"), (x["stop"] - back).alias("stop"), x["value"].substr(F.lit(front + 1), F.length(x["value"]) - front - back).alias("value"))

    found = located(text, rule.pattern)
    return F.transform(F.filter(F.transform(found, inner) if any(rule.around) else found, keep), named)


def rules_for(categories: Iterable[str] | None = None, relaxed: bool = False) -> tuple[Rule, ...]:
    wanted = None if categories is None else set(categories)
    return tuple(r for r in (*RULES, *(RELAXED if relaxed else ())) if wanted is None or r.category in wanted)


def matches_in(text: Column, categories: Iterable[str] | None = None, relaxed: bool = False, as_of: str = AS_OF) -> Column:
    """``array<MATCH>`` of all rules of the categories, in catalogue order."""
    return applied(text, rules_for(categories, relaxed), as_of)


def applied(text: Column, rules: Iterable[Rule], as_of: str = AS_OF, instead: dict[str, Column] | None = None) -> Column:
    """``array<MATCH>`` of some rules, in their order. ``instead``: texts of the same length for the rules of some categories."""
    found = [_applied((instead or {}).get(r.category, text), r, as_of) for r in rules]
    return F.concat(*found) if found else F.from_json(F.lit("[]"), f"array<{MATCH}>")


def rule_groups(relaxed: bool = False, size: int = 10) -> list[tuple[Rule, ...]]:
    """All rules in groups that one projection holds with ease."""
    rules = rules_for(None, relaxed)
    return [rules[i : i + size] for i in range(0, len(rules), size)]


def lines_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, line_no, line, line_start``: lines and their places in the text; null texts have none."""
    parts = F.split(F.col(text_col), "\n", -1)
    starts = F.aggregate(parts, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x) + 1)))
    rows = df.select(F.col(id_col).alias("doc_id"), F.posexplode(F.arrays_zip(parts.alias("line"), F.slice(starts, 1, F.size(parts)).alias("line_start"))).alias("line_no", "x"))
    return rows.select("doc_id", "line_no", F.col("x.line").alias("line"), F.col("x.line_start").alias("line_start"))


def detect(df: DataFrame, categories: Iterable[str] | None = None, relaxed: bool = False, as_of: str = AS_OF, id_col: str = "doc_id", text_col: str = "text", rules: Iterable[Rule] | None = None) -> DataFrame:
    """Matches of the catalogue, or of some ``rules`` in its place, in each text, one row each, with places in the text."""
    found = matches_in(F.col(text_col), categories, relaxed, as_of) if rules is None else applied(F.col(text_col), rules, as_of)
    rows = df.select(F.col(id_col).alias("doc_id"), F.posexplode(found).alias("seq", "m"))
    return rows.select("doc_id", "seq", "m.*")


def catalogue(spark) -> DataFrame:
    """The catalogue as a table."""
    rows = [(r.label, r.category, r.pattern, r.score, r.weak, r.risk, list(r.anchors), r.evidence, r.own, r in RELAXED) for r in (*RULES, *RELAXED)]
    return spark.createDataFrame(rows, "label string, category string, pattern string, score double, weak double, risk int, anchors array<string>, evidence string, own boolean, relaxed boolean")
