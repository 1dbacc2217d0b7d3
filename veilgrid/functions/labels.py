"""Field labels and categories as data. Everything in this module is a fixed value of the domain."""

from __future__ import annotations

#: Categories in order; the flagged ones identify a person uniquely.
CATEGORIES = (
    "person_name", "address", "email_address", "phone_number", "url", "date", "account_card_number", "credential_secret",
    "resident_registration_number", "foreigner_registration_number", "passport_number", "driver_license_number",
    "business_registration_number", "corporate_registration_number", "health_insurance_number", "vehicle_plate_number",
    "ip_address", "land_lot_number", "prescription_number", "drug_code", "employee_number", "petition_number",
    "court_case_number", "postal_code", "document_number", "nationality", "education_history", "academic_major",
    "job_position", "age", "height", "weight",
)
UNIQUE = ("resident_registration_number", "foreigner_registration_number", "passport_number", "driver_license_number", "health_insurance_number")

#: Categories by what a view may find.
TEXT_CATEGORIES = ("nationality", "education_history", "academic_major", "job_position")
FORMAT_CATEGORIES = tuple(c for c in CATEGORIES if c not in (*TEXT_CATEGORIES, "person_name", "address"))
LINE_CATEGORIES = (*FORMAT_CATEGORIES, *TEXT_CATEGORIES, "address")

#: Who wins at one place, after confidence.
PRIORITY = {
    "resident_registration_number": 100, "corporate_registration_number": 95, "foreigner_registration_number": 90, "passport_number": 85,
    "driver_license_number": 85, "health_insurance_number": 85, "business_registration_number": 80, "account_card_number": 75,
    "phone_number": 60, "email_address": 60, "url": 55, "date": 50, "vehicle_plate_number": 50, "address": 30, "person_name": 20,
}

#: Labels before a person's name.
PERSON_LABELS = (
    "대표이사", "공동대표자", "대표자", "성명", "이름", "신청인", "신청자", "민원인", "청구인", "보호자", "대리인", "법정대리인", "계약자",
    "보험계약자", "피보험자", "수익자", "가입자", "예금주", "계좌주", "소유자", "채무자", "채권자", "담당자", "당사자", "원고", "피고",
)
OTHER_FIELDS = (
    "주민등록번호", "외국인등록번호", "법인등록번호", "사업자등록번호", "생년월일", "출생연월일", "생일", "주소", "소재지", "전화", "연락처",
    "휴대전화", "이메일", "전자우편", "계좌", "계좌번호", "여권번호", "면허번호",
)

#: Labels before an address, and labels that end one.
ADDRESS_LABELS = ("사업장소재지", "사업장주소", "본점소재지", "우편물수령지", "법인주소", "등록기준지", "출생장소", "거주지", "소재지", "주소", "사용본거지")
ADDRESS_STOPS = (
    "사업의종류", "업종", "업태", "종목", "발급사유", "개업연월일", "법인등록번호", "사업자등록번호", "등록번호", "대표자", "성명", "생년월일",
    "전화", "팩스", "전자우편주소", "이메일",
)

#: E-mail labels in small letters.
EMAIL_LABELS = ("email", "e-mail", "e_mail", "e.mail", "emailaddress", "e-mailaddress", "e_mailaddress", "e.mailaddress")

#: Table headers of each category, and headers that tell nothing.
TABLE_LABELS = {
    "email_address": ("이메일", "이메일주소", "전자우편", "전자우편주소", "결과수신이메일", "전자세금계산서수신이메일", "전자세금계산서수신E-MAIL", "E-MAIL", "EMAIL"),
    "phone_number": (
        "전화", "전화번호", "연락처", "휴대전화", "휴대전화번호", "휴대폰", "휴대폰번호", "핸드폰", "핸드폰번호", "자택전화", "자택전화번호",
        "직장전화", "직장전화번호", "자택연락처", "우선연락처", "담당자연락처", "대표자연락처", "사업장연락처", "고객연락처", "전화휴대폰번호",
        "직장번호", "법인휴대폰", "TEL", "PHONE", "MOBILE",
    ),
    "date": ("생년월일", "출생연월일", "출생일", "생일"),
    "account_card_number": (
        "계좌", "계좌번호", "결제계좌", "입금계좌", "사용자계좌번호", "가입자계좌번호", "퇴직연금계좌번호", "IRP계좌번호", "지급계좌번호",
        "수령계좌번호", "카드번호", "신용카드번호",
    ),
    "resident_registration_number": ("주민등록번호", "주민번호", "주민(법인)등록번호", "가입자주민번호", "가입자주민등록번호", "대표자주민번호", "가입자고객번호", "실명확인번호"),
    "foreigner_registration_number": ("외국인등록번호", "외국인번호", "가입자고객번호", "실명확인번호"),
    "passport_number": ("여권번호", "실명확인번호"),
    "driver_license_number": ("운전면허번호", "면허번호", "실명확인번호"),
    "business_registration_number": ("사업자등록번호", "사업자번호"),
    "corporate_registration_number": ("법인등록번호", "법인번호", "주민(법인)등록번호"),
    "health_insurance_number": ("건강보험증번호", "건강보험번호"),
    "vehicle_plate_number": ("차량번호", "자동차등록번호"),
    "postal_code": ("우편번호",),
    "employee_number": ("사번", "직원번호"),
}
NEUTRAL_HEADERS = ("구분", "관계", "성별", "분", "순번", "순위번호", "사항란", "등록일자", "접수번호")

#: Labels near a value that count as its field.
DOCUMENT_FIELDS = {
    "resident_registration_number": TABLE_LABELS["resident_registration_number"],
    "foreigner_registration_number": ("외국인등록번호", "외국인번호", "국내거소신고번호", "거소신고번호", "가입자고객번호", "실명확인번호"),
    "passport_number": TABLE_LABELS["passport_number"],
    "driver_license_number": TABLE_LABELS["driver_license_number"],
    "phone_number": (
        "전화", "전화번호", "연락처", "휴대전화", "휴대전화번호", "휴대폰", "휴대폰번호", "핸드폰", "핸드폰번호", "자택전화", "자택전화번호",
        "직장전화", "직장전화번호", "자택연락처", "우선연락처", "담당자연락처", "대표자연락처", "사업장연락처", "고객연락처", "직장번호",
        "법인휴대폰", "TEL", "PHONE", "MOBILE", "전화/휴대폰번호", "대표전화", "대표번호", "고객센터", "상담전화", "문의전화",
    ),
    "email_address": ("이메일", "이메일주소", "전자우편", "전자우편주소", "결과수신이메일", "전자세금계산서수신이메일", "전자세금계산서수신E-MAIL", "EMAIL", "email", "E-MAIL", "E-Mail", "E-mail", "e-mail", "e-mail주소"),
}
SERVICE_LINE_FIELDS = ("대표전화", "대표번호", "고객센터", "상담전화", "문의전화", "콜센터", "ARS", "전화번호", "TEL", "연락처")

#: Names of banks as documents write them.
BANKS = (
    "국민", "국민은행", "KB국민은행", "신한", "신한은행", "우리", "우리은행", "하나", "하나은행", "KEB하나은행", "기업", "기업은행", "IBK기업은행",
    "농협", "농협은행", "NH농협", "수협", "수협은행", "신협", "신용협동조합", "새마을금고", "MG새마을금고", "우체국", "산업은행", "KDB산업은행",
    "카카오뱅크", "카뱅", "케이뱅크", "K뱅크", "토스뱅크", "부산은행", "대구은행", "경남은행", "광주은행", "전북은행", "제주은행",
)
ACCOUNT_LABELS = ("계좌번호", "계좌", "입금계좌", "결제계좌")

#: Labels of an account's owner, labels that end an address field's value, and parts of place names.
OWNER_LABELS = ("예금주", "계좌주", "명의인", "성명")
FIELD_ENDS = (
    "사업장소재지", "소재지", "본점소재지", "주소", "사업의종류", "업태", "종목", "발급사유", "개업연월일", "대표이사", "대표자", "성명",
    "생년월일", "전화", "팩스", "전자우편주소", "이메일",
)
PROVINCE_ENDS = ("특별시", "광역시", "특별자치시", "특별자치도")
ROAD_ENDS = ("대로", "로", "길")
UNIT_ENDS = ("동", "호", "층")
#: Labels behind which a dot stands for a space before a name, and signs that recognition puts for a space.
NAME_LABELS = ("대표이사", "대표자", "성명", "이름", "신청인", "신청자", "민원인", "청구인", "보호자", "대리인")
SPACE_SIGNS = ".,·ㆍ:;"
NAME_SIGNS = ".·ㆍ"
#: Names of units and buildings in an address's further lines.
PLACE_ENDS = (
    "특별시", "광역시", "특별자치시", "특별자치도", "시", "군", "구", "읍", "면", "동", "리", "대로", "번길", "로", "길", "아파트", "빌딩", "타워",
    "센터", "오피스텔", "상가", "플라자",
)

#: Common family names, for the check of a person's name.
SURNAMES = "김이박최정강조윤장임한오서신권황안송전홍유고문양손배백허남심노하곽성차주우구나민진지엄채원천방공현함변염여추도소석선설마길연위표명기반라왕금옥육인맹제모탁국어은편용형"

#: What models call entities, the category of each, and the probability each needs.
ENTITIES = {
    "SURNAME": ("person_name", 0.85), "GIVENNAME": ("person_name", 0.85), "CITY": ("address", 0.80), "STREET": ("address", 0.80),
    "ZIPCODE": ("address", 0.90), "BUILDINGNUM": ("address", 0.90), "USERNAME": ("username", 0.90), "EMAIL": ("email_address", 0.85),
    "TELEPHONENUM": ("phone_number", 0.85), "DATEOFBIRTH": ("date", 0.85), "CREDITCARDNUMBER": ("account_card_number", 0.90),
    "IDCARD": ("id_card_number", 0.90), "IP_ADDRESS": ("ip_address", 0.90), "PASSWORD": ("credential_secret", 0.90),
    "ACCOUNTNUM": ("account_card_number", 0.90), "DRIVERLICENSENUM": ("driver_license_number", 0.90), "TIME": ("time", 0.90), "COMPANY": ("company_name", 0.90),
}
SEMANTIC = ("SURNAME", "GIVENNAME", "CITY", "STREET", "ZIPCODE", "BUILDINGNUM")


def parse_field_labels(text: str) -> tuple[str, ...]:
    """Labels that a user wrote, one a line or with commas between them: trimmed, in order, each once."""
    return tuple(dict.fromkeys(x.strip() for x in text.replace("\n", ",").replace("\r", ",").split(",") if x.strip()))
