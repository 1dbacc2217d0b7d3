"""Validity of identifiers, as Column expressions.

Check digits follow the public rules: resident and foreigner numbers weigh 2..9,2..5 modulo 11; business
numbers weigh 1,3,7,1,3,7,1,3,5 and carry the tens of the last product; corporate numbers alternate 1 and 2 modulo 10.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of the check digits.
RESIDENT_WEIGHTS = (2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5)
BUSINESS_WEIGHTS = (1, 3, 7, 1, 3, 7, 1, 3, 5)
CORPORATE_WEIGHTS = (1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2)

#: Fixed value: full form of an e-mail address. A label ends in one way only, so none is given back, however many there are.
EMAIL = r"(?i)^[A-Z0-9.!#$%&'*+/=?^_`{|}~-]+@(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)++[A-Z]{2,63}$"

#: Passport prefixes and licence regions.
PASSPORT = "^(?:M|S|G|PP|PM|PS|PO|PD|PR|PT)[0-9]{8}$"
LICENSE_REGIONS = (11, 28)


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _digit(d: Column, i: int) -> Column:
    return d.substr(i + 1, 1).cast("int")


def _weighted(d: Column, weights: tuple[int, ...]) -> Column:
    total = F.lit(0)
    for i, w in enumerate(weights):
        total = total + _digit(d, i) * w
    return total


def luhn(x: Column) -> Column:
    """13 to 19 digits that pass the Luhn test."""
    d = digits(x)
    return F.length(d).between(13, 19) & F.call_function("luhn_check", d)


def resident_check(x: Column) -> Column:
    """The check digit of a resident or foreigner number of 13 digits."""
    d = digits(x)
    ok = ((11 - _weighted(d, RESIDENT_WEIGHTS) % 11) % 10) == _digit(d, 12)
    return F.when(F.length(d) == 13, ok).otherwise(F.lit(False))


def business_check(x: Column) -> Column:
    d = digits(x)
    total = _weighted(d, BUSINESS_WEIGHTS) + F.floor(_digit(d, 8) * 5 / 10)
    return F.when(F.length(d) == 10, (10 - total % 10) % 10 == _digit(d, 9)).otherwise(F.lit(False))


def corporate_check(x: Column) -> Column:
    d = digits(x)
    return F.when(F.length(d) == 13, (10 - _weighted(d, CORPORATE_WEIGHTS) % 10) % 10 == _digit(d, 12)).otherwise(F.lit(False))


def century(d: Column) -> Column:
    """First two digits of the birth year by the seventh digit."""
    c = d.substr(7, 1)
    return F.when(c.isin("9", "0"), 18).when(c.isin("1", "2", "5", "6"), 19).when(c.isin("3", "4", "7", "8"), 20)


def birth_date(x: Column) -> Column:
    """The birth date in a 13-digit number; null where there is none."""
    d = digits(x)
    return F.when(F.length(d) == 13, F.try_to_date(F.concat(century(d).cast("string"), d.substr(1, 6)), "yyyyMMdd"))


def resident_shape(x: Column, as_of: str, foreign: bool) -> Column:
    """Birth date that is no later than ``as_of``, and the seventh digit of the right kind."""
    d = digits(x)
    seventh = d.substr(7, 1).isin(*("5678" if foreign else "123490"))
    return F.coalesce(seventh & (birth_date(x) <= F.lit(as_of).cast("date")), F.lit(False))


def id_card_kind(x: Column, as_of: str) -> Column:
    """Category of an identity number that a model found: resident, foreigner, or unspecified."""
    bare = F.regexp_replace(x, "[ \\t./\u2010\u2011\u2012\u2013\u2014-]", "")
    ok = bare.rlike("^[0-9]{13}$") & (birth_date(bare) <= F.lit(as_of).cast("date"))
    kind = F.when(bare.substr(7, 1).isin(*"5678"), "foreigner_registration_number").otherwise("resident_registration_number")
    return F.when(F.coalesce(ok, F.lit(False)), kind).otherwise("id_card_number")


def passport(x: Column) -> Column:
    return x.rlike(PASSPORT) & ~x.rlike("0{8}$")


def license_number(x: Column, anchored: Column) -> Column:
    """2-2-6-2 with a known region; twelve digits without hyphens only behind a label."""
    region = x.substr(1, 2).try_cast("int").between(*LICENSE_REGIONS)
    return F.coalesce(region & (x.rlike("^[0-9]{2}-[0-9]{2}-[0-9]{6}-[0-9]{2}$") | x.rlike("^[0-9]{12}$") & anchored), F.lit(False))


def representative_phone(x: Column) -> Column:
    """Nationwide service numbers: 15 to 18 and six digits."""
    return F.regexp_replace(x, "[ \\t./-]", "").rlike("^1[5-8][0-9]{6}$")


def email(x: Column) -> Column:
    return F.regexp_replace(x, "\\s", "").rlike(EMAIL)
