"""Text forms that searches run on."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points read as a hyphen.
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2212\ufe63\uff0d"

#: Letters and signs that OCR confuses with digits.
CONFUSED = {"0": "OoQ", "1": "IilL|!", "2": "Zz", "5": "Ss", "6": "G", "8": "B"}

#: Categories that numeric recovery may serve.
RECOVERABLE = ("phone_number", "account_card_number", "resident_registration_number", "foreigner_registration_number", "driver_license_number", "business_registration_number", "corporate_registration_number", "health_insurance_number")

_TO_HYPHEN = dict.fromkeys(map(ord, DASHES), "-")


def searchable(text: str) -> str:
    """NFKC, no white space, dashes as hyphens."""
    return "".join(unicodedata.normalize("NFKC", text).split()).translate(_TO_HYPHEN) if not text.isascii() else "".join(text.split())


def pieces(text: str) -> tuple[str, list[int]]:
    """The searchable form of each character by itself, and the character each of its signs comes from."""
    out, source = [], []
    for i, c in enumerate(text):
        for x in searchable(c):
            out.append(x)
            source.append(i)
    return "".join(out), source


def search_text(x: Column) -> Column:
    """The searchable form: built-in functions for ASCII, an Arrow function for the rest."""

    @F.arrow_udf("string")
    def full(column: pa.Array) -> pa.Array:
        return pa.array([None if t is None else "".join(map(searchable, t)) for t in column.to_pylist()], pa.string())

    return F.when(x.rlike("^\\p{ASCII}*$"), F.regexp_replace(x, "[\\x09-\\x0D\\x1C-\\x1F\\x20]", "")).otherwise(full(x))


def search_pieces(x: Column) -> Column:
    """``struct<text, source>``: the searchable form and the place of each sign in the original."""

    @F.arrow_udf("struct<text:string,source:array<int>>")
    def both(column: pa.Array) -> pa.Array:
        rows = [pieces(t or "") for t in column.to_pylist()]
        return pa.array([{"text": t, "source": s} for t, s in rows], pa.struct([("text", pa.string()), ("source", pa.list_(pa.int32()))]))

    return both(x)


def collapse_separators(x: Column) -> Column:
    """One of each run of the same ``-``, ``.`` or ``/``."""
    return F.regexp_replace(x, "([-./])\\1+", "$1")


def restore_digits(x: Column) -> Column:
    """Confused letters become digits where the nearest other sign on either side, past separators, is a digit.

    All places are judged on the original: replacements are marked first, by private code points, and named last.
    """
    beside = "[ \\t\\r\\n./-]"
    out = x
    for digit, letters in CONFUSED.items():
        some = "[" + letters.replace("|", "\\|") + "]"
        out = F.regexp_replace(out, f"(?<=[0-9]{beside}{{0,64}}){some}|{some}(?={beside}*[0-9])", chr(0xE000 + int(digit)))
    return F.translate(out, "".join(chr(0xE000 + int(d)) for d in CONFUSED), "".join(CONFUSED))


def label_text(x: Column) -> Column:
    """Letters and digits only, in capitals."""
    return F.upper(F.regexp_replace(x, "(?U)[^\\p{Alnum}]", ""))


def full_width(x: Column) -> Column:
    """ASCII as full-width forms."""
    return F.translate(x, "".join(map(chr, range(33, 127))), "".join(chr(c + 0xFEE0) for c in range(33, 127)))
