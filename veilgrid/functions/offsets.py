"""Pattern matches with their places, without leaving Catalyst.

``split`` gives the text between matches and ``regexp_extract_all`` the matches; sums over both place each match. Both are
worked out once for a text, however many matches it has. Patterns must not match the empty string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACED = "array<struct<start:int,stop:int,value:string>>"

#: Matches whose lengths are added up at once.
BLOCK = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once. Projections may be merged into their readers, a lambda's variable is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def each(count: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` for 0 to count - 1; an empty array for 0."""
    return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: i < count), make)


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, n: acc + n)


def running(numbers: Column) -> Column:
    """The sum before each of some numbers; linear but for a 128th, as no array grows step by step."""

    def blocks(a: Column) -> Column:
        return each(F.ceil(F.size(a) / BLOCK).cast("int"), lambda b: F.slice(a, b * BLOCK + 1, F.lit(BLOCK)))

    def sums(parts: Column) -> Column:
        return let(F.transform(parts, total), lambda t: each(F.size(t), lambda b: total(F.slice(t, F.lit(1), b))))

    def before(parts: Column, bases: Column) -> Column:
        one = lambda part, base: F.transform(part, lambda x, i: base + total(F.slice(part, F.lit(1), i)))
        return F.flatten(F.zip_with(parts, bases, one))

    return let(numbers, lambda a: let(blocks(a), lambda parts: let(sums(parts), lambda bases: before(parts, bases))))


def located(text: Column, pattern: str) -> Column:
    """All matches, left to right: ``array<struct<start,stop,value>>`` in code points, end exclusive; null text gives none."""

    def placed(z: Column) -> Column:
        lengths = F.zip_with(z["found"], F.slice(z["gaps"], F.lit(1), F.size(z["found"])), lambda m, g: F.length(g) + F.length(m))
        return F.zip_with(F.arrays_zip(z["found"].alias("m"), F.slice(z["gaps"], F.lit(1), F.size(z["found"])).alias("g")), running(lengths), one)

    def one(p: Column, at: Column) -> Column:
        start = at + F.length(p["g"])
        return F.struct(start.alias("start"), (start + F.length(p["m"])).alias("stop"), p["m"].alias("value"))

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(pattern), let(both, placed)).otherwise(F.from_json(F.lit("[]"), PLACED))


def slice_text(text: Column, start: Column, stop: Column) -> Column:
    """Code points [start, stop) of a text."""
    return text.substr(start + 1, stop - start)
