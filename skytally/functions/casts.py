"""Lenient text-to-number conversion for JSON scalars.

The rules, for text ``x`` after trimming:

* digits with an optional sign parse as an integer, if they fit the type;
* other numeric text parses as a double, cut towards zero and clamped to the type's range;
* anything else (blank, not a number, too many digits) gives 0 (``blank="zero"``) or null
  (``blank="null"``).

SQL null stays null, unless ``present`` says that the field is there with a null in it: that counts
as blank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The range of INT.
INT_MIN, INT_MAX = -(2**31), 2**31 - 1

_BLANK_MODES = ("zero", "null")


def _check(blank: str) -> None:
    if blank not in _BLANK_MODES:
        raise ValueError(f"blank must be one of {_BLANK_MODES}, got {blank!r}")


def _or_blank(text: Column, number: Column, zero: Column, blank: str, present: Column | None) -> Column:
    _check(blank)
    if blank == "null":
        return number
    counts = text.isNotNull() if present is None else text.isNotNull() | present
    return F.coalesce(number, F.when(counts, zero))


def _whole_number(text: Column, sql_type: str, blank: str, present: Column | None) -> Column:
    as_double = text.try_cast("double")
    # floor and ceiling of a double are BIGINT, clamp at its ends and turn NaN into 0
    cut = F.when(F.startswith(F.ltrim(text), F.lit("-")), F.ceil(as_double)).otherwise(F.floor(as_double))
    if sql_type == "int":
        clamped = F.least(F.greatest(cut, F.lit(INT_MIN)), F.lit(INT_MAX)).cast("int")
        cut = F.when(as_double.isNotNull(), clamped)
    # plain digits never go through a double, which would round long values; the cast trims
    plain = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    number = F.coalesce(text.try_cast(sql_type), F.when(~plain, cut))
    return _or_blank(text, _unless_blank(text, number), F.lit(0).cast(sql_type), blank, present)


def _unless_blank(text: Column, number: Column) -> Column:
    # blank text is common and a failed parse as a double costs an exception: test for it first
    return F.when(F.trim(text) != "", number)


def lenient_int(text: Column, blank: str = "zero", present: Column | None = None) -> Column:
    return _whole_number(text, "int", blank, present)


def lenient_long(text: Column, blank: str = "zero", present: Column | None = None) -> Column:
    return _whole_number(text, "bigint", blank, present)


def lenient_double(text: Column, blank: str = "zero", present: Column | None = None) -> Column:
    number = _unless_blank(text, text.try_cast("double"))
    return _or_blank(text, number, F.lit(0.0), blank, present)
