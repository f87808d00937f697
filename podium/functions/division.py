"""Division (gender) and age-class readers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.rules import BRACKET_ANYWHERE, DASH_CLASS, GENDER_ONLY_CLASS, OPEN_AGE_CLASSES, OPEN_WORDS_CLASS, WORDS_CLASS

MALE, FEMALE, NB = "male", "female", "nb"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def division_from_prefix(c) -> Column:
    """lower(trim(c)) starting with m/f/n -> male/female/nb; anything else -> null."""
    s = F.lower(F.trim(_c(c)))
    return (F.when(s.startswith("m"), F.lit(MALE))
            .when(s.startswith("f"), F.lit(FEMALE))
            .when(s.startswith("n"), F.lit(NB)))


def division_map(c, mode: str) -> Column:
    """Other gender readers.

    * ``strict``: exactly 'M'/'F', else null (the caller quarantines the row)
    * ``m_else_f``: 'M' is male, anything else female
    * ``mf_else_null``: 'M'/'F', else null
    * ``upper``: upper-case; 'M'/'F' become male/female, other text is kept
    """
    s = _c(c)
    if mode in ("strict", "mf_else_null"):
        return F.when(s == "M", F.lit(MALE)).when(s == "F", F.lit(FEMALE))
    if mode == "m_else_f":
        return F.when(s == "M", F.lit(MALE)).otherwise(F.lit(FEMALE))
    if mode == "upper":
        u = F.upper(F.trim(s))
        return F.when(u == "M", F.lit(MALE)).when(u == "F", F.lit(FEMALE)).otherwise(u)
    raise ValueError(f"unknown division mode: {mode}")


def midpoint(lo, hi, mode: str = "half_even") -> Column:
    """Middle of an age bracket: 'floor' or 'half_even' (banker's rounding)."""
    mid = (_c(lo) + _c(hi)) / F.lit(2.0)
    if mode == "floor":
        return F.floor(mid).cast("int")
    return F.bround(mid, 0).cast("int")


def _letter_division(letter: Column) -> Column:
    return F.when(letter == "M", F.lit(MALE)).when(letter == "F", F.lit(FEMALE))


def age_class_dash(c, mid_mode: str = "half_even", open_classes=OPEN_AGE_CLASSES) -> Column:
    """'M17-29 (..)' style classes -> struct(age, division); null struct = drop the row.

    Open classes (default '70+', '75+', '12-', '19-', '16-'; some sources list only
    '75+') are tested first, by substring and in the given order; the division then
    is male when the text starts with 'M'.
    """
    s = _c(c)
    open_age = F.lit(None).cast("int") if not open_classes else None
    for token, age in open_classes:
        cond = s.contains(token)
        open_age = (F.when(cond, F.lit(age)) if open_age is None
                    else open_age.when(cond, F.lit(age)))
    open_div = F.when(s.startswith("M"), F.lit(MALE)).otherwise(F.lit(FEMALE))
    closed = s.rlike(DASH_CLASS)
    lo = F.regexp_extract(s, DASH_CLASS, 2).try_cast("int")
    hi = F.regexp_extract(s, DASH_CLASS, 3).try_cast("int")
    closed_age = midpoint(lo, hi, mid_mode)
    closed_div = _letter_division(F.regexp_extract(s, DASH_CLASS, 1))
    is_open = open_age.isNotNull()
    return (F.when(is_open, F.struct(open_age.cast("int").alias("age"), open_div.alias("division")))
            .when(closed, F.struct(closed_age.alias("age"), closed_div.alias("division"))))


def age_class_words(c, mid_mode: str = "half_even") -> Column:
    """'M 50 to 54 (2)', 'Male (3)' (age unknown), 'M  70..' (lower bound) -> struct(age, division)."""
    s = _c(c)
    words = s.rlike(WORDS_CLASS)
    lo = F.regexp_extract(s, WORDS_CLASS, 2).try_cast("int")
    hi = F.regexp_extract(s, WORDS_CLASS, 3).try_cast("int")
    words_div = _letter_division(F.regexp_extract(s, WORDS_CLASS, 1))
    gender_only = s.rlike(GENDER_ONLY_CLASS)
    g = F.regexp_extract(s, GENDER_ONLY_CLASS, 1)
    g_div = F.when(g == "Male", F.lit(MALE)).when(g == "Female", F.lit(FEMALE))
    open_words = s.rlike(OPEN_WORDS_CLASS)
    open_age = F.regexp_extract(s, OPEN_WORDS_CLASS, 2).try_cast("int")
    open_div = _letter_division(F.regexp_extract(s, OPEN_WORDS_CLASS, 1))
    return (F.when(words, F.struct(midpoint(lo, hi, mid_mode).alias("age"), words_div.alias("division")))
            .when(gender_only, F.struct(F.lit(None).cast("int").alias("age"), g_div.alias("division")))
            .when(open_words, F.struct(open_age.alias("age"), open_div.alias("division"))))


def age_bracket(c, mid_mode: str = "half_even") -> Column:
    """Middle of the bracket in 'Long race M 50 to 54 (2)', with any text around it; null without one."""
    s = _c(c)
    lo = F.regexp_extract(s, BRACKET_ANYWHERE, 1).try_cast("int")
    hi = F.regexp_extract(s, BRACKET_ANYWHERE, 2).try_cast("int")
    return F.when(s.rlike(BRACKET_ANYWHERE), midpoint(lo, hi, mid_mode))
