"""Numeric column helpers shared by every operator (rounding, ratios, safe casts).

Rounding happens once, on the double itself: Spark's ``round`` and ``bround`` work on
its shortest decimal text (1.005 -> 1.01), so 33.33499975 is 33.33 and never 33.34.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The numeric guard for text -> number (ST2/ST3).
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, scale: int = 2) -> Column:
    """Round half away from zero to ``scale`` places, as a double."""
    return F.round(col_(c).cast("double"), scale)


def round_half_even(c: str | Column, scale: int = 1) -> Column:
    """Banker's rounding (pandas ``round``), as a double."""
    return F.bround(col_(c).cast("double"), scale)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, null when den is 0 or null (never an ANSI divide error)."""
    return F.try_divide(col_(num).cast("double"), col_(den))


def percent(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """round(num / den * 100, scale); null for a zero denominator."""
    return round_half_up(ratio(num, den) * F.lit(100), scale)


def _numeric_text(c: str | Column) -> Column:
    t = F.trim(col_(c).cast("string"))
    return F.when(t.rlike(NUMBER_PATTERN), t)


def safe_int(c: str | Column) -> Column:
    """ST2: blank, 'nan', non-numbers and overflow -> null; '3.7' -> 3 (truncation).

    Integer literals (the common case) cast straight to bigint; other numbers go
    through a double and truncate.
    """
    t = F.trim(col_(c).cast("string"))
    return F.when(t.rlike(INTEGER_PATTERN), t.try_cast("bigint")).otherwise(
        _numeric_text(c).try_cast("double").try_cast("bigint"))


def safe_double(c: str | Column) -> Column:
    """ST3: as safe_int without the truncation."""
    return _numeric_text(c).try_cast("double")


def safe_string(c: str | Column) -> Column:
    """ST4: null, blank, 'nan' in any case and exactly 'None' -> null; else untrimmed."""
    s = col_(c).cast("string")
    bad = s.isNull() | (F.trim(s) == "") | (F.lower(s) == "nan") | (s == "None")
    return F.when(~bad, s)
