"""Derived measures and classifications (C1-C16) as column expressions.

Every function returns a Column; null rules are stated per function. Thresholds and
labels are arguments, the defaults are the published indicator rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col_, ratio, round_half_up

# Criticality classes by gap to the 2030 target (C5), rate bands (C12),
# projection status labels (C9), literacy cut-off on the score scale (C11).
CRITICALITY = [(60, "Crítico"), (40, "Muito Alto"), (25, "Alto"), (10, "Moderado")]
CRITICALITY_DEFAULT = "Baixo"
CRITICALITY_ORDER = ["Crítico", "Muito Alto", "Alto", "Moderado", "Baixo"]
RATE_BANDS = [(80, ">=80"), (65, "65-80"), (50, "50-65")]
RATE_BAND_DEFAULT = "<50"
RATE_BAND_ORDER = ["<50", "50-65", "65-80", ">=80"]
STATUS_NO_DATA = "Sem dados"
STATUS_REACHED = "Já atingiu"
STATUS_ON_TRACK = "Sim"
STATUS_OFF_TRACK = "Não no ritmo atual"
LITERACY_CUTOFF = 743
TARGET_YEAR = 2030


def gap(target: str | Column, rate: str | Column, scale: int = 2) -> Column:
    """round(target - rate); null if either side is null."""
    return round_half_up(col_(target) - col_(rate), scale)


def attainment(rate: str | Column, target: str | Column, scale: int = 2,
               positive_target_only: bool = False) -> Column:
    """round(rate / target * 100); null for a zero (or, if asked, negative) target."""
    value = round_half_up(ratio(rate, target) * F.lit(100), scale)
    if positive_target_only:
        return F.when(col_(target) > 0, value)
    return value


def reached(rate: str | Column, target: str | Column) -> Column:
    """1 if rate >= target else 0; a null on either side gives 0."""
    return F.when(col_(rate) >= col_(target), F.lit(1)).otherwise(F.lit(0))


def classify(c: str | Column, thresholds: Sequence[tuple[float, str]], default: str,
             null_label: str | None = "__default__") -> Column:
    """First label whose lower bound ``c >= bound`` holds, tested in order."""
    value = col_(c)
    expr = None
    for bound, label in thresholds:
        cond = value >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(default))
    if null_label != "__default__":
        expr = F.when(value.isNull(), F.lit(null_label)).otherwise(expr)
    return expr


def criticality(gap_col: str | Column) -> Column:
    return classify(gap_col, CRITICALITY, CRITICALITY_DEFAULT)


def rate_band(rate: str | Column) -> Column:
    return classify(rate, RATE_BANDS, RATE_BAND_DEFAULT, null_label=None)


def yearly_change(rate: str | Column, previous: str | Column, scale: int = 2,
                  years_between: str | Column | None = None) -> Column:
    """round(rate - previous); null without a previous value.

    With ``years_between`` the change is divided by the distance to the previous
    available year (a change over a two-year gap counts half per year).
    """
    delta = col_(rate) - col_(previous)
    if years_between is not None:
        delta = F.try_divide(delta, col_(years_between))
    return F.when(col_(previous).isNotNull(), round_half_up(delta, scale))


def years_to_target(rate: str | Column, target: str | Column, change: str | Column,
                    scale: int = 1) -> Column:
    """round((target - rate) / change, 1), only for a positive change and a target."""
    ch = col_(change)
    ok = ch.isNotNull() & (ch > 0) & col_(target).isNotNull()
    return F.when(ok, round_half_up((col_(target) - col_(rate)) / ch, scale))


def projected_year(year: str | Column, years: str | Column) -> Column:
    """int(year + years), truncating, only for years > 0."""
    y = col_(years)
    return F.when(y.isNotNull() & (y > 0), (col_(year) + y).cast("int"))


def projection_status(rate: str | Column, target: str | Column, projected: str | Column,
                      change: str | Column | None = None, horizon: int = TARGET_YEAR,
                      status_order: str = "reference") -> Column:
    """Status of a projection.

    ``reference``: no projection -> Sem dados; rate >= target -> Já atingiu;
    projected <= horizon -> Sim; else Não no ritmo atual (Já atingiu is unreachable).
    ``reached_first``: rate >= target first, then no/negative change -> Não no ritmo atual.
    """
    p, r, t = col_(projected), col_(rate), col_(target)
    if status_order == "reached_first":
        ch = col_(change) if change is not None else F.lit(None)
        return (F.when(r >= t, F.lit(STATUS_REACHED))
                .when(ch.isNotNull() & (ch <= 0), F.lit(STATUS_OFF_TRACK))
                .when(p.isNull(), F.lit(STATUS_NO_DATA))
                .when(p <= horizon, F.lit(STATUS_ON_TRACK))
                .otherwise(F.lit(STATUS_OFF_TRACK)))
    return (F.when(p.isNull(), F.lit(STATUS_NO_DATA))
            .when(r >= t, F.lit(STATUS_REACHED))
            .when(p <= horizon, F.lit(STATUS_ON_TRACK))
            .otherwise(F.lit(STATUS_OFF_TRACK)))


def amplitude(hi: str | Column, lo: str | Column, scale: int = 2) -> Column:
    """round(max - min)."""
    return round_half_up(col_(hi) - col_(lo), scale)


def literate_flag(score: str | Column, cutoff: float = LITERACY_CUTOFF) -> Column:
    """C11: 1 if score >= cutoff, 0 below, null for a null score."""
    s = col_(score)
    return F.when(s.isNull(), F.lit(None).cast("int")).when(s >= cutoff, F.lit(1)).otherwise(F.lit(0))


def required_pace(gap_col: str | Column, years_left: int | Column) -> Column:
    """Gap / years left, 0 when no year is left."""
    yl = years_left if isinstance(years_left, Column) else F.lit(years_left)
    return F.when(yl > 0, col_(gap_col) / yl).otherwise(F.lit(0.0))


def column_sum(cols: Sequence[str | Column], null_as_zero: bool = False) -> Column:
    """Sum of a column family; null if any member is null unless ``null_as_zero``."""
    parts = [F.coalesce(col_(c), F.lit(0.0)) if null_as_zero else col_(c) for c in cols]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total
