"""Fiscal-period column expressions (all JVM-side, codegen friendly).

Fiscal calendar: the year ends in June.  A period ending in September or
December belongs to the next calendar year's fiscal year; March and June to
the same year.  Quarter ends map September -> Q1, December -> Q2, March ->
Q3; June never yields a quarter from its end month (Q4 is derived).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period labels and their ordinals.
QUARTERS = ["Q1", "Q2", "Q3", "Q4"]
QUARTER_NUMBER = {"Q1": 1, "Q2": 2, "Q3": 3, "Q4": 4}

# Duration classes in inclusive days.
QUARTER_DAYS = (80, 100)
SIX_MONTH_DAYS = (170, 195)
NINE_MONTH_DAYS = (260, 285)
FULL_YEAR_DAYS = (350, 380)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def iso_date(text: Column | str) -> Column:
    """Strict ISO ``YYYY-MM-DD`` parse; anything else is NULL (never raises)."""
    t = _c(text)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t.try_cast("date"))


def duration_days(start: Column | str, end: Column | str) -> Column:
    """B1: inclusive day count ``(end - start) + 1``."""
    return F.datediff(_c(end), _c(start)) + F.lit(1)


def duration_between(start: Column | str, end: Column | str, lo: int, hi: int) -> Column:
    """B2: duration within [lo, hi]; a missing date gives false, never NULL."""
    return F.coalesce(duration_days(start, end).between(lo, hi), F.lit(False))


def duration_class(start: Column | str, end: Column | str) -> Column:
    """Instant / Quarter / Six Months / Nine Months / Full Year / Other."""
    d = duration_days(start, end)
    return (
        F.when(_c(start).isNull(), F.lit("Instant"))
        .when(d.between(*QUARTER_DAYS), F.lit("Quarter"))
        .when(d.between(*SIX_MONTH_DAYS), F.lit("Six Months"))
        .when(d.between(*NINE_MONTH_DAYS), F.lit("Nine Months"))
        .when(d.between(*FULL_YEAR_DAYS), F.lit("Full Year"))
        .otherwise(F.lit("Other"))
    )


def fiscal_period_of(end: Column | str) -> Column:
    """Quarter slot from the end month (9->Q1, 12->Q2, 3->Q3, else NULL)."""
    m = F.month(_c(end))
    return F.when(m == 9, "Q1").when(m == 12, "Q2").when(m == 3, "Q3")


def fiscal_year_of(end: Column | str) -> Column:
    """Fiscal year for a June year end (9,12 -> year+1; 3,6 -> year)."""
    e = _c(end)
    m = F.month(e)
    return (
        F.when(m.isin(9, 12), F.year(e) + 1)
        .when(m.isin(3, 6), F.year(e))
        .cast("int")
    )


def quarter_number(period: Column | str) -> Column:
    """Q1..Q4 -> 1..4, anything else NULL."""
    p = _c(period)
    return (
        F.when(p == "Q1", 1).when(p == "Q2", 2).when(p == "Q3", 3).when(p == "Q4", 4)
    ).cast("int")


def period_index(fiscal_year: Column | str, quarter: Column | str) -> Column:
    """Calendar key ``4*fy + q``: previous quarter is -1, prior-year quarter -4."""
    return _c(fiscal_year).cast("int") * 4 + _c(quarter).cast("int")


def period_identifier(fiscal_year: Column | str, period: Column | str) -> Column:
    """``FY2026-Q4`` identifier."""
    return F.concat(F.lit("FY"), _c(fiscal_year).cast("string"), F.lit("-"), _c(period))


def fiscal_label(fiscal_year: Column | str, period: Column | str | None = None) -> Column:
    """``FY2026 Q4`` (or ``FY2026`` for annual rows)."""
    base = F.concat(F.lit("FY"), _c(fiscal_year).cast("string"))
    if period is None:
        return base
    return F.concat(base, F.lit(" "), _c(period))


# Fixed value: the identifier pattern (whole string, case sensitive).
PERIOD_PATTERN = r"^FY(\d{4})-(Q[1-4])$"


def parse_period(text: Column | str) -> Column:
    """B10 strict parse -> struct(fiscal_year, fiscal_period) or NULL."""
    t = _c(text)
    ok = t.rlike(PERIOD_PATTERN)
    year = F.regexp_extract(t, PERIOD_PATTERN, 1).try_cast("int")
    valid = ok & F.coalesce(year.between(1900, 9999), F.lit(False))
    return F.when(
        valid,
        F.struct(year.alias("fiscal_year"), F.regexp_extract(t, PERIOD_PATTERN, 2).alias("fiscal_period")),
    )


def quarter_start(fiscal_year: Column | str, quarter: Column | str) -> Column:
    """First day of fiscal quarter ``q`` of a June-year-end fiscal year."""
    fy = _c(fiscal_year).cast("int")
    q = _c(quarter).cast("int")
    return F.add_months(F.make_date(fy - 1, F.lit(7), F.lit(1)), (q - 1) * 3)


def quarter_end(fiscal_year: Column | str, quarter: Column | str) -> Column:
    """Last day of fiscal quarter ``q``."""
    return F.date_sub(F.add_months(quarter_start(fiscal_year, quarter), 3), 1)
