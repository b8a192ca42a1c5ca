"""Tolerant and strict casts, date parsing and period decomposition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakefold.fixed import DATE_FORMAT, PERIOD_RULES, PERIOD_UNKNOWN
from lakefold.functions.text import _c


# -- tolerant: invalid text becomes NULL ------------------------------------
# Date-first layouts accepted besides ISO text ('2024-01-02 03:04:05[.ffffff]',
# '2024-01-02T03:04:05', '2024-01-02'): slashes, and month/day/year as the
# pandas reader of the source assumed for ambiguous dates.
_TS_REWRITES = [(r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
                (r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")]


def safe_timestamp(col) -> Column:
    """TIMESTAMP_NTZ from text, without any session time zone; NULL if invalid."""
    text = F.trim(_c(col))
    for pattern, repl in _TS_REWRITES:
        text = F.regexp_replace(text, pattern, repl)
    return text.try_cast("timestamp_ntz")


def safe_long(col) -> Column:
    return _c(col).try_cast("bigint")


def safe_double(col) -> Column:
    return _c(col).try_cast("double")


def safe_date(col) -> Column:
    """Only full dates, year-month-day; ``'2024'`` is NULL, not January 1st."""
    return F.try_to_date(_c(col), DATE_FORMAT)


# -- strict: one invalid value fails the job (ANSI casts) -------------------
def strict_long(col) -> Column:
    return _c(col).cast("bigint")


def strict_double(col) -> Column:
    return _c(col).cast("double")


def strict_date(col) -> Column:
    return F.to_date(_c(col), DATE_FORMAT)


# -- period text: 'YYYY-MM', 'YYYY-Qn', 'YYYY-Sn' -----------------------------
def period_year(col) -> Column:
    return F.substring(_c(col), 1, 4).try_cast("bigint")


def period_kind(col) -> Column:
    p = _c(col)
    out = None
    for test, label, _ in PERIOD_RULES:
        out = (F.when if out is None else out.when)(p.rlike(test), F.lit(label))
    return out.otherwise(F.lit(PERIOD_UNKNOWN))


def period_number(col) -> Column:
    """The number after the matched period kind (a no-match '' becomes NULL)."""
    p = _c(col)
    out = None
    for test, _, number in PERIOD_RULES:
        value = F.nullif(F.regexp_extract(p, number, 1), F.lit("")).try_cast("bigint")
        out = (F.when if out is None else out.when)(p.rlike(test), value)
    return out
