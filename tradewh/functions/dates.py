"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradewh.functions._util import col

# Year first, then month and day, both separators '-' or both '/'; a valid time
# part (and zone) may follow, anything else may not. Day-first and compact forms
# are rejected.
DATE_PATTERN = (
    r"^\s*\d{4,}(?:-\d{1,2}-|/\d{1,2}/)\d{1,2}"
    r"(?:(?: +|T)(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?\s*(?:Z|UTC|[+-]\d{2}(?::?\d{2})?)?)?\s*$"
)

# Month names as the reference spells them, January..December.
MONTH_NAMES_ES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]


def parse_date(c: Column | str) -> Column:
    """ISO-like text -> DATE, NULL on failure (P5)."""
    c = col(c)
    return F.when(c.rlike(DATE_PATTERN), F.replace(F.trim(c), F.lit("/"), F.lit("-")).try_cast("date"))


def date_key(d: Column | str) -> Column:
    """YYYYMMDD integer key (P14), by arithmetic rather than string formatting."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name_es(d: Column | str) -> Column:
    """Spanish month name (P16); NULL date -> NULL."""
    names = F.array(*[F.lit(m) for m in MONTH_NAMES_ES])
    return F.try_element_at(names, F.month(col(d)))


def quarter_of(d: Column | str, legacy: bool = False) -> Column:
    """Quarter 1-4.

    ``legacy=True`` reproduces the reference's stored value,
    ``round((month - 1) / 3 + 1)`` with float division, which maps months
    3, 6, 9, 12 to 2, 3, 4, 5.
    """
    d = col(d)
    if legacy:
        return F.round((F.month(d) - 1) / 3.0 + 1, 0).cast("int")
    return F.quarter(d)


def semester(d: Column | str) -> Column:
    """1 for January-June, else 2."""
    return F.when(F.month(col(d)) <= 6, F.lit(1)).otherwise(F.lit(2))
