"""Date helpers: multi-format parsing, effective-dated predicates, month bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted input date formats, tried in this order (first match wins).
DATE_FORMATS = ("yyyy-MM-dd", "dd.MM.yyyy", "dd-MM-yyyy", "MM/dd/yyyy")

# Fixed value: an open validity end (NULL) counts as this date.
OPEN_END = dt.date(5999, 12, 31)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> Column:
    """A literal date column from a date, an ISO string or a Column."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def parse_date_multi(c, formats=DATE_FORMATS) -> Column:
    """Trimmed text → date by the first format that parses; NULL when none does.

    ``try_to_date`` keeps ANSI mode from raising on bad text.
    """
    cleaned = F.trim(_col(c).cast("string"))
    return F.coalesce(*[F.when(_may_match(cleaned, fmt), F.try_to_date(cleaned, fmt)) for fmt in formats])


def _may_match(text: Column, fmt: str) -> Column:
    """Cheap pre-check that is true for every text ``fmt`` can parse.

    A failed parse is expensive (the parser raises internally), so a format is
    tried only when its first separator sits where the format puts it: right
    after a fixed two-letter field (``dd``, ``MM``), or at position 5 or later
    after a year (``yyyy`` takes four or more digits, maybe signed).
    """
    lead = len(fmt) - len(fmt.lstrip("yMd"))
    if lead == len(fmt):
        return F.lit(True)
    pos = F.instr(text, fmt[lead])
    if fmt[0] == "y":
        return (pos >= lead + 1) | F.substring(text, 1, 1).isin("+", "-")
    return pos == lead + 1


def effective_on(d, valid_from="data_actual_date", valid_to="data_actual_end_date") -> Column:
    """``d BETWEEN from AND coalesce(to, OPEN_END)``."""
    return as_date(d).between(_col(valid_from), F.coalesce(_col(valid_to), F.lit(OPEN_END)))


def overlaps(lo, hi, valid_from="data_actual_date", valid_to="data_actual_end_date") -> Column:
    """Version overlaps [lo, hi]: ``from <= hi AND coalesce(to, OPEN_END) >= lo``."""
    return (_col(valid_from) <= as_date(hi)) & (F.coalesce(_col(valid_to), F.lit(OPEN_END)) >= as_date(lo))


def month_bounds(d: dt.date | str) -> tuple[dt.date, dt.date]:
    """First and last day of the month containing ``d`` (driver-side constants)."""
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    first = d.replace(day=1)
    nxt = (first.replace(year=first.year + 1, month=1) if first.month == 12
           else first.replace(month=first.month + 1))
    return first, nxt - dt.timedelta(days=1)


def prev_month_bounds(d: dt.date | str) -> tuple[dt.date, dt.date]:
    """Report period for a report date: the whole month before ``d``'s month."""
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    last = d.replace(day=1) - dt.timedelta(days=1)
    return last.replace(day=1), last


def prev_month_bounds_col(c) -> tuple[Column, Column]:
    """Column form of :func:`prev_month_bounds`, for a column of report dates."""
    c = _col(c)
    return F.trunc(F.add_months(c, -1), "MM"), F.date_sub(F.trunc(c, "MM"), 1)
