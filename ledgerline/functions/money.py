"""Exact decimal money.

Stored money and rates are decimal(23,8). Multiplying two of them would make
Spark drop digits to fit 38 places. So a rate is split into millions and the
rest below a million: each product keeps every digit, the rest's is rounded to
money (half away from zero), and as both have the sign of the amount their sum
is the rounded product. No rate is narrowed, whatever the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(23, 8)
RATE = DecimalType(23, 8)
REST = DecimalType(14, 8)   # below a million
MILLIONS = DecimalType(9, 0)
KEY = DecimalType(20, 0)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _col(c).cast(MONEY)


def rate(c) -> Column:
    return _col(c).cast(RATE)


def to_rub(amount, fx_rate) -> Column:
    """``amount * coalesce(rate, 1)`` rounded to money. NULL amount stays NULL."""
    r = F.coalesce(rate(fx_rate), F.lit(1).cast(RATE))
    million = F.lit(1_000_000).cast(DecimalType(7, 0))
    rest = (r % million).cast(REST)
    millions = ((r - rest) / million).cast(MILLIONS)
    return ((money(amount) * millions).cast(MONEY) * million + (money(amount) * rest).cast(MONEY)).cast(MONEY)


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def blank_to_null(c) -> Column:
    """Trim spaces; an empty result becomes NULL."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))
