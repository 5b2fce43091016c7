"""Column-level helpers: all built-in Spark expressions, no UDFs."""

from ledgerline.functions.dates import (
    DATE_FORMATS, OPEN_END, as_date, effective_on, month_bounds, overlaps,
    parse_date_multi, prev_month_bounds,
)
from ledgerline.functions.money import MONEY, RATE, KEY, money, rate, to_rub, blank_to_null
from ledgerline.functions.rules import PASSIVE_TYPES, ROUBLE_CODES, is_rub

__all__ = [
    "DATE_FORMATS", "OPEN_END", "as_date", "effective_on", "month_bounds", "overlaps",
    "parse_date_multi", "prev_month_bounds", "MONEY", "RATE", "KEY", "money", "rate",
    "to_rub", "blank_to_null", "PASSIVE_TYPES", "ROUBLE_CODES", "is_rub",
]
