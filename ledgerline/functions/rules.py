"""Ledger business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Passive account kinds (Cyrillic and Latin letter P), rouble currency codes.
PASSIVE_TYPES = ("П", "P")
ROUBLE_CODES = ("810", "643")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_passive(char_type) -> Column:
    """True for a passive account; NULL kind counts as active (the ELSE branch)."""
    return F.coalesce(_col(char_type).isin(*PASSIVE_TYPES), F.lit(False))


def is_rub(currency_code) -> Column:
    """Rouble flag; NULL code → False."""
    return F.coalesce(_col(currency_code).isin(*ROUBLE_CODES), F.lit(False))
