"""Carry a balance forward over consecutive days in one pass.

The reference computes a day's balance as yesterday's balance plus the day's
change, one day per call. Yesterday's balance exists only when the account
was active yesterday, so a missing day resets the balance to zero. The same
numbers come out of running sums restarted at every run of consecutive days
("island"): with S the account's cumulative sum in day order, the balance on
day d is S(d) − S(before the island's first day). The balance before the range
is added to the island that starts on the range's first day.

All windows share one specification (partition by account, order by day), so
the plan sorts once; an account has at most one row per day, so no window
partition outgrows the number of days in the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import as_date


def island_running_sum(df: DataFrame, key: str, day: str, deltas: Sequence[str],
                       lo, opening: DataFrame | None = None,
                       opening_cols: Sequence[str] | None = None) -> DataFrame:
    """Replace each delta column by its running total within the island of
    consecutive days of ``key`` that the row belongs to.

    ``opening`` (``key`` + ``opening_cols``, one per delta, same order) is the
    balance on ``lo - 1``; it is added only to the island that starts on ``lo``.
    ``df`` must have at most one row per (key, day). Deltas should be narrow
    decimals (e.g. (24,8)): the sums add about 12 digits of precision, and
    beyond 38 Spark would drop fraction digits.
    """
    keep = [c for c in df.columns if c not in deltas]
    w = Window.partitionBy(key).orderBy(day)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = df.select(*keep, *deltas, F.lag(day).over(w).alias("_prev"),
                  *[F.sum(c).over(upto).alias(f"_s{i}") for i, c in enumerate(deltas)])
    starts = F.col("_prev").isNull() | (F.date_add(F.col("_prev"), 1) != F.col(day))
    x = x.select(*keep, *[F.col(f"_s{i}") for i in range(len(deltas))],
                 *[F.last(F.when(starts, F.col(f"_s{i}") - F.col(c)), ignorenulls=True).over(upto).alias(f"_b{i}")
                   for i, c in enumerate(deltas)],
                 F.last(F.when(starts, F.col(day)), ignorenulls=True).over(upto).alias("_start"))
    runs = [(F.col(f"_s{i}") - F.col(f"_b{i}")) for i in range(len(deltas))]
    if opening is None:
        return x.select(*keep, *[r.alias(c) for r, c in zip(runs, deltas)])
    opening_cols = list(opening_cols or deltas)
    op = opening.select(F.col(key).alias("_okey"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(opening_cols)])
    x = x.join(op, x[key] == op["_okey"], "left")
    starts_lo = F.col("_start") == as_date(lo)
    return x.select(*keep, *[(r + F.when(starts_lo, F.coalesce(F.col(f"_o{i}"), F.lit(0))).otherwise(F.lit(0))).alias(c)
                             for i, (r, c) in enumerate(zip(runs, deltas))])
