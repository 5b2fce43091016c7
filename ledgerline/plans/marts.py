"""The daily marts and the monthly report.

Every function takes DataFrames with the reference's table columns and returns
a lazy DataFrame. A date range is done in one plan (grouped by day), not one
job per day.

Inputs
------
postings  ft_posting_f:  oper_date, credit_account_rk, debet_account_rk, credit_amount, debet_amount
accounts  md_account_d:  data_actual_date, data_actual_end_date, account_rk, account_number,
                         char_type, currency_rk, currency_code
rates     md_exchange_rate_d: data_actual_date, data_actual_end_date, currency_rk, reduced_cource
balances  ft_balance_f / dm_account_balance_f: on_date, account_rk, [currency_rk], balance_out[, balance_out_rub]
ledgers   md_ledger_account_s: ledger_account, chapter, start_date, end_date
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerline.functions.dates import OPEN_END, as_date, overlaps, prev_month_bounds
from ledgerline.functions.money import MONEY, money, to_rub, zero
from ledgerline.functions.rules import is_passive, is_rub
from ledgerline.operators.asof import (
    asof_lookup, asof_lookup_by_row, expand_to_days, versions_in,
    versions_on, within,
)
from ledgerline.operators.running import island_running_sum

TURNOVER_COLS = ("on_date", "account_rk", "credit_amount", "credit_amount_rub",
                 "debet_amount", "debet_amount_rub")
BALANCE_COLS = ("on_date", "account_rk", "balance_out", "balance_out_rub")


def _date(d) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def side_turnover(postings: DataFrame, d, side: str) -> DataFrame:
    """One side of a day's turnover: ``sum(coalesce(amount, 0))`` per account
    of that side, NULL accounts left out. ``side`` is ``credit`` or ``debet``."""
    acct, amount = f"{side}_account_rk", f"{side}_amount"
    return (postings.where((F.col("oper_date") == as_date(d)) & F.col(acct).isNotNull())
                    .groupBy(F.col(acct).alias("account_rk"))
                    .agg(money(F.sum(F.coalesce(F.col(amount), zero()))).alias(amount)))


def daily_turnover(postings: DataFrame, lo, hi) -> DataFrame:
    """Credit and debit sums per (day, account) for days in [lo, hi].

    Each posting is split into its credit side and its debit side (one scan,
    ``inline`` of a two-element array), then one aggregate sums both. That is
    the reference's two aggregates plus full outer join with zero fill, in one
    shuffle; the partial aggregate before the shuffle folds a hot account into
    one row per map task.
    """
    p = postings.where(within("oper_date", lo, hi))
    sides = F.array(
        F.struct(F.col("credit_account_rk").alias("account_rk"),
                 F.coalesce(money("credit_amount"), zero()).alias("c"), zero().alias("d")),
        F.struct(F.col("debet_account_rk").alias("account_rk"),
                 zero().alias("c"), F.coalesce(money("debet_amount"), zero()).alias("d")),
    )
    legs = (p.select(F.col("oper_date").alias("on_date"), F.inline(sides))
             .where(F.col("account_rk").isNotNull()))
    return legs.groupBy("on_date", "account_rk").agg(
        money(F.sum("c")).alias("credit_amount"), money(F.sum("d")).alias("debet_amount"))


def account_turnover(postings: DataFrame, accounts: DataFrame, rates: DataFrame, lo, hi=None) -> DataFrame:
    """dm_account_turnover_f rows for every day in [lo, hi] (one day when ``hi`` is None).

    Currency: the account version effective on the row's day; rate: the rate
    version of that currency effective on that day; no rate → 1.
    """
    hi = lo if hi is None else hi
    return in_roubles(daily_turnover(postings, lo, hi), accounts, rates, lo, hi)


def in_roubles(t: DataFrame, accounts: DataFrame, rates: DataFrame, lo, hi) -> DataFrame:
    """Daily sums (on_date, account_rk, credit_amount, debet_amount) with their rouble amounts."""
    acc = accounts.select("account_rk", "data_actual_date", "data_actual_end_date", "currency_rk")
    if _date(lo) == _date(hi):
        t = asof_lookup(t, acc, {"account_rk": "account_rk"}, lo, ["currency_rk"])
    else:
        t = asof_lookup_by_row(t, acc, {"account_rk": "account_rk"}, "on_date",
                               ["on_date", "account_rk"], ["currency_rk"])
    # Rate per (currency, day): currencies × days.
    day_rates = expand_to_days(rates, ["currency_rk"], lo, hi, ["reduced_cource"])
    day_rates = day_rates.withColumnRenamed("currency_rk", "_cur").withColumnRenamed("on_date", "_day")
    t = t.join(day_rates, (t["currency_rk"] == day_rates["_cur"]) & (t["on_date"] == day_rates["_day"]), "left")
    return t.select(
        "on_date", "account_rk", "credit_amount",
        to_rub("credit_amount", "reduced_cource").alias("credit_amount_rub"),
        "debet_amount",
        to_rub("debet_amount", "reduced_cource").alias("debet_amount_rub"),
    )


# ---------------------------------------------------------------- late postings

def late_turnover(stored: DataFrame, late: DataFrame, accounts: DataFrame, rates: DataFrame, lo, hi) -> tuple[DataFrame, DataFrame]:
    """(new turnover rows, change): what late postings of days in [lo, hi] make of the stored turnover.

    Only (day, account) pairs that the late postings touch come out. The
    amounts add up; the rouble amounts are converted again from the new sums,
    as their rounding does not add up. ``change`` (on_date, account_rk, chg,
    chg_rub) is new less stored, credit less debit.
    """
    sums = daily_turnover(late, lo, hi)
    old = (stored.where(within("on_date", lo, hi))
                 .join(sums.select(F.col("on_date").alias("_d"), F.col("account_rk").alias("_a")),
                       (F.col("on_date") == F.col("_d")) & (F.col("account_rk") == F.col("_a")), "left_semi"))
    both = old.select("on_date", "account_rk", "credit_amount", "debet_amount").unionByName(sums)
    total = both.groupBy("on_date", "account_rk").agg(money(F.sum("credit_amount")).alias("credit_amount"),
                                                      money(F.sum("debet_amount")).alias("debet_amount"))
    new = in_roubles(total, accounts, rates, lo, hi).select(*TURNOVER_COLS)
    change = DecimalType(24, 8)
    net = lambda sign, c, d: (sign * (F.col(c) - F.col(d))).cast(change)
    legs = [df.select("on_date", "account_rk", net(sign, "credit_amount", "debet_amount").alias("chg"),
                      net(sign, "credit_amount_rub", "debet_amount_rub").alias("chg_rub")) for df, sign in ((new, F.lit(1)), (old, F.lit(-1)))]
    moved = legs[0].unionByName(legs[1]).groupBy("on_date", "account_rk").agg(
        F.sum("chg").cast(change).alias("chg"), F.sum("chg_rub").cast(change).alias("chg_rub"))
    return new, moved


def late_balance(stored: DataFrame, change: DataFrame, accounts: DataFrame, lo, hi) -> DataFrame:
    """The stored balances of [lo, hi] of the accounts in ``change``, moved by suffix deltas.

    A day's signed change (the sign of the kind effective that day) is added to
    that day and the account's later days of the same run of consecutive days;
    a day on which the account has no balance changes nothing. ``lo`` must be
    no later than the first changed day. Other accounts' rows do not come out.
    """
    kinds = accounts.select("account_rk", "data_actual_date", "data_actual_end_date", is_passive("char_type").alias("_passive"))
    signed = asof_lookup_by_row(change.where(within("on_date", lo, hi)), kinds, {"account_rk": "account_rk"}, "on_date",
                                ["on_date", "account_rk"], ["_passive"])
    sign = lambda c: F.when(F.col("_passive"), F.col(c)).otherwise(-F.col(c))
    deltas = signed.select(F.col("account_rk").alias("_a"), F.col("on_date").alias("_d"), sign("chg").alias("_x"), sign("chg_rub").alias("_x_rub"))
    touched = change.select(F.col("account_rk").alias("_t")).distinct()
    rows = (stored.where(within("on_date", lo, hi)).join(touched, F.col("account_rk") == F.col("_t"), "left_semi")
                  .join(deltas, (F.col("account_rk") == F.col("_a")) & (F.col("on_date") == F.col("_d")), "left"))
    zero_if_none = lambda c: F.coalesce(F.col(c), F.lit(0).cast(DecimalType(24, 8))).alias(c)
    rows = rows.select(*BALANCE_COLS, zero_if_none("_x"), zero_if_none("_x_rub"))
    run = island_running_sum(rows, "account_rk", "on_date", ["_x", "_x_rub"], lo)
    return run.select("on_date", "account_rk", money(F.col("balance_out") + F.col("_x")).alias("balance_out"),
                      money(F.col("balance_out_rub") + F.col("_x_rub")).alias("balance_out_rub"))


def seed_balance(balances: DataFrame, rates: DataFrame, d) -> DataFrame:
    """Opening balance mart rows for date ``d`` from the source balance file,
    converted with the rate of the row's own currency effective on ``d``."""
    b = balances.where(F.col("on_date") == as_date(d)).select("on_date", "account_rk", "currency_rk", "balance_out")
    r = rates.select("data_actual_date", "data_actual_end_date",
                     F.col("currency_rk").alias("_cur"), "reduced_cource")
    b = asof_lookup(b, r, {"currency_rk": "_cur"}, d, ["reduced_cource"])
    return b.select("on_date", "account_rk", money("balance_out").alias("balance_out"),
                    to_rub("balance_out", "reduced_cource").alias("balance_out_rub"))


def account_balance(turnover: DataFrame, accounts: DataFrame, opening: DataFrame, lo, hi=None) -> DataFrame:
    """dm_account_balance_f rows for every day in [lo, hi].

    A row exists for each account active that day (latest version's kind
    decides the sign). ``opening`` holds balance rows; those on ``lo - 1`` seed
    the first island.

    Plan: account versions and the range's turnover rows are one union,
    hash-partitioned once by account; versions are expanded to their days
    inside the partitions, then the per-day aggregate (latest version's kind,
    the day's signed change) and the carry-forward windows all run on that
    partitioning. One exchange, of versions + turnover rows; a partition holds
    whole accounts, each at most one row per day of the range.
    """
    hi = lo if hi is None else hi
    change = DecimalType(24, 8)      # credit − debit of one day: fits 38 digits after the running sums
    none_c = F.lit(None).cast(change)
    versions = accounts.where(overlaps(lo, hi)).select(
        "account_rk", F.col("data_actual_date").alias("_from"), is_passive("char_type").alias("_passive"),
        F.greatest(F.col("data_actual_date"), as_date(lo)).alias("_s"),
        F.least(F.coalesce(F.col("data_actual_end_date"), F.lit(OPEN_END)), as_date(hi)).alias("_e"),
        none_c.alias("_chg"), none_c.alias("_chg_rub"))
    signed = lambda c, d: (F.coalesce(money(c), zero()) - F.coalesce(money(d), zero())).cast(change)
    turns = turnover.where(within("on_date", lo, hi)).select(
        "account_rk", F.lit(None).cast("date").alias("_from"), F.lit(None).cast("boolean").alias("_passive"),
        F.col("on_date").alias("_s"), F.col("on_date").alias("_e"),
        signed("credit_amount", "debet_amount").alias("_chg"),
        signed("credit_amount_rub", "debet_amount_rub").alias("_chg_rub"))
    # The exchange carries rows before the day expansion; its size says nothing about the
    # work after it, so its partition count is the configured one, not AQE's coalesced one.
    n = turnover.sparkSession.conf.get("spark.sql.shuffle.partitions")
    union = versions.unionByName(turns)
    rows = union.repartition(int(n), "account_rk") if n.isdigit() else union.repartition("account_rk")
    days = rows.select("account_rk", "_from", "_passive", "_chg", "_chg_rub",
                       # an inverted validity covers no day (a plain sequence would count down)
                       F.explode(F.when(F.col("_s") <= F.col("_e"), F.sequence("_s", "_e"))).alias("on_date"))
    # Fixed-width buffers only (date, boolean, decimal): a hash aggregate.
    per_day = (days.groupBy("account_rk", "on_date")
                   .agg(F.max("_from").alias("_active"), F.max_by("_passive", "_from").alias("_passive"),
                        F.sum("_chg").cast(change).alias("_chg"), F.sum("_chg_rub").cast(change).alias("_chg_rub"))
                   .where(F.col("_active").isNotNull()))
    # passive: +credit −debit; otherwise the opposite sign; no turnover: 0
    sign = lambda c: F.when(F.col("_passive"), F.coalesce(c, F.lit(0))).otherwise(-F.coalesce(c, F.lit(0)))
    x = per_day.select("account_rk", "on_date", sign(F.col("_chg")).alias("balance_out"),
                       sign(F.col("_chg_rub")).alias("balance_out_rub"))
    prev_day = _date(lo) - dt.timedelta(days=1)
    op = opening.where(F.col("on_date") == F.lit(prev_day)).select("account_rk", "balance_out", "balance_out_rub")
    x = island_running_sum(x, "account_rk", "on_date", ["balance_out", "balance_out_rub"], lo, op)
    return x.select("on_date", "account_rk", money("balance_out").alias("balance_out"),
                    money("balance_out_rub").alias("balance_out_rub"))


def report_accounts(accounts: DataFrame, ledgers: DataFrame, lo, hi) -> DataFrame:
    """Accounts of the report period with ledger prefix, kind, rouble flag and chapter.

    Latest version among those overlapping the period and carrying an account
    number; chapter = ledger version effective on the period's last day.
    """
    acc = versions_in(accounts.where(F.col("account_number").isNotNull()), lo, hi, ["account_rk"],
                      ["account_number", "char_type", "currency_code"])
    acc = acc.select("account_rk",
                     F.substring(F.col("account_number").cast("string"), 1, 5).alias("ledger_account"),
                     F.trim("char_type").alias("characteristic"),
                     F.trim("currency_code").alias("currency_code"))
    chapters = versions_on(ledgers, hi, ["ledger_account"], ["chapter"], "start_date", "end_date")
    chapters = chapters.select(F.col("ledger_account").cast("string").alias("_ledger"), "chapter")
    acc = acc.join(chapters, acc["ledger_account"] == chapters["_ledger"], "left")
    return (acc.where(F.col("ledger_account").isNotNull() & (F.length("ledger_account") == 5)
                      & F.col("characteristic").isNotNull())
               .select("account_rk", "ledger_account", "characteristic",
                       F.coalesce(F.col("chapter"), F.lit("")).alias("chapter"),
                       is_rub("currency_code").alias("is_rub")))


def monthly_turnover(turnover: DataFrame, lo, hi) -> DataFrame:
    """Rouble debit and credit sums per account over [lo, hi]."""
    return (turnover.where(within("on_date", lo, hi))
                    .groupBy("account_rk")
                    .agg(F.sum(F.coalesce(F.col("debet_amount_rub"), zero())).alias("debet_amount_rub"),
                         F.sum(F.coalesce(F.col("credit_amount_rub"), zero())).alias("credit_amount_rub")))


def period_measures(turnover: DataFrame, balances: DataFrame, lo, hi) -> DataFrame:
    """Per account: balance on ``lo - 1``, rouble debit and credit turnover in
    [lo, hi], balance on ``hi``.

    The reference joins the balance table twice and the month's turnover once;
    here the three sources are one union and one aggregate by account (one
    shuffle, each input read once). Equal to the joins when (day, account) is
    a key of both marts.
    """
    pre = _date(lo) - dt.timedelta(days=1)
    none = F.lit(None).cast(MONEY)
    b = (balances.where(F.col("on_date").isin(F.lit(pre), F.lit(_date(hi))))
                 .select("account_rk",
                         F.when(F.col("on_date") == F.lit(pre), F.col("balance_out_rub")).alias("balance_in"),
                         none.alias("turn_deb"), none.alias("turn_cre"),
                         F.when(F.col("on_date") == F.lit(_date(hi)), F.col("balance_out_rub")).alias("balance_out")))
    t = (turnover.where(within("on_date", lo, hi))
                 .select("account_rk", none.alias("balance_in"), F.col("debet_amount_rub").alias("turn_deb"),
                         F.col("credit_amount_rub").alias("turn_cre"), none.alias("balance_out")))
    return b.unionByName(t).groupBy("account_rk").agg(
        *[F.sum(m).alias(m) for m in ("balance_in", "turn_deb", "turn_cre", "balance_out")])


# Fixed value: report measures, in the report's column order.
F101_MEASURES = ("balance_in", "turn_deb", "turn_cre", "balance_out")
F101_COLS = ("from_date", "to_date", "chapter", "ledger_account", "characteristic") + tuple(
    f"{m}_{s}" for m in F101_MEASURES for s in ("rub", "val", "total"))


def form101(accounts: DataFrame, ledgers: DataFrame, turnover: DataFrame, balances: DataFrame,
            report_date) -> DataFrame:
    """dm_f101_round_f rows for the month before ``report_date``.

    Per (chapter, ledger prefix, kind): opening, debit and credit turnover,
    closing, each split rouble / currency / total.
    """
    lo, hi = prev_month_bounds(report_date)
    base = report_accounts(accounts, ledgers, lo, hi)
    x = base.join(period_measures(turnover, balances, lo, hi), "account_rk", "left")
    sums = []
    for m in F101_MEASURES:
        v = F.coalesce(F.col(m), F.lit(0))
        sums += [money(F.sum(F.when(F.col("is_rub"), v).otherwise(F.lit(0)))).alias(f"{m}_rub"),
                 money(F.sum(F.when(~F.col("is_rub"), v).otherwise(F.lit(0)))).alias(f"{m}_val"),
                 money(F.sum(v)).alias(f"{m}_total")]
    out = x.groupBy(F.nullif(F.col("chapter"), F.lit("")).alias("chapter"), "ledger_account", "characteristic").agg(*sums)
    return out.select(F.lit(lo).alias("from_date"), F.lit(hi).alias("to_date"), *F101_COLS[2:])


def active_account_count(accounts: DataFrame, d) -> DataFrame:
    """``rows_read`` of the balance job: accounts effective on ``d``."""
    return versions_on(accounts, d, ["account_rk"], ["char_type"]).agg(F.count(F.lit(1)).alias("rows_count"))


__all__ = [
    "TURNOVER_COLS", "BALANCE_COLS", "F101_COLS", "side_turnover", "daily_turnover",
    "account_turnover", "seed_balance", "account_balance", "report_accounts",
    "monthly_turnover", "form101", "active_account_count", "MONEY",
]
