"""Named queries, part 2: quality checks, task-2 marts, as-of lookups, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import quality, sketch
from ledgerline.operators.asof import asof_lookup, versions_in, versions_on
from ledgerline.plans import marts, task2
from ledgerline.plans.queries import (
    ACTIVE_DAY, DAY, RANGE_HI, RANGE_LO, REPORT_DATE, _mart_sql, _q, balances_all, f101, query,
    turnover_range,
)
from ledgerline.sources.fixtures import fixtures, with_views

_ACCOUNT_COLS = "account_rk, data_actual_date, data_actual_end_date, account_number, char_type, currency_rk, currency_code"
_CLIENT_COLS = ("client_rk", "effective_from_date", "effective_to_date", "branch_no", "note_no", "src_no", "flag")


# ---------------------------------------------------------------- as-of

@query("active_accounts_on", with_views(f"""
SELECT {_ACCOUNT_COLS} FROM (
  SELECT a.*, row_number() OVER (PARTITION BY account_rk ORDER BY data_actual_date DESC) AS rn
  FROM v_account a
  WHERE {_q(ACTIVE_DAY)} BETWEEN data_actual_date AND coalesce(data_actual_end_date, DATE '5999-12-31')) s
WHERE rn = 1""", "v_account"))
def q_active_accounts_on(spark, sf_dir):
    acc = fixtures(spark, sf_dir).v_account
    return versions_on(acc, ACTIVE_DAY, ["account_rk"], [c for c in acc.columns if c != "account_rk"])


@query("active_account_count", with_views(f"""
SELECT count(DISTINCT account_rk) AS rows_count FROM v_account
WHERE {_q(ACTIVE_DAY)} BETWEEN data_actual_date AND coalesce(data_actual_end_date, DATE '5999-12-31')""", "v_account"))
def q_active_account_count(spark, sf_dir):
    return marts.active_account_count(fixtures(spark, sf_dir).v_account, ACTIVE_DAY)


@query("active_accounts_in_period", with_views(f"""
SELECT {_ACCOUNT_COLS} FROM (
  SELECT a.*, row_number() OVER (PARTITION BY account_rk ORDER BY data_actual_date DESC) AS rn
  FROM v_account a
  WHERE data_actual_date <= {_q(RANGE_HI)} AND coalesce(data_actual_end_date, DATE '5999-12-31') >= {_q(RANGE_LO)}) s
WHERE rn = 1""", "v_account"))
def q_active_accounts_in_period(spark, sf_dir):
    acc = fixtures(spark, sf_dir).v_account
    return versions_in(acc, RANGE_LO, RANGE_HI, ["account_rk"], [c for c in acc.columns if c != "account_rk"])


@query("asof_account_currency", with_views(f"""
WITH legs AS (SELECT unnest([credit_account_rk, debet_account_rk]) AS account_rk FROM v_posting WHERE oper_date = {_q(DAY)}),
valid AS (SELECT account_rk, arg_max_null(currency_rk, data_actual_date) AS currency_rk FROM v_account
          WHERE data_actual_date <= {_q(DAY)} AND (data_actual_end_date IS NULL OR data_actual_end_date >= {_q(DAY)}) GROUP BY account_rk)
SELECT DISTINCT legs.account_rk, valid.currency_rk FROM legs LEFT JOIN valid USING (account_rk)
WHERE legs.account_rk IS NOT NULL""", "v_posting", "v_account"))
def q_asof_account_currency(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    p = fx.v_posting.where(F.col("oper_date") == F.lit(DAY))
    accts = (p.select(F.col("credit_account_rk").alias("account_rk"))
              .union(p.select(F.col("debet_account_rk").alias("account_rk")))
              .where(F.col("account_rk").isNotNull()).distinct())
    acc = fx.v_account.select("account_rk", "data_actual_date", "data_actual_end_date",
                              F.col("account_rk").alias("_ak"), "currency_rk").drop("account_rk")
    return asof_lookup(accts, acc, {"account_rk": "_ak"}, DAY, ["currency_rk"])


@query("asof_ledger_chapter", with_views(f"""
WITH numbered AS (SELECT account_rk, arg_max(account_number, data_actual_date) AS number FROM v_account
                  WHERE account_number IS NOT NULL AND data_actual_date <= {_q(RANGE_HI)}
                    AND (data_actual_end_date IS NULL OR data_actual_end_date >= {_q(RANGE_LO)}) GROUP BY account_rk),
chapters AS (SELECT CAST(ledger_account AS STRING) AS code, arg_max_null(chapter, start_date) AS chapter FROM v_ledger
             WHERE start_date <= {_q(RANGE_HI)} AND (end_date IS NULL OR end_date >= {_q(RANGE_HI)}) GROUP BY ledger_account)
SELECT account_rk, left(CAST(number AS STRING), 5) AS ledger_account, chapter
FROM numbered LEFT JOIN chapters ON code = left(CAST(number AS STRING), 5)""", "v_account", "v_ledger"))
def q_asof_ledger_chapter(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    acc = versions_in(fx.v_account.where(F.col("account_number").isNotNull()), RANGE_LO, RANGE_HI,
                      ["account_rk"], ["account_number"])
    acc = acc.select("account_rk", F.substring(F.col("account_number").cast("string"), 1, 5).alias("ledger_account"))
    led = fx.v_ledger.select(F.col("ledger_account").cast("string").alias("_lk"), "chapter", "start_date", "end_date")
    return asof_lookup(acc, led, {"ledger_account": "_lk"}, RANGE_HI, ["chapter"], "start_date", "end_date")


@query("report_period_bounds", with_views("""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date,
       CAST(date_trunc('month', CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS DATE) AS from_date,
       CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) - 1 AS to_date
FROM orders"""))
def q_report_period_bounds(spark, sf_dir):
    from ledgerline.functions.dates import prev_month_bounds_col
    o = fixtures(spark, sf_dir).orders.select(F.col("o_orderdate").cast("date").alias("report_date")).distinct()
    lo, hi = prev_month_bounds_col("report_date")
    return o.select("report_date", lo.alias("from_date"), hi.alias("to_date"))


# ---------------------------------------------------------------- duplicates

@query("duplicate_keys", with_views("""
SELECT client_rk, effective_from_date, count(*) AS rows_count FROM v_client
GROUP BY client_rk, effective_from_date HAVING count(*) > 1""", "v_client"))
def q_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(fixtures(spark, sf_dir).v_client, ["client_rk", "effective_from_date"]).orderBy(
        "client_rk", "effective_from_date")


@query("duplicate_keys_sketched", with_views("""
SELECT client_rk, effective_from_date, count(*) AS rows_count FROM v_client
GROUP BY client_rk, effective_from_date HAVING count(*) > 1""", "v_client"))
def q_duplicate_keys_sketched(spark, sf_dir):
    """The same keys through the fixed-size sketch; its bitmap is built while the frame is."""
    return sketch.repeated_keys(fixtures(spark, sf_dir).v_client, ["client_rk", "effective_from_date"])


@query("duplicate_key_count", with_views("""
SELECT count(*) AS duplicate_keys FROM (
  SELECT client_rk, effective_from_date FROM v_client GROUP BY client_rk, effective_from_date HAVING count(*) > 1) d""",
                                         "v_client"))
def q_duplicate_key_count(spark, sf_dir):
    return quality.duplicate_key_count(fixtures(spark, sf_dir).v_client, ["client_rk", "effective_from_date"])


_KEYED = (("v_client", ("client_rk", "effective_from_date")),
          ("v_account", ("data_actual_date", "account_rk")),
          ("v_rate", ("data_actual_date", "currency_rk")),
          ("v_ledger", ("ledger_account", "start_date")),
          ("v_chain", ("account_rk", "effective_date")),
          ("v_deal", ("deal_rk", "effective_from_date")))


@query("key_violations", with_views("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, concat_ws('|', {', '.join(f'CAST({k} AS STRING)' for k in keys)}) AS key_text, "
    f"count(*) AS rows_count FROM {t} GROUP BY {', '.join(keys)} HAVING count(*) > 1"
    for t, keys in _KEYED), *[t for t, _ in _KEYED]))
def q_key_violations(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return quality.key_violations({t: (fx[t], keys) for t, keys in _KEYED})


def _nth_copies(which: str) -> str:
    """Rows of a key by their place in the order of their other columns, NULLs last."""
    cols, rest = ", ".join(_CLIENT_COLS), ", ".join(f"{c} NULLS LAST" for c in _CLIENT_COLS[2:])
    return with_views(f"SELECT {cols} FROM v_client WINDOW same_key AS (PARTITION BY client_rk, effective_from_date ORDER BY {rest}) "
                      f"QUALIFY row_number() OVER same_key {which}", "v_client")


@query("dedup_kept", _nth_copies("= 1"))
def q_dedup_kept(spark, sf_dir):
    kept, _ = quality.dedup_split(fixtures(spark, sf_dir).v_client, ["client_rk", "effective_from_date"])
    return kept


@query("dedup_deleted", _nth_copies("> 1"))
def q_dedup_deleted(spark, sf_dir):
    _, deleted = quality.dedup_split(fixtures(spark, sf_dir).v_client, ["client_rk", "effective_from_date"])
    # returned in the reference's order: key, then end date and the rest NULLS LAST
    return deleted.orderBy("client_rk", "effective_from_date",
                           *[F.col(c).asc_nulls_last() for c in _CLIENT_COLS[2:]])


@query("not_null_violations", with_views("""
SELECT oper_date, credit_account_rk, debet_account_rk, credit_amount, debet_amount,
       concat_ws(',', CASE WHEN credit_account_rk IS NULL THEN 'credit_account_rk' END,
                      CASE WHEN debet_account_rk IS NULL THEN 'debet_account_rk' END) AS null_columns
FROM v_posting WHERE credit_account_rk IS NULL OR debet_account_rk IS NULL""", "v_posting"))
def q_not_null_violations(spark, sf_dir):
    return quality.not_null_violations(fixtures(spark, sf_dir).v_posting, ["credit_account_rk", "debet_account_rk"])


@query("length_violations", """
SELECT c_custkey, 'c_mktsegment' AS column_name, c_mktsegment AS value, CAST(length(c_mktsegment) AS INTEGER) AS value_length,
       9 AS max_length
FROM customer WHERE length(c_mktsegment) > 9""")
def q_length_violations(spark, sf_dir):
    return quality.length_violations(fixtures(spark, sf_dir).customer, {"c_mktsegment": 9}, ["c_custkey"])


# ---------------------------------------------------------------- balance chain

def _beside(view: str, which: str) -> str:
    """Every row with the account's row before (``lag``) or after it (``lead``)."""
    other = "{'day': effective_date, 'opened': account_in_sum, 'closed': account_out_sum}"
    return f"(SELECT *, {which}({other}) OVER (PARTITION BY account_rk ORDER BY effective_date) AS o FROM {view})"


_IN_ERR = f"""
SELECT account_rk, effective_date, account_in_sum AS wrong_account_in_sum, o.closed AS correct_account_in_sum,
       o.day AS previous_effective_date
FROM {_beside("v_chain", "lag")} WHERE effective_date - o.day = 1 AND account_in_sum IS DISTINCT FROM o.closed"""


@query("balance_chain_in_errors", with_views(_IN_ERR, "v_chain"))
def q_balance_chain_in_errors(spark, sf_dir):
    return quality.chain_in_errors(fixtures(spark, sf_dir).v_chain).orderBy("account_rk", "effective_date")


@query("balance_chain_out_errors", with_views(f"""
SELECT account_rk, effective_date, account_out_sum AS wrong_account_out_sum, o.opened AS correct_account_out_sum,
       o.day AS next_effective_date
FROM {_beside("v_chain", "lead")} WHERE o.day - effective_date = 1 AND account_out_sum IS DISTINCT FROM o.opened""", "v_chain"))
def q_balance_chain_out_errors(spark, sf_dir):
    return quality.chain_out_errors(fixtures(spark, sf_dir).v_chain).orderBy("account_rk", "effective_date")


_FIXED = f"""
fixed AS (SELECT account_rk, effective_date, CASE effective_date - o.day WHEN 1 THEN o.closed ELSE account_in_sum END AS account_in_sum,
                 account_out_sum FROM {_beside("v_chain", "lag")})"""


def _chain_sql(body: str) -> str:
    head = with_views("SELECT 1", "v_chain")[: -len("SELECT 1")].rstrip()
    return head + ",\n" + _FIXED.strip() + "\n" + body


@query("balance_chain_fixed", _chain_sql("SELECT * FROM fixed"))
def q_balance_chain_fixed(spark, sf_dir):
    fixed, _ = quality.repair_chain(fixtures(spark, sf_dir).v_chain)
    return fixed


@query("balance_chain_remaining", _chain_sql(f"""
SELECT count(*) AS mismatched_rows FROM {_beside("fixed", "lag")}
WHERE effective_date - o.day = 1 AND account_in_sum IS DISTINCT FROM o.closed"""))
def q_balance_chain_remaining(spark, sf_dir):
    fixed, _ = quality.repair_chain(fixtures(spark, sf_dir).v_chain)
    return quality.chain_mismatch_count(fixed)


# ---------------------------------------------------------------- task-2 marts

def _sides() -> str:
    parts = [f"SELECT '{name}' AS table_name, {old} AS old, effective_from_date, effective_to_date FROM {view}"
             for name, old, view in (("deal_info", "false", "v_stg_deal"), ("product", "false", "v_stg_product"),
                                     ("deal_info", "true", "v_rd_deal"), ("product", "true", "v_rd_product"))]
    return " UNION ALL ".join(parts)


@query("period_reconciliation", with_views(f"""
SELECT table_name, effective_from_date, effective_to_date, nullif(count(*) FILTER (NOT old), 0) AS csv_rows_count,
       nullif(count(*) FILTER (old), 0) AS rd_rows_count,
       CASE 0 WHEN count(*) FILTER (old) THEN 'missing_in_rd' WHEN count(*) FILTER (NOT old) THEN 'extra_in_rd' ELSE 'row_count_differs' END AS problem
FROM ({_sides()}) GROUP BY ALL HAVING count(*) FILTER (old) <> count(*) FILTER (NOT old)""",
                                           "v_stg_deal", "v_stg_product", "v_rd_deal", "v_rd_product"))
def q_period_reconciliation(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return quality.reconcile_periods({"deal_info": fx.v_stg_deal, "product": fx.v_stg_product},
                                     {"deal_info": fx.v_rd_deal, "product": fx.v_rd_product}).orderBy(
        "table_name", "effective_from_date", "effective_to_date")


_DEALS = """
FROM v_deal LEFT JOIN v_holiday AS pause USING (deal_rk, effective_from_date)
LEFT JOIN v_product AS sold ON sold.product_rk = v_deal.product_rk
 AND v_deal.effective_from_date >= sold.effective_from_date AND v_deal.effective_from_date <= sold.effective_to_date"""


@query("loan_holiday_info", with_views(f"""
SELECT deal_rk, v_deal.effective_from_date AS effective_from_date, coalesce(pause.effective_to_date, v_deal.effective_to_date) AS effective_to_date,
       agreement_rk, account_rk, client_rk, department_rk, v_deal.product_rk AS product_rk, product_name, deal_type_cd, deal_start_date,
       deal_name, deal_num AS deal_number, deal_sum, COLUMNS('loan_holiday_.*')
{_DEALS}""", "v_deal", "v_holiday", "v_product"))
def q_loan_holiday_info(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return task2.loan_holiday_info(fx.v_deal, fx.v_holiday, fx.v_product)


@query("join_row_count", with_views(f"SELECT count(*) AS rows_count {_DEALS}", "v_deal", "v_holiday", "v_product"))
def q_join_row_count(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return task2.loan_holiday_rows_read(fx.v_deal, fx.v_holiday, fx.v_product)


@query("balance_turnover_rows_read", with_views("""
SELECT count(*) AS rows_count FROM v_chain JOIN v_acct USING (account_rk) LEFT JOIN v_dict_currency USING (currency_cd)
WHERE effective_date IS NOT NULL""", "v_acct", "v_chain", "v_dict_currency"))
def q_balance_turnover_rows_read(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return task2.balance_turnover_rows_read(fx.v_acct, fx.v_chain, fx.v_dict_currency)


@query("account_balance_turnover", with_views("""
SELECT account_rk, coalesce(currency_name, '-1') AS currency_name, department_rk, effective_date, account_in_sum, account_out_sum
FROM v_chain JOIN v_acct USING (account_rk) LEFT JOIN v_dict_currency USING (currency_cd)
WHERE effective_date IS NOT NULL""", "v_acct", "v_chain", "v_dict_currency"))
def q_account_balance_turnover(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return task2.account_balance_turnover(fx.v_acct, fx.v_chain, fx.v_dict_currency)


# ---------------------------------------------------------------- mart counts

@query("table_counts", _mart_sql("""
SELECT 'ft_posting_f' AS table_name, count(*) AS rows_count FROM v_posting
UNION ALL SELECT 'dm_account_turnover_f', count(*) FROM turnover
UNION ALL SELECT 'dm_account_balance_f', count(*) FROM bal_all
UNION ALL SELECT 'dm_f101_round_f', count(*) FROM f101""", report=REPORT_DATE))
def q_table_counts(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    t = turnover_range(fx)
    b = balances_all(fx)
    r = f101(fx)
    parts = [("ft_posting_f", fx.v_posting), ("dm_account_turnover_f", t), ("dm_account_balance_f", b),
             ("dm_f101_round_f", r)]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("rows_count")).select(F.lit(name).alias("table_name"), "rows_count")
        out = c if out is None else out.unionByName(c)
    return out


@query("rows_by_date", _mart_sql("""
SELECT 'dm_account_turnover_f' AS table_name, on_date, count(*) AS rows_count FROM turnover GROUP BY on_date
UNION ALL SELECT 'dm_account_balance_f', on_date, count(*) FROM bal_all GROUP BY on_date"""))
def q_rows_by_date(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    t = turnover_range(fx)
    b = balances_all(fx)
    return (t.groupBy("on_date").agg(F.count(F.lit(1)).alias("rows_count"))
             .select(F.lit("dm_account_turnover_f").alias("table_name"), "on_date", "rows_count")
             .unionByName(b.groupBy("on_date").agg(F.count(F.lit(1)).alias("rows_count"))
                           .select(F.lit("dm_account_balance_f").alias("table_name"), "on_date", "rows_count")))


@query("top_n_rows", _mart_sql("SELECT * FROM turnover ORDER BY on_date DESC, account_rk DESC LIMIT 20", balance=False))
def q_top_n_rows(spark, sf_dir):
    t = turnover_range(fixtures(spark, sf_dir))
    return t.orderBy(F.col("on_date").desc(), F.col("account_rk").desc()).limit(20)
