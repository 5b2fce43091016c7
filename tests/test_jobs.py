import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import jobs, marts

D = dt.date

FILES = {
    "md_currency_d": "CURRENCY_RK;DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_CODE;CODE_ISO_CHAR\n"
                     "50;2018-01-01;;840;USD\n34;2018-01-01;;643;RUB\n",
    "md_exchange_rate_d": "DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_RK;REDUCED_COURCE;CODE_ISO_NUM\n"
                          "2017-12-01;2018-01-14;50;60.5;840\n2018-01-15;;50;61.25;840\n",
    "md_ledger_account_s": "CHAPTER;CHAPTER_NAME;SECTION_NUMBER;SECTION_NAME;SUBSECTION_NAME;LEDGER1_ACCOUNT;"
                           "LEDGER1_ACCOUNT_NAME;LEDGER_ACCOUNT;LEDGER_ACCOUNT_NAME;CHARACTERISTIC;START_DATE;END_DATE\n"
                           "А;Активы;1;s;ss;301;n;30101;name;А;2008-01-01;2050-12-31\n"
                           "А;Активы;1;s;ss;301;n;30102;name;П;2008-01-01;\n",
    "md_account_d": "DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;ACCOUNT_RK;ACCOUNT_NUMBER;CHAR_TYPE;CURRENCY_RK;CURRENCY_CODE\n"
                    "2018-01-01;2018-01-31;1;30101840000000000001;А;50;840\n"
                    "2018-01-01;2018-01-31;2;30102810000000000002;П;34;643\n",
    "ft_balance_f": "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\r\n31.12.2017;1;50;100.5\r\n31.12.2017;2;34;2000",
    "ft_posting_f": "OPER_DATE;CREDIT_ACCOUNT_RK;DEBET_ACCOUNT_RK;CREDIT_AMOUNT;DEBET_AMOUNT\n"
                    "2018-01-09;1;2;10;10\n2018-01-20;2;1;5.5;5.5\n2018-01-20;1;;1;\n",
}


def _write(tmp_path, name, text, encoding="utf-8"):
    p = tmp_path / f"{name}.csv"
    with open(p, "w", encoding=encoding, newline="") as fh:
        fh.write(text)
    return str(p)


@pytest.fixture()
def loaded(spark, tmp_path):
    files = {n: _write(tmp_path, n, t) for n, t in FILES.items()}
    root = str(tmp_path / "tables")
    run = jobs.load_all(spark, files, root)
    return root, run


def test_load_all_stores_tables_and_audits(spark, loaded):
    root, run = loaded
    counts = {n: spark.read.parquet(f"{root}/ds/{n}").count() for n in FILES}
    assert counts == {"md_currency_d": 2, "md_exchange_rate_d": 2, "md_ledger_account_s": 2, "md_account_d": 2,
                      "ft_balance_f": 2, "ft_posting_f": 3}
    tlog = spark.read.parquet(f"{root}/logs/etl_table_log").where(F.col("run_id") == run.run_id)
    assert tlog.where("status = 'SUCCESS'").count() == 6 and tlog.where("status = 'STARTED'").count() == 6
    rlog = spark.read.parquet(f"{root}/logs/etl_run_log").where(F.col("status") == "SUCCESS").first()
    assert (rlog.total_rows_read, rlog.total_rows_loaded) == (13, 13)
    # the load order: dimensions first
    order = [r.table_name for r in tlog.where("status = 'STARTED'").orderBy("started_at").collect()]
    assert order[-2:] == ["ds.ft_balance_f", "ds.ft_posting_f"]


def test_load_all_failure_is_audited(spark, tmp_path):
    files = {"ft_balance_f": _write(tmp_path, "b", "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n2017-13-45;1;1;1\n")}
    root = str(tmp_path / "t")
    with pytest.raises(ValueError, match="invalid date"):
        jobs.load_all(spark, files, root)
    t = spark.read.parquet(f"{root}/logs/etl_table_log").where("status = 'FAILED'").first()
    assert "invalid date" in t.error_message
    assert spark.read.parquet(f"{root}/logs/etl_run_log").where("status = 'FAILED'").count() == 1


def test_run_month_matches_in_memory_chain_and_is_idempotent(spark, loaded):
    root, _ = loaded
    run = jobs.run_month(spark, root, D(2018, 2, 1))
    rep_ev = (spark.read.parquet(f"{root}/logs/etl_table_log")
              .where((F.col("run_id") == run.run_id) & (F.col("table_name") == "dm.dm_f101_round_f")
                     & (F.col("status") == "SUCCESS")).first())
    assert rep_ev.rows_read == 2      # accounts of the period
    ds = lambda t: spark.read.parquet(f"{root}/ds/{t}")
    lo, hi = D(2018, 1, 1), D(2018, 1, 31)
    t = marts.account_turnover(ds("ft_posting_f"), ds("md_account_d"), ds("md_exchange_rate_d"), lo, hi)
    seed = marts.seed_balance(ds("ft_balance_f"), ds("md_exchange_rate_d"), D(2017, 12, 31))
    b = seed.unionByName(marts.account_balance(t, ds("md_account_d"), seed, lo, hi))
    rep = marts.form101(ds("md_account_d"), ds("md_ledger_account_s"), t, b, D(2018, 2, 1))

    def stored(name, cols):
        return sorted(tuple(r) for r in spark.read.parquet(f"{root}/dm/{name}").select(*cols).collect())

    assert stored("dm_account_turnover_f", marts.TURNOVER_COLS) == sorted(tuple(r) for r in t.collect())
    assert stored("dm_account_balance_f", marts.BALANCE_COLS) == sorted(tuple(r) for r in b.collect())
    assert stored("dm_f101_round_f", marts.F101_COLS) == sorted(tuple(r) for r in rep.collect())
    assert len(stored("dm_account_balance_f", marts.BALANCE_COLS)) == 2 + 2 * 31
    jobs.run_month(spark, root, D(2018, 2, 1))     # rerun replaces, never duplicates
    assert len(stored("dm_account_balance_f", marts.BALANCE_COLS)) == 2 + 2 * 31
    assert stored("dm_f101_round_f", marts.F101_COLS) == sorted(tuple(r) for r in rep.collect())


def test_load_extracts_two_steps(spark, tmp_path):
    files = {"deal_info": _write(tmp_path, "deal", "deal_rk,deal_name\n1,Кредит\n2,Ипотека\n", "cp1251"),
             "product": _write(tmp_path, "prod", "product_rk,product_name\n7,Продукт\n", "cp1251")}
    root = str(tmp_path / "t")
    run = jobs.load_extracts(spark, files, root, "all")
    assert (run.rows_read, run.rows_loaded) == (6, 6)
    assert sorted(r.deal_name for r in spark.read.parquet(f"{root}/rd/deal_info").collect()) == ["Ипотека", "Кредит"]
    run2 = jobs.load_extracts(spark, files, root, "rd")
    assert (run2.rows_read, run2.rows_loaded) == (3, 3)
