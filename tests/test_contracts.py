"""Contracts at load time, partitioned detail tables, and the stored task-2 and report jobs."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import write
from ledgerline.plans import jobs, marts, task2
from ledgerline.sources import ingest
from ledgerline.sources.specs import TABLES

D = dt.date
ACCOUNT = "DATA_ACTUAL_DATE; DATA_ACTUAL_END_DATE ;ACCOUNT_RK;ACCOUNT_NUMBER;CHAR_TYPE;CURRENCY_RK;CURRENCY_CODE\n"
BALANCE = "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n"


def _file(tmp_path, text, name="f.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_text(text, encoding=encoding)
    return str(path)


@pytest.mark.parametrize("line, said", [
    ("2018-01-01;;;1;P;1;643", "1 rows with null account_rk"),
    (";;5;1;P;1;643", "1 rows with null data_actual_date"),
    ("2018-01-01;;5;1;LONGTYPE;1;643", "1 rows with char_type over 1 characters"),
    ("2018-01-01;;5;1;P;1;6433", "1 rows with currency_code over 3 characters"),
    ("2018-13-01;;5;1;P;1;643", "1 rows with invalid date"),
])
def test_a_file_that_breaks_a_contract_is_rejected(spark, tmp_path, line, said):
    good = "2018-01-01;;4;1;P;1;643\n"
    with pytest.raises(ingest.RejectedLoad, match=said) as err:
        ingest.load_table(spark, TABLES["md_account_d"], _file(tmp_path, ACCOUNT + good + line + "\n"))
    assert err.value.rows_read == 2


def test_postings_need_a_date_but_no_account(spark, tmp_path):
    head = "OPER_DATE;CREDIT_ACCOUNT_RK;DEBET_ACCOUNT_RK;CREDIT_AMOUNT;DEBET_AMOUNT\n"
    assert ingest.load_table(spark, TABLES["ft_posting_f"], _file(tmp_path, head + "2018-01-09;;;1;1\n")).table.count() == 1
    with pytest.raises(ingest.RejectedLoad, match="null oper_date"):
        ingest.load_table(spark, TABLES["ft_posting_f"], _file(tmp_path, head + ";1;1;1;1\n", "g.csv"))


def test_a_rejected_load_keeps_the_table_and_audits_the_counts(spark, tmp_path):
    root = str(tmp_path / "t")
    jobs.load_all(spark, {"ft_balance_f": _file(tmp_path, BALANCE + "2017-12-31;1;1;5\n")}, root)
    bad = _file(tmp_path, BALANCE + "2017-12-31;1;1;oops\n2017-99-31;2;1;6\n", "bad.csv")
    with pytest.raises(ingest.RejectedLoad):
        jobs.load_all(spark, {"ft_balance_f": bad}, root)
    assert [r.balance_out for r in spark.read.parquet(f"{root}/ds/ft_balance_f").collect()] == [Decimal(5)]
    ev = spark.read.parquet(f"{root}/logs/etl_table_log").where("status = 'FAILED'").first()
    assert (ev.rows_read, ev.bad_date_rows, ev.bad_number_rows) == (2, 1, 1)
    assert ev.ended_at >= ev.started_at


def test_a_load_rewrites_the_days_of_its_file_only(spark, tmp_path):
    root = str(tmp_path / "t")
    jobs.load_all(spark, {"ft_balance_f": _file(tmp_path, BALANCE + "2017-12-30;1;1;5\n2017-12-31;1;1;6\n2017-12-31;2;1;7\n")}, root)
    folder = f"{root}/ds/ft_balance_f"
    before = set(os.listdir(f"{folder}/on_date=2017-12-30"))
    again = _file(tmp_path, BALANCE + "2017-12-31;2;1;70\n2018-01-01;3;1;8\n", "again.csv")
    for _ in range(2):   # a rerun gives the same table
        jobs.load_all(spark, {"ft_balance_f": again}, root)
        got = sorted((r.on_date.day, int(r.account_rk), int(r.balance_out)) for r in spark.read.parquet(folder).collect())
        assert got == [(1, 3, 8), (30, 1, 5), (31, 1, 6), (31, 2, 70)]
    assert set(os.listdir(f"{folder}/on_date=2017-12-30")) == before
    plan = spark.read.parquet(folder).where(F.col("on_date") == F.lit(D(2017, 12, 31)))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(on_date" in plan


def test_upsert_twice_with_null_keys_is_the_same_table(spark):
    t = spark.createDataFrame([(None, 1), (2, 3)], "k int, v int")
    assert sorted(map(tuple, write.upsert_by_key(t, t, ["k"]).collect()), key=str) == sorted([(None, 1), (2, 3)], key=str)


def test_lines_are_read_like_a_file(spark):
    df = spark.createDataFrame([("1; a ;",), (";b",)], "line string")
    assert [tuple(r) for r in ingest.split_lines(df, "line", " ID ;Name;X").collect()] == [("1", " a ", None), (None, "b", None)]


def test_extracts_keep_the_types_of_the_detail_table(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = spark.createDataFrame([], "deal_rk bigint, deal_start_date date, deal_sum decimal(23,8), deal_name string").schema
    text = "deal_rk,deal_sum,deal_start_date,deal_name,more\n1,2.5,2020-01-02,Кредит,x\n,,,,\n"
    files = {"deal_info": _file(tmp_path, text, encoding="cp1251")}
    jobs.load_extracts(spark, files, root, "all", {"deal_info": schema})
    jobs.load_extracts(spark, files, root)            # types now come from the stored table
    rd = spark.read.parquet(f"{root}/rd/deal_info")
    assert [f.dataType for f in rd.schema] == [f.dataType for f in schema]
    assert sorted(map(tuple, rd.collect()), key=str)[0] == (1, D(2020, 1, 2), Decimal("2.5"), "Кредит")
    files["deal_info"] = _file(tmp_path, text.replace("2.5", "2,5x"), encoding="cp1251")
    with pytest.raises(Exception, match="not a "):
        jobs.load_extracts(spark, files, root)
    assert rd.count() == 2


@pytest.fixture()
def task2_root(spark, tmp_path):
    root = str(tmp_path / "tables")
    day = D(2020, 1, 1)

    def put(layer, name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{layer}/{name}")
    put("rd", "deal_info", [(1, day, D(2999, 12, 31), 7, Decimal(5)), (2, day, D(2999, 12, 31), 9, None)],
        "deal_rk long, effective_from_date date, effective_to_date date, product_rk long, deal_sum decimal(23,8)")
    put("rd", "loan_holiday", [(1, day, D(2020, 2, 1), "A")], "deal_rk long, effective_from_date date, effective_to_date date, loan_holiday_type_cd string")
    put("rd", "product", [(7, "p", day, D(2999, 12, 31))], "product_rk long, product_name string, effective_from_date date, effective_to_date date")
    put("rd", "account", [(1, "840", 3), (2, "xxx", 4)], "account_rk long, currency_cd string, department_rk long")
    put("rd", "account_balance", [(1, day, Decimal(0), Decimal(10)), (1, D(2020, 1, 2), Decimal(9), Decimal(20)), (2, day, None, Decimal(1)),
                                  (2, D(2020, 1, 3), Decimal(5), Decimal(1))],
        "account_rk long, effective_date date, account_in_sum decimal(23,8), account_out_sum decimal(23,8)")
    put("dm", "dict_currency", [("840", "USD")], "currency_cd string, currency_name string")
    put("dm", "client", [(1, day, "a"), (1, day, "b"), (1, day, "b"), (2, day, "c")], "client_rk long, effective_from_date date, name string")
    return root


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).collect()), key=str)


def test_task2_marts_reload_to_equal_tables(spark, task2_root):
    for job, table, read in ((jobs.reload_loan_holiday, "loan_holiday_info", 2), (jobs.reload_balance_turnover, "account_balance_turnover", 4)):
        first = job(spark, task2_root)
        rows = _rows(spark, f"{task2_root}/dm/{table}")
        again = job(spark, task2_root)
        assert _rows(spark, f"{task2_root}/dm/{table}") == rows
        assert (first.rows_read, first.rows_loaded) == (again.rows_read, again.rows_loaded) == (read, len(rows))
    mart = spark.read.parquet(f"{task2_root}/dm/loan_holiday_info")
    assert mart.dtypes == [(n, t) for n, t, _ in task2.LOAN_HOLIDAY_COLUMNS]
    assert {r.account_rk: r.currency_name for r in spark.read.parquet(f"{task2_root}/dm/account_balance_turnover").collect()} == {1: "USD", 2: "-1"}


def test_loan_holiday_info_of_many_products_and_dates_equals_the_plain_joins(spark):
    """Products without a broadcast of their months, a hot one, holidays and deals that repeat or lack a key."""
    day = F.date_add(F.lit(D(1992, 1, 1)), (F.col("id") * 31 % 2500).cast("int"))
    deal = spark.range(7_000).select(F.when(F.col("id") % 50 > 0, F.col("id") % 6_900).alias("deal_rk"), day.alias("effective_from_date"), F.lit(D(2999, 12, 31)).alias("effective_to_date"),
                                     F.when(F.col("id") % 11 > 0, F.when(F.col("id") % 7 == 0, 5).otherwise(F.col("id"))).alias("product_rk"))
    holiday = deal.where("deal_rk % 3 = 0").select("deal_rk", "effective_from_date", F.lit(D(2020, 1, 1)).alias("effective_to_date"), F.lit("A").alias("loan_holiday_type_cd"))
    product = spark.range(5_000).select(F.col("id").alias("product_rk"), F.lit("old").alias("product_name"), F.lit(D(1990, 1, 1)).alias("effective_from_date"), F.lit(D(1996, 1, 1)).alias("effective_to_date"))
    product = product.union(product.select("product_rk", F.lit("new"), F.lit(D(1996, 1, 1)), F.when(F.col("product_rk") % 9 > 0, F.lit(D(2999, 12, 31)))))
    out = task2.loan_holiday_info(deal, holiday, product)
    got = sorted(map(tuple, out.select("deal_rk", "effective_from_date", "effective_to_date", "product_rk", "product_name", "loan_holiday_type_cd").collect()), key=str)
    for name, df in (("t_deal", deal), ("t_holiday", holiday), ("t_product", product)):
        df.createOrReplaceTempView(name)
    want = spark.sql("""SELECT d.deal_rk, d.effective_from_date, coalesce(h.effective_to_date, d.effective_to_date), d.product_rk, product_name, loan_holiday_type_cd
        FROM t_deal d LEFT JOIN t_holiday h ON h.deal_rk = d.deal_rk AND h.effective_from_date = d.effective_from_date
        LEFT JOIN t_product p ON p.product_rk = d.product_rk AND d.effective_from_date BETWEEN p.effective_from_date AND p.effective_to_date""")
    assert got == sorted(map(tuple, want.collect()), key=str)
    assert task2.loan_holiday_rows_read(deal, holiday, product).first()[0] == len(got)
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "SortMergeJoin [product#" in plan  # the planner would broadcast the products, of a size it can only guess


def test_loan_holiday_info_is_joined_in_small_partitions(spark):
    """AQE merges no partitions of the two joins, so that no task sorts a large share of the deals."""
    deal = spark.range(4_000).select(F.col("id").alias("deal_rk"), F.date_add(F.lit(D(1992, 1, 1)), (F.col("id") % 900).cast("int")).alias("effective_from_date"),
                                     F.lit(D(2999, 12, 31)).alias("effective_to_date"), (F.col("id") % 3_000).alias("product_rk"))
    holiday = deal.where("deal_rk % 2 = 0").select("deal_rk", "effective_from_date", F.lit(D(2020, 1, 1)).alias("effective_to_date"))
    product = spark.range(2_000).select(F.col("id").alias("product_rk"), F.lit("a").alias("product_name"), F.lit(D(1990, 1, 1)).alias("effective_from_date"), F.lit(D(2999, 1, 1)).alias("effective_to_date"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("-1", "true", "16")):
            spark.conf.set(k, v)
        by_product = task2.with_versions(deal, "effective_from_date", "product_rk", product.withColumnsRenamed({"effective_from_date": "valid_from", "effective_to_date": "valid_to"}))
        for out in (by_product, task2.loan_holiday_info(deal, holiday, product)):
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 4_000 and len(sizes) == 16 and max(sizes) < 400
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_balance_repair_is_stored_and_counted(spark, task2_root):
    run = jobs.repair_balance(spark, task2_root)
    assert run.rows_loaded == 1       # account 2 has a missing day in between: no error
    path = f"{task2_root}/rd/account_balance"
    opened = {(r.account_rk, r.effective_date.day): r.account_in_sum for r in spark.read.parquet(path).collect()}
    assert opened == {(1, 1): Decimal(0), (1, 2): Decimal(10), (2, 1): None, (2, 3): Decimal(5)}
    assert jobs.repair_balance(spark, task2_root).rows_loaded == 0
    spark.read.parquet(path).limit(1).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="repeated"):
        jobs.repair_balance(spark, task2_root)


def test_client_duplicates_are_deleted_and_kept_apart(spark, task2_root):
    run = jobs.delete_duplicates(spark, task2_root)
    assert (run.rows_read, run.rows_loaded) == (4, 2)
    assert [r[2] for r in _rows(spark, f"{task2_root}/dm/client")] == ["a", "c"]
    assert [r[2] for r in _rows(spark, f"{task2_root}/dm/client_deleted")] == ["b", "b"]
    again = jobs.delete_duplicates(spark, task2_root)
    assert (again.rows_read, again.rows_loaded) == (2, 2)


def test_report_export_and_import_are_stored_and_audited(spark, tmp_path):
    root, out = str(tmp_path / "t"), str(tmp_path / "out")
    types = ["date", "date", "string", "string", "string"] + ["decimal(23,8)"] * 12
    rows = [(D(2024, 1, 1), D(2024, 1, 31), "A", str(30101 + i), "A") + (Decimal(i),) * 12 for i in range(5)]
    rep = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(marts.F101_COLS, types)))
    rep.withColumn("period", F.concat_ws("_", "from_date", "to_date")).write.partitionBy("period").parquet(f"{root}/dm/dm_f101_round_f")
    assert jobs.export_report(spark, root, out).rows_loaded == 5
    for _ in range(2):
        assert jobs.import_report(spark, root, out).rows_loaded == 5
        assert _rows(spark, f"{root}/dm/dm_f101_round_f_v2") == sorted(map(tuple, rep.collect()), key=str)
    with pytest.raises(Exception):
        jobs.import_report(spark, root, str(tmp_path / "none"))
    log = spark.read.parquet(f"{root}/logs/etl_table_log")
    assert log.where("status = 'FAILED'").count() == 1 and log.where("status = 'SUCCESS'").count() == 3
    assert spark.read.parquet(f"{root}/dm/dm_f101_round_f_v2").count() == 5
