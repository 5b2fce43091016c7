import datetime as dt
from decimal import Decimal

from ledgerline.plans.marts import account_turnover
from ledgerline.streaming.daily_refresh import start_turnover_refresh

D = dt.date
POST = ("oper_date date, credit_account_rk long, debet_account_rk long, credit_amount decimal(23,8), "
        "debet_amount decimal(23,8)")


def test_stream_refresh_equals_batch_turnover(spark, tmp_path):
    acc = spark.createDataFrame([(D(2024, 1, 1), None, 1, 7), (D(2024, 1, 1), None, 2, 8)],
                                "data_actual_date date, data_actual_end_date date, account_rk long, currency_rk long")
    rates = spark.createDataFrame([(D(2024, 1, 1), None, 7, Decimal("2.5"))],
                                  "data_actual_date date, data_actual_end_date date, currency_rk long, "
                                  "reduced_cource decimal(23,8)")
    src, tables = tmp_path / "in", tmp_path / "tables"
    first = [(D(2024, 1, 1), 1, 2, Decimal("10"), Decimal("10")), (D(2024, 1, 2), 2, 1, Decimal("5"), None)]
    spark.createDataFrame(first, POST).write.parquet(str(src / "f1"))
    schema = spark.createDataFrame([], POST).schema
    args = (str(src / "*"), schema, str(tables / "postings"), str(tables / "turnover"), acc, rates,
            str(tmp_path / "ckpt"))
    start_turnover_refresh(spark, *args).awaitTermination()
    # a late file adds a posting to an existing day
    late = [(D(2024, 1, 2), 1, None, Decimal("1.25"), None)]
    spark.createDataFrame(late, POST).write.parquet(str(src / "f2"))
    start_turnover_refresh(spark, *args).awaitTermination()

    got = {tuple(r) for r in spark.read.parquet(str(tables / "turnover")).select(
        "on_date", "account_rk", "credit_amount", "credit_amount_rub", "debet_amount", "debet_amount_rub").collect()}
    allp = spark.createDataFrame(first + late, POST)
    exp = {tuple(r) for r in account_turnover(allp, acc, rates, D(2024, 1, 1), D(2024, 1, 2)).collect()}
    assert got == exp
    assert (D(2024, 1, 2), 1, Decimal("1.25"), Decimal("3.125"), Decimal(0), Decimal(0)) in got


def test_replayed_batch_gives_the_same_tables(spark, tmp_path):
    from ledgerline.streaming.daily_refresh import apply_batch
    acc = spark.createDataFrame([(D(2024, 1, 1), None, 1, 7)],
                                "data_actual_date date, data_actual_end_date date, account_rk long, currency_rk long")
    rates = spark.createDataFrame([(D(2024, 1, 1), None, 7, Decimal("2"))],
                                  "data_actual_date date, data_actual_end_date date, currency_rk long, "
                                  "reduced_cource decimal(23,8)")
    batch = spark.createDataFrame([(D(2024, 1, 3), 1, None, Decimal("4"), None)], POST)
    post, turn = str(tmp_path / "p"), str(tmp_path / "t")
    snap = lambda: sorted(map(tuple, spark.read.parquet(turn).select(
        "on_date", "account_rk", "credit_amount", "credit_amount_rub").collect()))
    apply_batch(spark, batch, 0, post, turn, acc, rates)
    first = snap()
    apply_batch(spark, batch, 0, post, turn, acc, rates)          # the retry after a failure
    assert snap() == first == [(D(2024, 1, 3), 1, Decimal("4"), Decimal("8"))]
    assert spark.read.parquet(post).count() == 1
