"""Physical-plan shape: the properties the operators rely on at scale."""

import datetime as dt
import re
from decimal import Decimal

from ledgerline.operators import quality
from ledgerline.plans import marts
from ledgerline.sources.ingest import keep_last

D = dt.date


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _postings(spark):
    return spark.createDataFrame([(D(2024, 1, 1), 1, 2, Decimal(1), Decimal(1))],
                                 "oper_date date, credit_account_rk long, debet_account_rk long, "
                                 "credit_amount decimal(23,8), debet_amount decimal(23,8)")


def test_turnover_pre_aggregates_before_its_only_shuffle(spark):
    p = _plan(marts.daily_turnover(_postings(spark), D(2024, 1, 1), D(2024, 1, 31)))
    assert p.count("Exchange hashpartitioning") == 1
    # the partial aggregate sits below the exchange: a hot account is folded per map task
    assert p.index("partial_sum") > p.index("Exchange hashpartitioning")
    assert "PythonUDF" not in p and "BatchEvalPython" not in p


def test_balance_range_shuffles_the_big_side_once(spark):
    acc = spark.createDataFrame([(D(2024, 1, 1), None, 1, "А")],
                                "data_actual_date date, data_actual_end_date date, account_rk long, char_type string")
    t = spark.createDataFrame([(D(2024, 1, 1), 1, Decimal(1), Decimal(1), Decimal(1), Decimal(1))],
                              "on_date date, account_rk long, credit_amount decimal(23,8), credit_amount_rub decimal(23,8),"
                              " debet_amount decimal(23,8), debet_amount_rub decimal(23,8)")
    op = spark.createDataFrame([(D(2023, 12, 31), 1, Decimal(1), Decimal(1))],
                               "on_date date, account_rk long, balance_out decimal(23,8), balance_out_rub decimal(23,8)")
    p = _plan(marts.account_balance(t, acc, op, D(2024, 1, 1), D(2024, 1, 31)))
    # one exchange for versions + turnover (by account); the only other one is the opening rows'
    exchanges = re.findall(r"Exchange hashpartitioning\(([^,]+)", p)
    # (a fixed partition count: AQE cannot size it, the work grows after the day expansion)
    assert len(exchanges) <= 2 and p.count("REPARTITION_BY_NUM") == 1
    assert "Union" in p.split("REPARTITION_BY_NUM")[1].split("\n")[1]
    # the per-day aggregate has fixed-width buffers: hash, not sort, aggregation
    assert "SortAggregate" not in p
    # both window steps reuse one sort
    assert p.count("Sort [account_rk") == 1


def test_dedup_and_keep_last_use_aggregates_not_windows(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k int, a int, b int")
    kept, deleted = quality.dedup_split(df, ["k"])
    for x in (kept, deleted, keep_last(df, ["k"], "a")):
        p = _plan(x)
        assert "Window" not in p
        assert "partial_" in p


def _jobs_started(spark, group, build) -> int:
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_mart_starts_no_job(spark):
    acc = spark.createDataFrame([(D(2024, 1, 1), None, 1, 5)],
                                "data_actual_date date, data_actual_end_date date, account_rk long, currency_rk long")
    rt = spark.createDataFrame([(D(2024, 1, 1), None, 5, Decimal(2))],
                               "data_actual_date date, data_actual_end_date date, currency_rk long, "
                               "reduced_cource decimal(23,8)")
    post = _postings(spark)
    assert _jobs_started(spark, "turnover", lambda: marts.account_turnover(post, acc, rt, D(2024, 1, 1), D(2024, 1, 31))) == 0
    assert _jobs_started(spark, "one", lambda: post.count()) > 0   # the probe sees jobs


def test_no_mart_forces_a_broadcast(spark):
    """With automatic broadcasts off nothing is broadcast: no hint overrides the planner."""
    acc = spark.createDataFrame([(D(2024, 1, 1), None, 1, 5)],
                                "data_actual_date date, data_actual_end_date date, account_rk long, currency_rk long")
    rt = spark.createDataFrame([(D(2024, 1, 1), None, 5, Decimal(2))],
                               "data_actual_date date, data_actual_end_date date, currency_rk long, "
                               "reduced_cource decimal(23,8)")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(marts.account_turnover(_postings(spark), acc, rt, D(2024, 1, 1), D(2024, 1, 31)))
        assert "Broadcast" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_kept_is_one_exchange_without_a_join(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k int, a int, b int")
    kept, deleted = quality.dedup_split(df, ["k"])
    p = _plan(kept)
    assert p.count("Exchange hashpartitioning") == 1 and "Join" not in p
    assert "Join" not in _plan(deleted)


def test_chain_repair_is_one_shuffle_without_join(spark):
    ch = spark.createDataFrame([(1, D(2024, 1, 1), Decimal(0), Decimal(1))],
                               "account_rk int, effective_date date, account_in_sum decimal(23,8), "
                               "account_out_sum decimal(23,8)")
    fixed, _ = quality.repair_chain(ch)
    p = _plan(fixed)
    assert p.count("Exchange hashpartitioning") == 1 and "Join" not in p


def test_turnover_range_shuffles_the_postings_once(spark, tmp_path):
    acc = spark.createDataFrame([(D(2024, 1, 1), None, 1, 5)],
                                "data_actual_date date, data_actual_end_date date, account_rk long, currency_rk long")
    rt = spark.createDataFrame([(D(2024, 1, 1), None, 5, Decimal(2))],
                               "data_actual_date date, data_actual_end_date date, currency_rk long, "
                               "reduced_cource decimal(23,8)")
    for name, df in (("acc", acc), ("rt", rt)):   # stored tables have a size that the planner knows
        df.write.parquet(str(tmp_path / name))
    acc, rt = (spark.read.parquet(str(tmp_path / n)) for n in ("acc", "rt"))
    p = _plan(marts.account_turnover(_postings(spark), acc, rt, D(2024, 1, 1), D(2024, 1, 31)))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert len([k for k in keys if "on_date" in k and "account_rk" in k]) == 1   # the postings aggregate
    by_account = [k for k in keys if k.startswith("account_rk")]
    assert len(by_account) == 2     # account versions; then daily rows and version segments together
    assert "BroadcastNestedLoopJoin" not in p and "data_actual_date" not in re.sub(r"\(\d+\) Scan.*", "", p.split("Join")[-1][:200])
