import datetime as dt
import random
from decimal import Decimal

from ledgerline.operators import quality
from ledgerline.operators.asof import (
    asof_lookup, asof_lookup_by_row, expand_to_days, latest_version, versions_on,
)

D = dt.date


def test_dedup_split_keeps_first_in_total_order_with_nulls_last(spark):
    rows = [(1, D(2020, 1, 1), None, 5), (1, D(2020, 1, 1), D(2021, 1, 1), 9), (1, D(2020, 1, 1), D(2021, 1, 1), 9),
            (1, D(2020, 1, 1), D(2021, 1, 1), 3), (2, D(2020, 1, 1), None, 1), (2, D(2020, 1, 1), None, 1),
            (2, D(2020, 1, 1), None, 1), (3, D(2020, 1, 1), D(2022, 1, 1), 1), (None, D(2020, 1, 1), None, 1),
            (None, D(2020, 1, 1), None, 2)]
    df = spark.createDataFrame(rows, "k long, f date, t date, n int")
    kept, deleted = quality.dedup_split(df, ["k", "f"])
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(1, D(2020, 1, 1), D(2021, 1, 1), 3), (2, D(2020, 1, 1), None, 1), (3, D(2020, 1, 1), D(2022, 1, 1), 1),
         (None, D(2020, 1, 1), None, 1)], key=str)
    assert sorted(map(tuple, deleted.collect()), key=str) == sorted(
        [(1, D(2020, 1, 1), None, 5), (1, D(2020, 1, 1), D(2021, 1, 1), 9), (1, D(2020, 1, 1), D(2021, 1, 1), 9),
         (2, D(2020, 1, 1), None, 1), (2, D(2020, 1, 1), None, 1), (None, D(2020, 1, 1), None, 2)], key=str)
    assert kept.count() + deleted.count() == df.count()


def test_dedup_split_equals_row_number_on_a_hot_key(spark):
    rnd = random.Random(5)
    rows = [(0 if rnd.random() < 0.4 else rnd.randint(1, 30), rnd.randint(0, 3), rnd.choice([None, 1, 2]))
            for _ in range(600)]
    df = spark.createDataFrame(rows, "k int, a int, b int")
    kept, deleted = quality.dedup_split(df, ["k"])
    df.createOrReplaceTempView("dd")
    ranked = spark.sql("SELECT k, a, b, row_number() OVER (PARTITION BY k ORDER BY a NULLS LAST, b NULLS LAST) rn FROM dd")
    exp_kept = sorted(tuple(r[:3]) for r in ranked.where("rn = 1").collect())
    exp_del = sorted((tuple(r[:3]) for r in ranked.where("rn > 1").collect()), key=str)
    assert sorted(map(tuple, kept.collect())) == exp_kept
    assert sorted(map(tuple, deleted.collect()), key=str) == exp_del


def test_duplicate_keys_and_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (3, "c"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, quality.duplicate_keys(df, ["k"]).collect())) == [(1, 2), (3, 3)]
    assert quality.duplicate_key_count(df, ["k"]).first()[0] == 2
    kv = quality.key_violations({"t": (df, ["k", "v"])}).collect()
    assert sorted((r.key_text, r.rows_count) for r in kv) == [("1|a", 2), ("3|c", 3)]


def test_not_null_and_length_violations(spark):
    df = spark.createDataFrame([(1, None, "abc"), (2, 5, "toolong"), (None, None, None)], "a int, b int, s string")
    nn = {r.a: r.null_columns for r in quality.not_null_violations(df, ["a", "b"]).collect()}
    assert nn == {1: "b", None: "a,b"}
    lv = quality.length_violations(df, {"s": 3}, ["a"]).collect()
    assert [(r.a, r.value, r.value_length) for r in lv] == [(2, "toolong", 7)]


CHAIN = [(1, D(2024, 1, 1), Decimal(0), Decimal(10)), (1, D(2024, 1, 2), Decimal(11), Decimal(20)),
         (1, D(2024, 1, 3), Decimal(20), None), (1, D(2024, 1, 4), Decimal(5), Decimal(5)),
         (1, D(2024, 1, 6), Decimal(99), Decimal(1)),            # gap: no error
         (2, D(2024, 1, 1), None, None), (2, D(2024, 1, 2), None, Decimal(3))]


def test_chain_errors_both_ways_and_repair(spark):
    ch = spark.createDataFrame(CHAIN, "account_rk int, effective_date date, account_in_sum decimal(23,8), "
                                      "account_out_sum decimal(23,8)")
    inn = {(r.account_rk, r.effective_date): (r.wrong_account_in_sum, r.correct_account_in_sum)
           for r in quality.chain_in_errors(ch).collect()}
    assert inn == {(1, D(2024, 1, 2)): (Decimal(11), Decimal(10)), (1, D(2024, 1, 4)): (Decimal(5), None)}
    out = {(r.account_rk, r.effective_date) for r in quality.chain_out_errors(ch).collect()}
    assert out == {(1, D(2024, 1, 1)), (1, D(2024, 1, 3))}
    fixed, fixes = quality.repair_chain(ch)
    assert fixes.count() == 2
    got = {(r.account_rk, r.effective_date): r.account_in_sum for r in fixed.collect()}
    assert got[(1, D(2024, 1, 2))] == Decimal(10) and got[(1, D(2024, 1, 4))] is None
    assert got[(1, D(2024, 1, 6))] == Decimal(99)
    assert quality.chain_mismatch_count(fixed).first()[0] == 0


def test_reconcile_periods_all_labels_and_null_periods(spark):
    s = "effective_from_date date, effective_to_date date, x int"
    stg = spark.createDataFrame([(D(2020, 1, 1), None, 1), (D(2020, 1, 1), None, 2), (D(2021, 1, 1), D(2021, 12, 31), 1),
                                 (D(2022, 1, 1), None, 1)], s)
    rd = spark.createDataFrame([(D(2020, 1, 1), None, 1), (D(2021, 1, 1), D(2021, 12, 31), 1),
                                (D(2023, 1, 1), None, 1)], s)
    got = {(r.effective_from_date, r.problem) for r in quality.reconcile_periods({"t": stg}, {"t": rd}).collect()}
    assert got == {(D(2020, 1, 1), "row_count_differs"), (D(2022, 1, 1), "missing_in_rd"),
                   (D(2023, 1, 1), "extra_in_rd")}


def test_snapshot_diff_null_safe(spark):
    s = "k int, m decimal(10,2), n decimal(10,2)"
    a = spark.createDataFrame([(1, Decimal(1), None), (2, Decimal(2), Decimal(2)), (3, None, None)], s)
    b = spark.createDataFrame([(1, Decimal(1), None), (2, Decimal(2), Decimal(3)), (3, Decimal(0), None)], s)
    got = sorted(r.k for r in quality.snapshot_diff(a, b, ["k"], ["m", "n"]).collect())
    assert got == [2, 3]


# ---------------------------------------------------------------- as-of


VERS = [(1, D(2024, 1, 1), None, "a"), (1, D(2024, 1, 5), D(2024, 1, 7), "b"), (1, D(2024, 1, 10), D(2024, 1, 12), None),
        (2, D(2024, 1, 3), D(2024, 1, 3), "c")]
VS = "k int, data_actual_date date, data_actual_end_date date, v string"


def _brute(d, k):
    c = [r for r in VERS if r[0] == k and r[1] <= d <= (r[2] or D(5999, 12, 31))]
    return max(c, key=lambda r: r[1])[3] if c else "<none>"


def test_expand_to_days_overlap_and_gaps(spark):
    dim = spark.createDataFrame(VERS, VS)
    got = {(r.k, r.on_date): r.v for r in expand_to_days(dim, ["k"], D(2024, 1, 1), D(2024, 1, 14), ["v"]).collect()}
    exp = {}
    for k in (1, 2):
        for i in range(14):
            d = D(2024, 1, 1) + dt.timedelta(days=i)
            if _brute(d, k) != "<none>":
                exp[(k, d)] = _brute(d, k)
    assert got == exp
    assert got[(1, D(2024, 1, 8))] == "a" and got[(1, D(2024, 1, 11))] is None


def test_asof_lookups_const_and_by_row(spark):
    dim = spark.createDataFrame(VERS, VS)
    facts = spark.createDataFrame([(k, D(2024, 1, 1) + dt.timedelta(days=i)) for k in (1, 2, 3) for i in range(14)],
                                  "fk int, d date")
    by_row = {(r.fk, r.d): r.v for r in asof_lookup_by_row(facts, dim, {"fk": "k"}, "d", ["fk", "d"], ["v"]).collect()}
    for (k, d), v in by_row.items():
        exp = _brute(d, k)
        assert v == (None if exp == "<none>" else exp)
    const = {r.fk: r.v for r in asof_lookup(facts.select("fk").distinct(), dim, {"fk": "k"}, D(2024, 1, 6), ["v"]).collect()}
    assert const == {1: "b", 2: None, 3: None}
    lv = {r.k: r.v for r in latest_version(dim, ["k"], "data_actual_date", ["v"]).collect()}
    assert lv == {1: None, 2: "c"}
    assert versions_on(dim, D(2024, 1, 3), ["k"], ["v"]).count() == 2


def test_dedup_postconditions_no_duplicate_keys_left(spark):
    rows = [(k % 7, D(2020, 1, 1), None if k % 3 else D(2021, 1, 1), k % 5) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, f date, t date, n int")
    kept, deleted = quality.dedup_split(df, ["k", "f"])
    assert quality.duplicate_key_count(kept, ["k", "f"]).first()[0] == 0
    assert quality.key_violations({"kept": (kept, ["k", "f"])}).count() == 0
    both = sorted(map(tuple, kept.unionByName(deleted).collect()), key=str)
    assert both == sorted(map(tuple, df.collect()), key=str)


def test_asof_by_row_same_result_broadcast_or_shuffled(spark):
    dim = spark.createDataFrame(VERS, VS)
    facts = spark.createDataFrame([(k, D(2024, 1, 1) + dt.timedelta(days=i)) for k in (1, 2, 3) for i in range(14)],
                                  "fk int, d date")
    from pyspark.sql import functions as F
    small = asof_lookup_by_row(facts, F.broadcast(dim), {"fk": "k"}, "d", ["fk", "d"], ["v"]).collect()
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        big = asof_lookup_by_row(facts, dim, {"fk": "k"}, "d", ["fk", "d"], ["v"]).collect()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert sorted(map(tuple, small), key=str) == sorted(map(tuple, big), key=str)
