"""The duplicate sketch: equal results at any size, and a tenth of the shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality, sketch


@pytest.mark.parametrize("bits", [2, 9, 21, sketch.BITS])
def test_repeated_keys_equal_the_plain_count(spark, bits):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 7, rnd.randint(0, 10**6)]), rnd.choice([None, "a", "b"]), i) for i in range(3000)] + [(7, "a", 0)] * 2000
    df = spark.createDataFrame(rows, "k long, c string, v int").repartition(5)
    got = sketch.repeated_keys(df, ["k", "c"], bits).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, quality.duplicate_keys(df, ["k", "c"]).collect()), key=str)


def test_rows_without_repeats_and_empty_tables(spark):
    df = spark.range(5000)
    assert sketch.repeated_keys(df, ["id"]).count() == 0 and sketch.maybe_repeated(df.limit(0), ["id"]).count() == 0
    assert sketch.maybe_repeated(df.union(spark.range(3)), ["id"]).count() >= 6


def _shuffled(spark, df):
    """Bytes that the exchanges of a plan wrote."""
    df.collect()
    seen, total = set(), 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        m = node.metrics()
        if name == "ShuffleExchangeExec" and node.id() not in seen:
            seen.add(node.id())
            total += m.apply("shuffleBytesWritten").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


def _account(c):
    """Twenty digits, as the detail tables' keys have."""
    return (F.pmod(F.xxhash64(c), F.lit(9 * 10**9)).cast("decimal(20,0)") * F.lit(10**10).cast("decimal(12,0)") + F.pmod(F.xxhash64(c, F.lit(1)), F.lit(10**10))).cast("decimal(20,0)")


def test_shuffle_is_under_a_tenth_with_one_percent_of_duplicates(spark, tmp_path):
    n = 2_000_000   # a million rows a map task, as a scan of a large table has
    keys = F.struct(_account(F.col("id")).alias("account_rk"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("d"))
    rows = spark.range(0, n, 1, 2).select(keys.alias("k")).select("k.*", F.lit("x" * 20).alias("v"))
    rows.union(rows.where(F.col("account_rk") % 100 == 0)).coalesce(2).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plain = quality.duplicate_keys(df, ["account_rk", "d"])
    before = _shuffled(spark, plain)
    sent = sketch.seen_twice(df, ["account_rk", "d"])
    after = _shuffled(spark, sent) + _shuffled(spark, sketch.repeated_keys(df, ["account_rk", "d"]))
    assert sketch.repeated_keys(df, ["account_rk", "d"]).count() == plain.count() > n // 110
    assert 0 < after * 10 < before
