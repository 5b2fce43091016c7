"""As-of by merge, interval-bin join, duplicate sketch, digest diff: results, hot keys and plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality
from ledgerline.operators.asof import asof_lookup_by_row, version_segments
from ledgerline.plans import task2

D = dt.date
DAY0 = D(2020, 1, 1)


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def day(n):
    return DAY0 + dt.timedelta(days=n)


def test_segments_equal_the_latest_effective_version_on_every_day(spark):
    rnd = random.Random(8)
    for _ in range(6):
        versions = {}
        for k in range(12):
            for f in rnd.sample(range(60), rnd.randint(0, 9)):
                versions[k, f] = rnd.choice([None, f - 2, f, f + rnd.randint(0, 40), f + 3])
        rows = [(k, day(f), None if t is None else day(t), f"{k}-{f}") for (k, f), t in versions.items()]
        rows += [(None, day(0), None, "no key"), (1, None, None, "no start")]
        dim = spark.createDataFrame(rows, "k long, data_actual_date date, data_actual_end_date date, v string")
        facts = spark.createDataFrame([(k, day(n), n) for k in range(13) for n in range(-2, 110)] + [(None, day(3), 1), (2, None, 2)],
                                      "fk long, d date, n int")
        got = {(r.fk, r.d): r.v for r in asof_lookup_by_row(facts, dim, {"fk": "k"}, "d", ["fk", "d"], ["v"]).collect()}
        assert len(got) == facts.count()
        for (k, d), v in got.items():
            ok = [f for (kk, f), t in versions.items() if kk == k and d is not None and day(f) <= d and (t is None or d <= day(t))]
            assert v == (f"{k}-{max(ok)}" if ok else None), (k, d)


def test_asof_by_row_keeps_repeated_facts_and_null_values(spark):
    dim = spark.createDataFrame([(1, day(0), None, None, 5), (1, day(5), day(6), 7, None)],
                                "k int, data_actual_date date, data_actual_end_date date, a int, b int")
    facts = spark.createDataFrame([(1, day(5)), (1, day(5)), (1, day(9)), (9, day(1))], "fk long, d date")
    got = sorted(map(tuple, asof_lookup_by_row(facts, dim, {"fk": "k"}, "d", ["fk", "d"], ["a", "b"]).collect()), key=str)
    assert got == sorted([(1, day(5), 7, None), (1, day(5), 7, None), (1, day(9), None, 5), (9, day(1), None, None)], key=str)


def test_asof_by_row_meets_a_hot_key_in_one_exchange_without_a_join(spark):
    """10,000 versions and 100,000 facts of one key."""
    dim = spark.range(10_000).select(F.lit(1).cast("long").alias("k"), F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("data_actual_date"),
                                     F.when(F.col("id") % 3 > 0, F.date_add(F.lit(DAY0), (F.col("id") + F.col("id") % 50).cast("int"))).alias("data_actual_end_date"),
                                     F.col("id").alias("v"))
    facts = spark.range(100_000).select(F.lit(1).cast("long").alias("fk"), F.date_add(F.lit(DAY0), (F.col("id") % 10_100).cast("int")).alias("d"), "id")
    out = asof_lookup_by_row(facts, dim, {"fk": "k"}, "d", ["id"], ["v"])
    p = plan(out).split("== Physical Plan ==")[-1]
    assert "Join" not in p and p.count("\n(") and "BETWEEN" not in p
    # the last version that started by then; no earlier one outlives it beyond an open one, which never ends
    got = out.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") == F.least(F.datediff("d", F.lit(DAY0)), F.lit(9999))).alias("same")).first()
    assert got.n == 100_000
    assert got.same == facts.where(F.datediff("d", F.lit(DAY0)) <= 9_999).count() + facts.where(F.datediff("d", F.lit(DAY0)) > 9_999).count()


def test_version_segments_are_disjoint_and_one_exchange(spark):
    dim = spark.createDataFrame([(1, day(0), None, 1), (1, day(2), day(3), 2), (1, day(3), day(8), 3)],
                                "k int, data_actual_date date, data_actual_end_date date, v int")
    seg = version_segments(dim, ["k"], ["v"])
    got = [(r.seg_start, r.seg and r.seg.v) for r in seg.orderBy("seg_start").collect()]
    assert got == [(day(0), 1), (day(2), 2), (day(3), 3), (day(9), 1), (D(6000, 1, 1), None)]
    assert plan(seg).count("Exchange hashpartitioning") <= 2  # initial and final plan text


def test_interval_bins_equal_the_range_join(spark):
    rnd = random.Random(4)
    facts = spark.createDataFrame([(i, rnd.choice([1, 1, 1, 2, 3, None]), day(rnd.randint(0, 900)) if i % 17 else None) for i in range(800)],
                                  "id int, key int, d date")
    rows = [(k, day(f), day(f + rnd.randint(-3, 200))) for k in (1, 2, 2, 4) for f in range(0, 900, 45)]
    rows += [(1, day(5), None), (2, D(1900, 1, 1), D(5999, 12, 31)), (3, None, day(4)), (None, day(0), day(9))]
    versions = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "key int, valid_from date, valid_to date, v int")
    got = task2.with_versions(facts, "d", "key", versions).select("id", "v").collect()
    want = facts.alias("f").join(versions.alias("p"), (F.col("f.key") == F.col("p.key")) & F.col("f.d").between(F.col("p.valid_from"), F.col("p.valid_to")),
                                 "left").select("id", "v").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    empty = task2.with_versions(facts.limit(0), "d", "key", versions)
    assert empty.count() == 0 and task2.with_versions(facts, "d", "key", versions.limit(0)).count() == 800


def test_a_hot_product_is_spread_over_months(spark):
    """Half of all facts on one key, joined without a broadcast."""
    facts = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("key"),
                                       F.date_add(F.lit(DAY0), (F.col("id") % 700).cast("int")).alias("d"))
    versions = spark.createDataFrame([(k, day(100 * j), day(100 * j + 100), j) for k in range(50) for j in range(8)], "key int, valid_from date, valid_to date, v int")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("-1", "false", "16")):
            spark.conf.set(k, v)
        out = task2.with_versions(facts, "d", "key", versions)
        assert "hashpartitioning(key" in plan(out) and "_month" in plan(out)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.3 * sum(sizes) and len(sizes) > 8
        shared = facts.where((F.datediff("d", F.lit(DAY0)) % 100 == 0) & (F.datediff("d", F.lit(DAY0)) > 0)).count()
        assert out.count() == 20_000 + shared  # the boundary days come twice
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def generated(df):
    """Rows out of the explode steps of a frame that was collected."""
    def walk(node):
        children = node.children()
        own = node.metrics().apply("numOutputRows").value() if node.nodeName() == "Generate" else 0
        return own + sum(walk(children.apply(i)) for i in range(children.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_versions_of_many_keys_do_not_grow_with_the_months_they_cover(spark):
    """6,000 keys of one fact each, one hot key, facts without a key or a day; versions that cover ten years."""
    far = F.date_add(F.lit(DAY0), (F.col("id") * 7919 % 3650).cast("int"))
    facts = (spark.range(6_000).select("id", F.col("id").cast("int").alias("key"), far.alias("d"))
             .union(spark.range(6_000, 7_000).select("id", F.lit(3).cast("int"), far))
             .union(spark.createDataFrame([(9_000, None, day(3)), (9_001, 3, None), (9_002, 8, None), (9_003, 10_000, day(5))], "id long, key int, d date")))
    versions = spark.range(6_000).select(F.col("id").cast("int").alias("key"), F.lit(DAY0).alias("valid_from"),
                                         F.when(F.col("id") % 5 > 0, F.lit(day(2_000))).otherwise(F.lit(None)).alias("valid_to"), F.lit("a").alias("v"))
    versions = versions.union(spark.range(6_000).select(F.col("id").cast("int"), F.lit(day(2_000)), F.lit(D(2999, 12, 31)), F.lit("b")))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = task2.with_versions(facts, "d", "key", versions).select("id", "v")
        got = sorted(map(tuple, out.collect()), key=str)
        assert generated(out) < 11_000 + 200  # 10,800 versions with an end; the hot key's two stand in about 121 months
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    want = facts.alias("f").join(versions.alias("p"), (F.col("f.key") == F.col("p.key")) & F.col("f.d").between(F.col("p.valid_from"), F.col("p.valid_to")),
                                 "left").select("id", "v").collect()
    assert got == sorted(map(tuple, want), key=str)
    assert "SortMergeJoin" in plan(out)


@pytest.mark.parametrize("ranges", [1, 7, quality.DIFF_RANGES])
def test_digest_diff_equals_the_row_join(spark, ranges):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([None, "a", "b"]), rnd.choice([None, 1, 2]), rnd.choice([None, 1])) for i in range(200)]
    a = spark.createDataFrame(rows, "k int, c string, m int, n int")
    b = spark.createDataFrame([(k, c, rnd.choice([m, m, m, 5]), n) if k % 3 else (k, c, n, m) for k, c, m, n in rows[:150]] + [(999, "z", 1, 1)], "k int, c string, m long, n int")
    got = quality.snapshot_diff(a, b, ["k", "c"], ["m", "n"], ranges).collect()
    want = [(x[0], x[1], x[2], y[2], x[3], y[3]) for x in map(tuple, a.collect()) for y in map(tuple, b.collect())
            if x[:2] == y[:2] and x[1] is not None and x[2:] != y[2:]]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_equal_snapshots_shuffle_digests_only(spark, tmp_path):
    rows = spark.range(50_000).select("id", (F.col("id") * 7).alias("m"))
    rows.write.parquet(str(tmp_path / "a"))
    rows.repartition(3).write.parquet(str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / x)) for x in "ab")
    out = quality.snapshot_diff(a, b, ["id"], ["m"], 64)
    digests = quality.range_digests(a, ["id"], ["m"], 64).join(quality.range_digests(b, ["id"], ["m"], 64), ["_range", "_rows", "_digest"])
    assert digests.count() == 64 and out.collect() == []
    assert "LeftSemi" in plan(out)
