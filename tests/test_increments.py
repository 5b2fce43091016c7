"""Work in proportion to the change: late postings, key buckets, deleted rows per run; malformed lines, safe export, top-n patch."""

import datetime as dt
import os
import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import write
from ledgerline.plans import jobs, marts, report
from ledgerline.sources import ingest
from ledgerline.sources.specs import TABLES

D = dt.date
LO, HI = D(2018, 1, 1), D(2018, 1, 31)
POSTING = "oper_date date, credit_account_rk decimal(20,0), debet_account_rk decimal(20,0), credit_amount decimal(23,8), debet_amount decimal(23,8)"


def _tables(spark, root, postings):
    rnd = random.Random(3)
    acc = []
    for a in range(30):
        for f, t in ((1, 9), (10, 12), (15, None)) if a % 3 else ((1, None), (5, 20)):   # gaps, and a version within another
            acc.append((D(2018, 1, f), t and D(2018, 1, t), Decimal(a), Decimal("3010184000000000000" + str(a % 10)), rnd.choice("АП"),
                        Decimal(50 if a % 2 else 34), "840"))
    accounts = spark.createDataFrame(acc, TABLES["md_account_d"].schema())
    rates = spark.createDataFrame([(D(2017, 12, 1), D(2018, 1, 14), Decimal(50), Decimal("60.51234567"), "840"),
                                   (D(2018, 1, 15), None, Decimal(50), Decimal("61.25"), "840")], TABLES["md_exchange_rate_d"].schema())
    ledgers = spark.createDataFrame([("А", "c", 1, "s", "ss", 301, "n", 30101, "n", "А", D(2008, 1, 1), None)], TABLES["md_ledger_account_s"].schema())
    seed = spark.createDataFrame([(D(2017, 12, 31), Decimal(a), Decimal(50), Decimal("100.5")) for a in range(0, 30, 2)], TABLES["ft_balance_f"].schema())
    for name, df, part in (("md_account_d", accounts, ()), ("md_exchange_rate_d", rates, ()), ("md_ledger_account_s", ledgers, ()),
                           ("ft_balance_f", seed, ["on_date"]), ("ft_posting_f", postings, ["oper_date"])):
        write.write_table(df, f"{root}/ds/{name}", part)
    jobs.run_month(spark, root, D(2018, 2, 1))


def _stored(spark, root, table, cols):
    return sorted(map(tuple, spark.read.parquet(f"{root}/dm/{table}").select(*cols).collect()))


def test_late_postings_equal_a_full_recompute(spark, tmp_path):
    rnd = random.Random(7)
    row = lambda: (D(2018, 1, rnd.randint(1, 31)), *[rnd.choice([None, Decimal(rnd.randint(0, 32))]) for _ in "cd"],
                   *[rnd.choice([None, Decimal(rnd.randint(1, 10**6)) / 10**4]) for _ in "cd"])
    early = spark.createDataFrame([row() for _ in range(150)], POSTING)
    late = spark.createDataFrame([(D(2018, 1, rnd.choice((8, 11, 13, 22))), *row()[1:]) for _ in range(12)], POSTING)
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    _tables(spark, inc, early)
    before = {f: os.stat(f).st_mtime_ns for d in range(1, 8) for f in _files(f"{inc}/dm/dm_account_balance_f/on_date=2018-01-0{d}")}
    jobs.post_late(spark, inc, late, LO, HI)
    _tables(spark, full, early.unionByName(late))
    for table, cols in (("dm_account_turnover_f", marts.TURNOVER_COLS), ("dm_account_balance_f", marts.BALANCE_COLS)):
        assert _stored(spark, inc, table, cols) == _stored(spark, full, table, cols)
    assert before and all(os.stat(f).st_mtime_ns == t for f, t in before.items())   # days before the first late one
    touched = {x for r in late.collect() for x in r[1:3] if x is not None}
    change = marts.late_turnover(spark.read.parquet(f"{full}/dm/dm_account_turnover_f"), late,
                                 *[spark.read.parquet(f"{full}/ds/{t}") for t in ("md_account_d", "md_exchange_rate_d")], LO, HI)[1]
    moved = marts.late_balance(spark.read.parquet(f"{full}/dm/dm_account_balance_f"), change, spark.read.parquet(f"{full}/ds/md_account_d"), D(2018, 1, 8), HI)
    assert {r.account_rk for r in moved.select("account_rk").distinct().collect()} <= touched
    with pytest.raises(ValueError, match="outside"):
        jobs.post_late(spark, inc, spark.createDataFrame([(D(2018, 2, 1), None, None, None, None)], POSTING), LO, HI)


def _files(folder):
    return [os.path.join(folder, f) for f in os.listdir(folder) if f.startswith("part-")] if os.path.isdir(folder) else []


ACCOUNT = "DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;ACCOUNT_RK;ACCOUNT_NUMBER;CHAR_TYPE;CURRENCY_RK;CURRENCY_CODE\n"


def _file(tmp_path, text, name):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_an_upsert_replaces_the_buckets_of_its_keys_only(spark, tmp_path):
    root = str(tmp_path / "t")
    lines = "".join(f"2018-01-01;;{i};1;P;1;643\n" for i in range(200))
    jobs.load_all(spark, {"md_account_d": _file(tmp_path, ACCOUNT + lines, "a.csv")}, root)
    path = f"{root}/ds/md_account_d"
    was = {f: os.stat(f).st_mtime_ns for b in os.listdir(path) if b.startswith("_bucket=") for f in _files(f"{path}/{b}")}
    assert len({os.path.dirname(f) for f in was}) == TABLES["md_account_d"].buckets
    jobs.load_all(spark, {"md_account_d": _file(tmp_path, ACCOUNT + "2018-01-01;;5;1;A;1;643\n2018-01-01;;900;1;A;1;643\n", "b.csv")}, root)
    rows = spark.read.parquet(path)
    assert rows.count() == 201 and [r.char_type for r in rows.where("account_rk = 5").collect()] == ["A"]
    hit = {r[0] for r in rows.where("account_rk in (5, 900)").select(write.BUCKET).collect()}
    for f, t in was.items():
        if int(os.path.basename(os.path.dirname(f)).split("=")[1]) not in hit:
            assert os.stat(f).st_mtime_ns == t
    touched = rows.where(F.col(write.BUCKET).isin(sorted(hit)))
    assert "PartitionFilters: [_bucket" in touched._sc._jvm.PythonSQLUtils.explainString(touched._jdf.queryExecution(), "formatted")
    again = write.with_bucket(rows.drop(write.BUCKET), TABLES["md_account_d"].keys, TABLES["md_account_d"].buckets)
    assert again.exceptAll(rows.select(*again.columns)).count() == 0   # a row is where its key says


def test_malformed_lines_are_counted_kept_apart_and_gated(spark, tmp_path):
    root = str(tmp_path / "t")
    good = "2018-01-01;;4;1;P;1;643\n\"2018-01-02\";;5;1;\"P\";1;\"643\"\n"
    bad = "2018-01-03;;6;1;P;1\n2018-01-04;;7;1;P;1;643;surplus\n2018-99-99;;8\n"
    src = _file(tmp_path, ACCOUNT + good + bad, "a.csv")
    with pytest.raises(ingest.RejectedLoad, match="3 lines with a wrong number of fields"):
        jobs.load_all(spark, {"md_account_d": src}, root)
    ev = spark.read.parquet(f"{root}/logs/etl_table_log").where("status = 'FAILED'").first()
    assert (ev.rows_read, ev.malformed_rows, ev.bad_date_rows) == (5, 3, 0)
    kept = spark.read.parquet(f"{root}/logs/rejected_lines").where(F.col("run_id") == ev.run_id)
    assert sorted(r.line for r in kept.collect()) == sorted(bad.strip().split("\n")) and kept.where("file like '%a.csv'").count() == 3
    lenient = replace(TABLES["md_account_d"], max_malformed=3)
    res = ingest.load_table(spark, lenient, src)
    assert (res.rows_read, res.malformed_rows) == (5, 3) and sorted(r.account_rk for r in res.table.collect()) == [4, 5]
    quoted = _file(tmp_path, "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT;NOTE\n2018-01-01;1;1;1;\"a;b\"\n2018-01-01;2;1;1;a;b\n", "q.csv")
    assert ingest.load_table(spark, replace(TABLES["ft_balance_f"], max_malformed=1), quoted).malformed_rows == 1   # in a column that is not loaded


def test_a_second_delete_leaves_the_rows_of_the_first(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "client_rk long, effective_from_date date, name string"
    rows = [(1, D(2020, 1, 1), "a"), (1, D(2020, 1, 1), "b"), (2, D(2020, 1, 1), "c")] + [(i, D(2020, 1, 1), "x") for i in range(10, 400)]
    write.write_table(spark.createDataFrame(rows, schema), f"{root}/dm/client")
    one, two = jobs.delete_duplicates(spark, root), jobs.delete_duplicates(spark, root)
    gone = spark.read.parquet(f"{root}/dm/client_deleted")
    assert [(r.name, r.run_id) for r in gone.collect()] == [("b", one.run_id)] and (two.rows_read, two.rows_loaded) == (392, 392)
    assert spark.read.parquet(f"{root}/dm/client").count() == 392


def test_a_failed_export_keeps_the_old_one(spark, tmp_path):
    path = str(tmp_path / "out")
    write.export_csv(spark.createDataFrame([(1,), (2,)], "a int"), path, ["a"])
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("string").alias("a"))
    with pytest.raises(Exception):
        write.export_csv(broken, path, ["a"])
    assert sorted(r.a for r in spark.read.option("header", True).csv(path).collect()) == ["1", "2"]
    assert [f for f in os.listdir(tmp_path) if "__new" in f] == []


def test_patch_takes_the_first_rows_without_a_sort_of_all(spark):
    rows = [(2, "b", Decimal(1)), (1, None, Decimal(5)), (1, None, Decimal(5)), (1, None, None), (1, "a", Decimal(7)), (9, "z", Decimal(0))]
    df = spark.createDataFrame(rows, "k int, c string, m decimal(23,8)").repartition(3)
    got = report.patch_nth_rows(df, [("m", Decimal(100)), ("m", Decimal(1000)), ("m", Decimal(5000))], ["k", "c"])
    # in order: (1, NULL, NULL), then the two copies; NULL plus anything stays NULL
    want = [(1, None, None), (1, None, Decimal(1005)), (1, None, Decimal(5005)), (1, "a", Decimal(7)), (2, "b", Decimal(1)), (9, "z", Decimal(0))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    p = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p
    one = report.patch_nth_rows(df, [("m", Decimal(1))], ["k", "c"])
    assert one.count() == 6
    with pytest.raises(RuntimeError, match="not in the report"):
        report.patch_nth_rows(df, [("nope", Decimal(1))], ["k"])


def test_a_failing_second_swap_leaves_all_partitions_as_they_were(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(D(2020, 1, d), d) for d in range(1, 5)], "d date, v int")
    write.write_table(rows, path, ["d"])
    new = rows.where("v < 4").withColumn("v", F.col("v") * 100)
    real, calls = write._move, []

    def failing(fs, source, to):
        calls.append(1)
        if len(calls) == 4:     # old aside, new in, old aside, then the second new one
            raise OSError("no")
        real(fs, source, to)
    monkeypatch.setattr(write, "_move", failing)
    days = [D(2020, 1, d) for d in range(1, 5)]
    with pytest.raises(OSError):
        write.refresh_partitions(new, path, "d", days)
    read = lambda: sorted(r.v for r in spark.read.parquet(path).collect())
    assert read() == [1, 2, 3, 4] and os.listdir(tmp_path) == ["t"]
    monkeypatch.setattr(write, "_move", real)
    write.refresh_partitions(new, path, "d", days)
    assert read() == [100, 200, 300] and os.listdir(tmp_path) == ["t"]


def test_texts_beyond_the_report_table_s_lengths_are_refused(spark):
    ok = spark.createDataFrame([("А", "30101", "А"), (None, None, None)], "chapter string, ledger_account string, characteristic string")
    jobs.require_lengths(ok, "dm_f101_round_f")
    with pytest.raises(ValueError, match="1 texts too long for chapter"):
        jobs.require_lengths(ok.union(spark.createDataFrame([("AB", "30101", "А")], ok.schema)), "dm_f101_round_f")
