"""Ingest, writers, report exchange and audit (file I/O in a pytest temp folder)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import write
from ledgerline.plans import audit, report
from ledgerline.sources import ingest
from ledgerline.sources.specs import TABLES

D = dt.date


def _write_text(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


def test_load_table_upsert_keeps_last_and_counts(spark, tmp_path):
    csv = tmp_path / "bal.csv"
    _write_text(csv, "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT;EXTRA\r\n"
                     "31.12.2017;24656;35;38318.13;x\r\n"
                     "2017-12-31; 24656 ;35;1.5;x\r\n"
                     "31.12.2017;13560;;  ;x\r\n"
                     "31.12.2017;777;44;bad;x")
    target = spark.createDataFrame([(D(2017, 12, 31), Decimal(13560), Decimal(1), Decimal("9.9")),
                                    (D(2017, 12, 30), Decimal(1), Decimal(1), Decimal("1"))],
                                   TABLES["ft_balance_f"].schema())
    res = ingest.load_table(spark, TABLES["ft_balance_f"], str(csv), target)
    assert res.rows_read == 4 and res.bad_date_rows == 0
    got = {(r.on_date, int(r.account_rk)): (r.currency_rk, r.balance_out) for r in res.table.collect()}
    assert got == {(D(2017, 12, 31), 24656): (Decimal(35), Decimal("1.5")),       # later row wins
                   (D(2017, 12, 31), 13560): (None, None),                         # replaced by the file
                   (D(2017, 12, 31), 777): (Decimal(44), None),                    # bad number → NULL
                   (D(2017, 12, 30), 1): (Decimal(1), Decimal(1))}                 # kept


def test_load_table_fails_on_bad_date_and_missing_column(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    _write_text(bad, "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n1.2.2017;1;1;1\n")
    with pytest.raises(ValueError, match="1 rows with invalid date"):
        ingest.load_table(spark, TABLES["ft_balance_f"], str(bad))
    miss = tmp_path / "miss.csv"
    _write_text(miss, "ON_DATE;ACCOUNT_RK\n2017-12-31;1\n")
    with pytest.raises(ValueError, match="lacks 2 columns: balance_out, currency_rk"):
        ingest.load_table(spark, TABLES["ft_balance_f"], str(miss))


def test_truncate_insert_keeps_all_rows(spark, tmp_path):
    csv = tmp_path / "post.csv"
    _write_text(csv, "OPER_DATE;CREDIT_ACCOUNT_RK;DEBET_ACCOUNT_RK;CREDIT_AMOUNT;DEBET_AMOUNT\n"
                     "2018-01-09;1;2;10;10\n2018-01-09;1;2;10;10\n")
    res = ingest.load_table(spark, TABLES["ft_posting_f"], str(csv))
    assert res.table.count() == 2


def test_cp1251_extract_read(spark, tmp_path):
    csv = tmp_path / "deal.csv"
    _write_text(csv, "deal_rk,deal_name\n1,Кредит\n", encoding="cp1251")
    n = ingest.stage_cp1251(spark, str(csv), str(tmp_path / "stg"))
    assert n == 1
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "stg")).collect()] == [("1", "Кредит")]
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") in ("false", None)


def test_writers_upsert_refresh_update(spark):
    s = "on_date date, k int, v int"
    old = spark.createDataFrame([(D(2024, 1, 1), 1, 1), (D(2024, 1, 2), 1, 2), (D(2024, 1, 2), 2, 3)], s)
    new = spark.createDataFrame([(D(2024, 1, 2), 1, 20)], s)
    ref = sorted(map(tuple, write.refresh_by(old, new, {"on_date": D(2024, 1, 2)}).collect()))
    assert ref == [(D(2024, 1, 1), 1, 1), (D(2024, 1, 2), 1, 20)]
    # rerun is idempotent
    again = write.refresh_by(write.refresh_by(old, new, {"on_date": D(2024, 1, 2)}), new, {"on_date": D(2024, 1, 2)})
    assert sorted(map(tuple, again.collect())) == ref
    up = sorted(map(tuple, write.upsert_by_key(old, new, ["on_date", "k"]).collect()))
    assert up == [(D(2024, 1, 1), 1, 1), (D(2024, 1, 2), 1, 20), (D(2024, 1, 2), 2, 3)]
    fixes = spark.createDataFrame([(2, 30)], "k int, v int")
    upd = sorted(map(tuple, write.apply_updates(old, fixes, ["k"], ["v"]).collect()))
    assert upd == [(D(2024, 1, 1), 1, 1), (D(2024, 1, 2), 1, 2), (D(2024, 1, 2), 2, 30)]
    assert write.empty_like(spark, old).schema == old.schema


def test_write_table_swaps_and_partition_refresh_drops_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2)], "on_date date, k int")
    write.write_table(df, path, ["on_date"])
    # replace the table with a query that reads it
    cur = spark.read.parquet(path)
    write.write_table(cur.withColumn("k", F.col("k") * 10), path, ["on_date"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [10, 20]
    write.refresh_partitions(spark.createDataFrame([(7, D(2024, 1, 1))], "k int, on_date date"), path, "on_date",
                             [D(2024, 1, 1), D(2024, 1, 2)])
    got = sorted((r.on_date, r.k) for r in spark.read.parquet(path).collect())
    assert got == [(D(2024, 1, 1), 7)]


def _report(spark):
    rows = []
    for i, led in enumerate(["30102", "30101", "30110", "30109"]):
        rows.append((D(2024, 1, 1), D(2024, 1, 31), "А", led, "А") + tuple(Decimal(i * 12 + j) for j in range(12)))
    from ledgerline.plans.marts import F101_COLS
    types = ["date", "date", "string", "string", "string"] + ["decimal(23,8)"] * 12
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(F101_COLS, types))).repartition(3)


def test_positions_distributed_equal_to_sort_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5)
    got = sorted((r.position, r.x) for r in report.positions(df, ["x"]).collect())
    assert got == [(i + 1, i) for i in range(1000)]


def test_report_round_trip_diff_finds_the_two_patches(spark, tmp_path):
    rep = _report(spark)
    exp_path, mod_path = str(tmp_path / "exp"), str(tmp_path / "mod")
    assert report.export_report(rep, exp_path) == 4
    assert report.modify_report_csv(spark, exp_path, mod_path) == 4
    imported = report.import_report(spark, mod_path, rep.schema)
    diff = report.diff_reports(rep, imported).collect()
    by_led = {r.ledger_account: r for r in diff}
    assert set(by_led) == {"30101", "30102"}       # rows 1 and 2 in key order
    r1 = by_led["30101"]
    assert r1.imported_balance_in_total - r1.source_balance_in_total == Decimal(1000)
    r2 = by_led["30102"]
    assert r2.imported_turn_deb_total - r2.source_turn_deb_total == Decimal(2000)
    # export order is the key order
    assert [r.ledger_account for r in spark.read.option("header", True).csv(exp_path).collect()] == \
        ["30101", "30102", "30109", "30110"]


def test_export_refuses_empty_report(spark, tmp_path):
    with pytest.raises(RuntimeError, match="empty"):
        report.export_report(_report(spark).limit(0), str(tmp_path / "e"))


def test_audit_state_totals_duration(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    ev = [audit.table_event(spark, "r1", "ds.a", "csv:a", "upsert", "STARTED", at=t0),
          audit.table_event(spark, "r1", "ds.a", "csv:a", "upsert", "SUCCESS", 10, 8,
                            at=t0 + dt.timedelta(seconds=1, microseconds=2500)),
          audit.table_event(spark, "r1", "ds.b", "csv:b", "upsert", "FAILED", error="x" * 5000,
                            at=t0 + dt.timedelta(seconds=2)),
          audit.table_event(spark, "r2", "ds.a", "csv:a", "upsert", "STARTED", at=t0 + dt.timedelta(seconds=3))]
    log = ev[0]
    for e in ev[1:]:
        log = log.unionByName(e)
    st = {(r.run_id, r.table_name): r.status for r in audit.current_state(log).collect()}
    assert st == {("r1", "ds.a"): "SUCCESS", ("r1", "ds.b"): "FAILED", ("r2", "ds.a"): "STARTED"}
    tot = {r.run_id: (r.total_rows_read, r.total_rows_loaded) for r in audit.run_totals(log).collect()}
    assert tot == {"r1": (10, 8), "r2": (0, 0)}
    dur = {r.run_id: r.duration_sec for r in audit.run_durations(log).collect()}
    assert dur == {"r1": Decimal("2.000"), "r2": Decimal("0.000")}
    assert [r.run_id for r in audit.latest_run_rows(log).collect()] == ["r2"]
    assert max(len(r.error_message or "") for r in log.collect()) == audit.MAX_MESSAGE
    one = spark.createDataFrame([(t0, t0 + dt.timedelta(microseconds=1500)), (t0, t0 + dt.timedelta(microseconds=1499))],
                                "s timestamp, e timestamp")
    assert [r[0] for r in one.select(audit.duration_sec("s", "e")).collect()] == [Decimal("0.002"), Decimal("0.001")]


def test_cast_tags_like_the_non_ansi_loads(spark):
    vals = [" 12 ", "12.7", "-12.7", "+3.", ".5", "1e3", "x", "", "99999999999"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [tuple(r) for r in df.select(ingest.cast_tag("s", "integer"), ingest.cast_tag("s", "decimal20")).collect()]
    assert [g[0] for g in got] == [12, 12, -12, 3, 0, None, None, None, None]
    assert [g[1] for g in got][:3] == [Decimal(12), Decimal(13), Decimal(-13)]


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write.write_table(spark.createDataFrame([(1,), (2,)], "k int"), path)
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("id"))
                                 .alias("k"))
    with pytest.raises(Exception, match="boom"):
        write.write_table(bad, path)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]
    import os
    assert [n for n in os.listdir(tmp_path) if n != "t"] == []     # no staging folder left behind


def test_jdbc_partitioned_read_needs_bounds(spark):
    from ledgerline.sources import jdbc
    with pytest.raises(ValueError, match="lower, upper and num_partitions"):
        jdbc.read_table(spark, "jdbc:postgresql://db/x", "dm.dm_f101_round_f", {}, partition_column="id")
