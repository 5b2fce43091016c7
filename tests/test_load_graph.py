"""Tables loaded at once by their dependencies, and an audit log of few files."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import audit, jobs
from ledgerline.sources.specs import LOAD_AFTER, LOAD_ORDER, TABLES
from tests.test_jobs import FILES, _write


def _tables(spark, root):
    return {t: sorted(map(repr, spark.read.parquet(f"{root}/ds/{t}").collect())) for t in FILES}


def test_declared_order_respects_the_graph():
    assert all(LOAD_ORDER.index(n) < LOAD_ORDER.index(t) for t, needs in LOAD_AFTER.items() for n in needs)


def test_parallel_load_equals_the_serial_one(spark, tmp_path):
    files = {n: _write(tmp_path, n, t) for n, t in FILES.items()}
    runs = {k: jobs.load_all(spark, files, str(tmp_path / f"t{k}"), at_once=k) for k in (1, 4)}
    assert _tables(spark, str(tmp_path / "t1")) == _tables(spark, str(tmp_path / "t4"))
    assert (runs[1].rows_read, runs[1].rows_loaded) == (runs[4].rows_read, runs[4].rows_loaded)


def test_a_failed_table_stops_its_dependants_only(spark, tmp_path):
    files = {n: _write(tmp_path, n, t) for n, t in FILES.items()}
    files["md_ledger_account_s"] = _write(tmp_path, "bad", FILES["md_ledger_account_s"].replace("2008-01-01", "2008-99-01"))
    root = str(tmp_path / "t")
    with pytest.raises(ValueError, match="invalid date"):
        jobs.load_all(spark, files, root, at_once=3)
    state = {r.table_name: r for r in audit.current_state(spark.read.parquet(f"{root}/logs/etl_table_log"), cols=("status", "error_message")).collect()}
    ok = {t for t, r in state.items() if r.status == "SUCCESS"}
    assert ok == {"ds.md_currency_d", "ds.md_exchange_rate_d"} and len(state) == 6
    assert "md_ledger_account_s failed" in state["ds.md_account_d"].error_message
    assert "md_account_d failed" in state["ds.ft_posting_f"].error_message
    assert not os.path.exists(f"{root}/ds/ft_posting_f")
    assert spark.read.parquet(f"{root}/logs/etl_run_log").where("status = 'FAILED'").count() == 1


def test_a_slow_table_does_not_hold_up_the_others(spark):
    ended, started = {}, {}

    def work(name, at):
        started[name] = time.time()
        time.sleep(1.0 if name == "slow" else 0.05)
        spark.range(10).count()
        ended[name] = time.time()

    jobs._in_graph(spark, ["slow", "a", "b", "after_slow"], {"b": ("a",), "after_slow": ("slow",)}, work, lambda *_: None, 2, "g")
    assert ended["b"] < ended["slow"] <= started["after_slow"] and started["b"] >= ended["a"]


def test_events_make_few_files_and_compact_to_the_same_state(spark, tmp_path):
    root = str(tmp_path / "t")
    files = {n: _write(tmp_path, n, t) for n, t in FILES.items()}
    jobs.load_all(spark, files, root)
    with pytest.raises(ValueError):
        jobs.load_all(spark, {"ft_balance_f": _write(tmp_path, "b", "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n2017-13-45;1;1;1\n")}, root)
    log = f"{root}/logs/etl_table_log"

    def parts():
        return [f for f in os.listdir(log) if f.startswith("part-")]
    assert len(parts()) <= 7       # one per ended table
    state = lambda: sorted(map(tuple, audit.current_state(spark.read.parquet(log)).collect()))
    totals = lambda: sorted(map(tuple, audit.run_totals(spark.read.parquet(log)).collect()))
    before = state(), totals()
    jobs.compact_audit(spark, root)
    assert (state(), totals()) == before and len(parts()) == 1
    jobs.load_all(spark, files, root)     # the log goes on
    assert len(state()) == len(before[0]) + 6 and {r.status for r in spark.read.parquet(f"{root}/logs/etl_run_log").collect()} >= {"SUCCESS", "FAILED"}
