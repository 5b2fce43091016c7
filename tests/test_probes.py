"""Inputs that earlier fixtures did not hold: inverted validity, large rates, NULL keys, ties, failing moves."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.money import to_rub
from ledgerline.operators import write
from ledgerline.operators.asof import expand_to_days
from ledgerline.operators.quality import dedup_split


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_rate_beyond_a_million_is_exact(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(Decimal("2"), Decimal("2500000.5")), (Decimal("-3.33333333"), Decimal("1234567.12345678")), (Decimal("7"), None), (None, Decimal("5"))]
        got = [r[0] for r in spark.createDataFrame(rows, "a decimal(23,8), r decimal(23,8)").select(to_rub("a", "r")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    want = [(a * (Decimal(1) if r is None else r)).quantize(Decimal("1e-8"), rounding="ROUND_HALF_UP") if a is not None else None for a, r in rows]
    assert got == want


def test_an_inverted_validity_covers_no_day(spark):
    day = dt.date
    dim = spark.createDataFrame([(1, day(2024, 1, 20), day(2024, 1, 10), 5), (2, day(2024, 1, 3), day(2024, 1, 4), 6)],
                                "k int, data_actual_date date, data_actual_end_date date, v int")
    out = expand_to_days(dim, ["k"], day(2024, 1, 1), day(2024, 1, 31), ["v"]).collect()
    assert {(r.k, r.on_date.day) for r in out} == {(2, 3), (2, 4)}


def test_refresh_keeps_rows_whose_match_column_is_null(spark):
    old = spark.createDataFrame([(None, 1), (dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 2), 3)], "d date, v int")
    new = spark.createDataFrame([(dt.date(2024, 1, 1), 9)], "d date, v int")
    assert sorted(r.v for r in write.refresh_by(old, new, {"d": dt.date(2024, 1, 1)}).collect()) == [1, 3, 9]


def test_ties_in_a_given_order_keep_one_row(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c")] + [(2, 1, "x")] * 25_000, "k int, o int, v string")
    kept, deleted = dedup_split(df, ["k"], ["o"])
    assert sorted(map(tuple, kept.collect())) == [(1, 1, "a"), (2, 1, "x")]
    assert {(r.k, r["count"]) for r in deleted.groupBy("k").count().collect()} == {(1, 2), (2, 24_999)}


def test_a_failed_move_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write.write_table(spark.range(3), path)
    real, calls = write._move, []

    def failing(fs, source, target):
        calls.append(source)
        if len(calls) == 2:  # the new folder's move into place
            raise OSError("no")
        return real(fs, source, target)

    monkeypatch.setattr(write, "_move", failing)
    with pytest.raises(OSError):
        write.write_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    monkeypatch.undo()
    write.write_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9 and sorted(os.listdir(tmp_path))[-1] == "t"


def test_the_last_row_of_the_last_file_wins(spark, tmp_path):
    from ledgerline.sources.ingest import load_table
    from ledgerline.sources.specs import TABLES
    spec = next(s for s in (TABLES.values() if isinstance(TABLES, dict) else TABLES) if s.mode == "upsert" and len(s.keys) >= 1)
    names = [c for c, _ in spec.columns]

    def line(mark, k):
        return ";".join("2018-01-01" if "date" in c else str(k) if c in spec.keys else mark for c in names)
    (tmp_path / "a.csv").write_text("\n".join([";".join(names)] + [line("1", k) for k in range(500)]))
    (tmp_path / "b.csv").write_text("\n".join([";".join(names), line("2", 7)]))
    table = load_table(spark, spec, str(tmp_path)).table
    key = [c for c in spec.keys if "date" not in c][0]
    value = next(c for c in names if c not in spec.keys and "date" not in c)
    row = table.where(F.col(key).cast("string").isin("7", "7.0")).select(F.col(value).cast("double")).collect()
    assert len(row) == 1 and (row[0][0] is None or row[0][0] == 2.0)
