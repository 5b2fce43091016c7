import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions.dates import (
    DATE_FORMATS, effective_on, month_bounds, overlaps, parse_date_multi, prev_month_bounds,
    prev_month_bounds_col,
)
from ledgerline.functions.money import to_rub
from ledgerline.functions.rules import is_passive, is_rub

D = dt.date


def test_parse_date_multi_formats_and_bad_text(spark):
    vals = ["2017-12-31", " 31.12.2017 ", "30-12-2017", "12/29/2017", "", "  ", None, "2017-13-40",
            "1.2.2017", "2016-02-29", "2017-02-29", "31.12.17"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(parse_date_multi("s")).collect()]
    assert got == [D(2017, 12, 31), D(2017, 12, 31), D(2017, 12, 30), D(2017, 12, 29), None, None, None,
                   None, None, D(2016, 2, 29), None, None]


def test_parse_guard_never_changes_a_result(spark):
    # The pre-checks only skip formats that cannot parse the text.
    vals = ["217-12-31", "2017-1-31", "+2017-12-31", "-2017-12-31", "12017-12-31", "01-02-2017", "1-2-2017",
            "01/02/2017", "2017/12/31", "2017.12.31", "0001-01-01", "99999-12-31", "2017--12-31", "01-1-2017",
            "2017-12-31-", "x", "-", "12/29/17", "2017-12-31 10:00"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    plain = F.coalesce(*[F.try_to_date(F.trim("s"), f) for f in DATE_FORMATS])
    rows = df.select(plain.cast("string").alias("a"), parse_date_multi("s").cast("string").alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_to_rub_rounds_half_away_from_zero_and_defaults_rate(spark):
    df = spark.createDataFrame(
        [(Decimal("0.00000001"), Decimal("0.50000000")), (Decimal("-0.00000001"), Decimal("0.50000000")),
         (Decimal("1234567890123.12345678"), Decimal("99.12345678")), (Decimal("10"), None), (None, Decimal("2"))],
        "a decimal(23,8), r decimal(23,8)")
    got = [r[0] for r in df.select(to_rub("a", "r")).collect()]
    exact = Decimal("1234567890123.12345678") * Decimal("99.12345678")
    assert got[0] == Decimal("0.00000001") and got[1] == Decimal("-0.00000001")
    assert got[2] == exact.quantize(Decimal("0.00000001"), rounding="ROUND_HALF_UP")
    assert got[3] == Decimal("10") and got[4] is None


def test_to_rub_overflow_raises_like_a_numeric_column(spark):
    import pytest
    df = spark.createDataFrame([(Decimal("123456789012345.12345678"), Decimal("99"))], "a decimal(23,8), r decimal(23,8)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(to_rub("a", "r")).collect()


def test_sign_rule_and_rouble_flag(spark):
    df = spark.createDataFrame([("П", 5, 2), ("P", 5, 2), ("А", 5, 2), (None, 5, None), ("p", None, 3)],
                               "t string, d int, c int")
    got = [r[0] for r in df.select(is_passive("t")).collect()]
    assert got == [True, True, False, False, False]
    cur = spark.createDataFrame([("810",), ("643",), ("840",), (None,)], "c string")
    assert [r[0] for r in cur.select(is_rub("c")).collect()] == [True, True, False, False]


def test_effective_and_overlap_predicates(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), None), (D(2024, 1, 5), D(2024, 1, 10)), (D(2024, 2, 1), None)],
                               "data_actual_date date, data_actual_end_date date")
    on = [r[0] for r in df.select(effective_on(D(2024, 1, 10))).collect()]
    assert on == [True, True, False]
    ov = [r[0] for r in df.select(overlaps(D(2024, 1, 11), D(2024, 1, 31))).collect()]
    assert ov == [True, False, False]


def test_month_bounds():
    assert month_bounds("2024-02-10") == (D(2024, 2, 1), D(2024, 2, 29))
    assert prev_month_bounds("2024-01-01") == (D(2023, 12, 1), D(2023, 12, 31))
    assert prev_month_bounds(D(2024, 3, 31)) == (D(2024, 2, 1), D(2024, 2, 29))


def test_month_bounds_column_form(spark):
    df = spark.createDataFrame([(D(2024, 3, 31),), (D(2024, 1, 1),)], "d date")
    lo, hi = prev_month_bounds_col("d")
    assert [tuple(r) for r in df.select(lo, hi).collect()] == [
        (D(2024, 2, 1), D(2024, 2, 29)), (D(2023, 12, 1), D(2023, 12, 31))]
