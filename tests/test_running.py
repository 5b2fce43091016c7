"""Property test: island running sum == the day-by-day recurrence."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators.running import island_running_sum

LO = dt.date(2024, 1, 1)

rows_st = st.lists(
    st.tuples(st.integers(1, 4), st.integers(0, 20), st.integers(-10**6, 10**6)),
    min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1]))
opening_st = st.dictionaries(st.integers(1, 5), st.integers(-10**6, 10**6), max_size=5)


def _loop(rows, opening):
    """balance(d) = (balance(d-1) if that row exists else 0) + delta(d); the row
    before the range is the opening."""
    days = {(k, LO + dt.timedelta(days=o)): Decimal(v) / 100 for k, o, v in rows}
    bal = {(k, LO - dt.timedelta(days=1)): Decimal(v) / 100 for k, v in opening.items()}
    out = {}
    for (k, d) in sorted(days, key=lambda x: x[1]):
        prev = bal.get((k, d - dt.timedelta(days=1)))
        bal[(k, d)] = (prev if prev is not None else 0) + days[(k, d)]
        out[(k, d)] = bal[(k, d)]
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, opening=opening_st)
def test_island_sum_equals_recurrence(spark, rows, opening):
    df = spark.createDataFrame([(k, LO + dt.timedelta(days=o), Decimal(v) / 100) for k, o, v in rows],
                               "k int, d date, x decimal(24,8)")
    op = spark.createDataFrame([(k, Decimal(v) / 100) for k, v in opening.items()], "k int, x decimal(24,8)")
    got = {(r.k, r.d): r.x for r in island_running_sum(df, "k", "d", ["x"], LO, op).collect()}
    assert got == _loop(rows, opening)
