"""Marts against a plain day-by-day Python model of the reference procedures."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from ledgerline.plans import marts

D = dt.date
Q8 = Decimal("0.00000001")
OPEN = D(5999, 12, 31)
LO, HI = D(2024, 1, 1), D(2024, 1, 20)
SEED_DAY = LO - dt.timedelta(days=1)

ACC_SCHEMA = ("data_actual_date date, data_actual_end_date date, account_rk long, account_number decimal(25,0), "
              "char_type string, currency_rk long, currency_code string")
RATE_SCHEMA = "data_actual_date date, data_actual_end_date date, currency_rk long, reduced_cource decimal(23,8)"
POST_SCHEMA = ("oper_date date, credit_account_rk long, debet_account_rk long, credit_amount decimal(23,8), "
               "debet_amount decimal(23,8)")
BAL_SCHEMA = "on_date date, account_rk long, currency_rk long, balance_out decimal(23,8)"


def _fixture(seed: int):
    rnd = random.Random(seed)
    accounts = []
    for a in range(1, 13):
        starts = sorted(rnd.sample(range(-10, 20), rnd.randint(1, 3)))
        for s in starts:
            start = LO + dt.timedelta(days=s)
            end = None if rnd.random() < 0.3 else start + dt.timedelta(days=rnd.randint(0, 12))
            accounts.append((start, end, a, Decimal(f"{30100 + a % 7}810{a:012d}") if a % 5 else None,
                             rnd.choice(["П", "А", "P", None]), rnd.randint(1, 4),
                             rnd.choice(["810", "643", "840", None])))
    rates = []
    for c in (1, 2, 3):
        rates.append((D(2023, 1, 1), LO + dt.timedelta(days=5), c, Decimal(rnd.randint(100, 9999)) / 100))
        rates.append((LO + dt.timedelta(days=3), None, c, Decimal(rnd.randint(100, 9999)) / 77))
    rates = [(f, t, c, r.quantize(Q8)) for f, t, c, r in rates]
    posts = []
    for _ in range(300):
        d = LO + dt.timedelta(days=rnd.randint(-2, 22))
        # seed 99: one hot account takes a third of all postings
        ca = 1 if seed == 99 and rnd.random() < 0.34 else rnd.choice([None] + list(range(1, 15)))
        da = rnd.choice([None] + list(range(1, 15)))
        amt = lambda: None if rnd.random() < 0.1 else Decimal(rnd.randint(-5000, 90000)) / 100
        posts.append((d, ca, da, amt(), amt()))
    seed_rows = [(SEED_DAY, a, rnd.randint(1, 4), Decimal(rnd.randint(-1000, 100000)) / 100)
                 for a in range(1, 15) if rnd.random() < 0.7]
    return accounts, rates, posts, seed_rows


def _asof(rows, key_idx, key, d, from_idx=0, to_idx=1):
    cands = [r for r in rows if r[key_idx] == key and r[from_idx] <= d <= (r[to_idx] or OPEN)]
    return max(cands, key=lambda r: r[from_idx]) if cands else None


def _model(accounts, rates, posts, seed_rows):
    turnover = {}
    for i in range((HI - LO).days + 1):
        d = LO + dt.timedelta(days=i)
        credit, debit = {}, {}
        for pd, ca, da, camt, damt in posts:
            if pd != d:
                continue
            if ca is not None:
                credit[ca] = credit.get(ca, Decimal(0)) + (camt or 0)
            if da is not None:
                debit[da] = debit.get(da, Decimal(0)) + (damt or 0)
        for a in set(credit) | set(debit):
            acc = _asof(accounts, 2, a, d)
            rate_row = _asof(rates, 2, acc[5], d) if acc else None
            rate = rate_row[3] if rate_row else Decimal(1)
            c, db = credit.get(a, Decimal(0)), debit.get(a, Decimal(0))
            turnover[(d, a)] = (c, (c * rate).quantize(Q8, ROUND_HALF_UP), db, (db * rate).quantize(Q8, ROUND_HALF_UP))
    balance = {}
    for d, a, cur, b in seed_rows:
        rate_row = _asof(rates, 2, cur, d)
        rate = rate_row[3] if rate_row else Decimal(1)
        balance[(d, a)] = (b, (b * rate).quantize(Q8, ROUND_HALF_UP))
    seed = dict(balance)
    out = {}
    for i in range((HI - LO).days + 1):
        d = LO + dt.timedelta(days=i)
        for a in sorted({r[2] for r in accounts}):
            acc = _asof(accounts, 2, a, d)
            if acc is None:
                continue
            prev = balance.get((d - dt.timedelta(days=1), a))
            t = turnover.get((d, a), (0, 0, 0, 0))
            sign = 1 if acc[4] in ("П", "P") else -1
            b = (prev[0] if prev else 0) + sign * (t[0] - t[2])
            br = (prev[1] if prev else 0) + sign * (t[1] - t[3])
            balance[(d, a)] = (b, br)
            out[(d, a)] = (b, br)
    return turnover, seed, out


@pytest.mark.parametrize("seed", [1, 2, 3, 99])
def test_turnover_and_balance_match_day_by_day_model(spark, seed):
    accounts, rates, posts, seed_rows = _fixture(seed)
    acc = spark.createDataFrame(accounts, ACC_SCHEMA)
    rt = spark.createDataFrame(rates, RATE_SCHEMA)
    po = spark.createDataFrame(posts, POST_SCHEMA)
    sd = spark.createDataFrame(seed_rows, BAL_SCHEMA)
    seed_bal = marts.seed_balance(sd, rt, SEED_DAY)
    t = marts.account_turnover(po, acc, rt, LO, HI)
    b = marts.account_balance(t, acc, seed_bal, LO, HI)
    exp_t, exp_seed, exp_b = _model(accounts, rates, posts, seed_rows)

    got_seed = {(r.on_date, r.account_rk): (r.balance_out, r.balance_out_rub) for r in seed_bal.collect()}
    assert got_seed == exp_seed
    got_t = {(r.on_date, r.account_rk): (r.credit_amount, r.credit_amount_rub, r.debet_amount, r.debet_amount_rub)
             for r in t.collect()}
    assert got_t == exp_t
    got_b = {(r.on_date, r.account_rk): (r.balance_out, r.balance_out_rub) for r in b.collect()}
    assert got_b == exp_b


def test_single_day_turnover_equals_range_slice(spark):
    accounts, rates, posts, _ = _fixture(7)
    acc = spark.createDataFrame(accounts, ACC_SCHEMA)
    rt = spark.createDataFrame(rates, RATE_SCHEMA)
    po = spark.createDataFrame(posts, POST_SCHEMA)
    day = D(2024, 1, 9)
    one = {tuple(r) for r in marts.account_turnover(po, acc, rt, day).collect()}
    rng = {tuple(r) for r in marts.account_turnover(po, acc, rt, LO, HI).collect() if r.on_date == day}
    assert one == rng and one


def test_form101_groups_and_splits_rouble(spark):
    acc = spark.createDataFrame([
        (D(2024, 1, 1), None, 1, Decimal("30101810000000000001"), "А", 1, "810"),
        (D(2024, 1, 1), None, 2, Decimal("30101810000000000002"), "А", 2, "840"),
        (D(2024, 1, 1), D(2024, 1, 10), 3, Decimal("30102810000000000003"), "П", 1, " 643 "),
        (D(2024, 1, 11), None, 3, None, "П", 1, "643"),          # latest version has no number
        (D(2024, 1, 1), None, 4, Decimal("30199810000000000004"), None, 1, "810"),  # no kind: dropped
        (D(2024, 2, 5), None, 5, Decimal("30101810000000000005"), "А", 1, "810"),  # outside period
    ], ACC_SCHEMA)
    led = spark.createDataFrame([(30101, "А", D(2008, 1, 1), None), (30102, "Б", D(2008, 1, 1), D(2050, 1, 1))],
                                "ledger_account int, chapter string, start_date date, end_date date")
    t = spark.createDataFrame([(D(2024, 1, 5), 1, Decimal(0), Decimal("10"), Decimal(0), Decimal("4")),
                               (D(2024, 1, 6), 2, Decimal(0), Decimal("7"), Decimal(0), Decimal("1")),
                               (D(2024, 2, 1), 1, Decimal(0), Decimal("100"), Decimal(0), Decimal("100"))],
                              "on_date date, account_rk long, credit_amount decimal(23,8), credit_amount_rub decimal(23,8),"
                              " debet_amount decimal(23,8), debet_amount_rub decimal(23,8)")
    b = spark.createDataFrame([(D(2023, 12, 31), 1, Decimal(0), Decimal("50")), (D(2024, 1, 31), 1, Decimal(0), Decimal("56")),
                               (D(2023, 12, 31), 3, Decimal(0), Decimal("5")), (D(2024, 1, 31), 2, Decimal(0), Decimal("-3"))],
                              "on_date date, account_rk long, balance_out decimal(23,8), balance_out_rub decimal(23,8)")
    rows = {(r.ledger_account, r.characteristic): r for r in marts.form101(acc, led, t, b, D(2024, 2, 1)).collect()}
    assert set(rows) == {("30101", "А"), ("30102", "П")}
    r = rows[("30101", "А")]
    assert (r.from_date, r.to_date, r.chapter) == (D(2024, 1, 1), D(2024, 1, 31), "А")
    assert (r.balance_in_rub, r.balance_in_val, r.balance_in_total) == (Decimal(50), Decimal(0), Decimal(50))
    assert (r.turn_cre_rub, r.turn_cre_val, r.turn_cre_total) == (Decimal(10), Decimal(7), Decimal(17))
    assert (r.turn_deb_rub, r.turn_deb_val, r.turn_deb_total) == (Decimal(4), Decimal(1), Decimal(5))
    assert (r.balance_out_rub, r.balance_out_val, r.balance_out_total) == (Decimal(56), Decimal(-3), Decimal(53))
    r3 = rows[("30102", "П")]   # earlier version with a number; trimmed code 643 is rouble
    assert r3.chapter == "Б" and r3.balance_in_rub == Decimal(5) and r3.balance_in_val == Decimal(0)
