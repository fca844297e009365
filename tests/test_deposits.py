"""Deposit analytics: semantics on small frames, and the plan rewrites against
the straightforward formulation on the test tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import deposits
from ledgerlens.sources import views as v

T = dt.datetime


def frames(spark):
    users = spark.createDataFrame(
        [
            (1, T(2019, 1, 1, 12), "RU", "a"),
            (2, T(2019, 6, 1), "UK", "b"),
            (3, T(2015, 1, 1), "UK", "c"),  # registered long before the cutoff
            (4, T(2019, 1, 1), "US", "d"),  # no login
        ],
        "uid long, registration_date timestamp_ntz, country string, first_name string",
    )
    logins = spark.createDataFrame(
        [
            (1, 11, "real", T(2019, 1, 2)),
            (1, 12, "demo", T(2019, 1, 2)),
            (2, 21, "real", T(2019, 6, 2)),
            (3, 31, "real", T(2015, 1, 2)),
        ],
        "user_uid long, login long, account_type string, created_ts timestamp_ntz",
    )
    ops = spark.createDataFrame(
        [
            (100, "deposit", T(2020, 1, 1, 23), 11, Decimal("100")),
            (101, "deposit", T(2019, 12, 31), 12, Decimal("5000")),  # demo login: ignored by C1
            (102, "deposit", T(2020, 1, 5), 11, Decimal("300")),
            (103, "withdrawal", T(2019, 1, 1), 11, Decimal("1")),
            (200, "deposit", T(2019, 7, 1), 21, Decimal("2000")),
            (201, "deposit", T(2019, 7, 1), 21, Decimal("10")),  # same instant: tie
            (300, "deposit", T(2016, 1, 1), 31, Decimal("7")),
        ],
        "operation_uid long, operation_type string, operation_date timestamp_ntz, login long, amount decimal(18,4)",
    )
    trades = spark.createDataFrame(
        [(1, 11, T(2020, 1, 2, 1)), (2, 11, T(2020, 3, 1)), (3, 12, T(2019, 1, 1))],
        "order_uid long, login long, order_close_date timestamp_ntz",
    )
    return users, logins, ops, trades


def test_first_deposit_funnel(spark):
    users, logins, ops, trades = frames(spark)
    got = {r.country: r for r in deposits.first_deposit_funnel(users, logins, ops, trades, as_of="2020-04-09", days=900).collect()}
    assert set(got) == {"RU", "UK"}  # user 3 registered before the cutoff, user 4 has no deposit
    ru = got["RU"]
    assert ru.login_count == 1
    # 2019-01-01 12:00 -> 2020-01-01 23:00: 365 calendar days; first trade next day: 1
    assert ru.avg_reg_to_dep == 365.0 and ru.avg_dep_to_ord == 1.0
    uk = got["UK"]
    assert uk.login_count == 1 and uk.avg_reg_to_dep == 30.0 and uk.avg_dep_to_ord is None


def test_first_deposit_tie_break_by_operation_uid(spark):
    _, logins, ops, _ = frames(spark)
    first = {r.user_uid: r.operation_uid for r in deposits.first_deposit_per_user(logins, ops).collect()}
    assert first[2] == 200


def test_high_avg_deposit(spark):
    users, logins, ops, _ = frames(spark)
    got = [tuple(r) for r in deposits.high_avg_deposit_by_country(users, logins, ops, threshold=1000).collect()]
    # user 1: (100 + 5000 + 300) / 3 = 1800 -> counts; user 2: 1005 -> counts; user 3: 7
    assert got == [("RU", 1, 1), ("UK", 1, 2)]
    got = [tuple(r) for r in deposits.high_avg_deposit_by_country(users, logins, ops, threshold=1800).collect()]
    assert got == [("RU", 1, 1)]


def test_first_n_deposits_with_ties(spark):
    users, logins, ops, _ = frames(spark)
    rows = [tuple(r) for r in deposits.first_n_deposits(users, logins, ops, n=1).collect()]
    assert rows == [
        (1, 12, T(2019, 12, 31), 1),
        (2, 21, T(2019, 7, 1), 1),
        (2, 21, T(2019, 7, 1), 1),
        (3, 31, T(2016, 1, 1), 1),
    ]


@pytest.mark.parametrize("n", [1, 3])
def test_first_n_matches_single_window(spark, n):
    """The per-login pre-cut gives the same rows as one window over all deposits."""
    users, logins, ops = v.users(spark, SF_SMALL), v.logins(spark, SF_SMALL), v.operations(spark, SF_SMALL)
    fast = deposits.first_n_deposits(users, logins, ops, n=n)
    plain = (
        users.join(logins, F.expr("uid = user_uid"))
        .join(ops.filter("operation_type = 'deposit'"), "login")
        .selectExpr("uid", "login", "operation_date", "rank() OVER (PARTITION BY uid ORDER BY operation_date) AS dep_rank")
        .filter(f"dep_rank <= {n}")
    )
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, plain.collect()))


def test_funnel_equals_plain_arithmetic(spark):
    """The funnel worked out user by user in Python."""
    import datetime as dt

    views = [f(spark, SF_SMALL) for f in (v.users, v.logins, v.operations, v.trades)]
    users, logins, ops, trades = ([r.asDict() for r in df.collect()] for df in views)
    owner = {r["login"]: r["user_uid"] for r in logins if r["account_type"] == "real"}
    earliest, traded = {}, {}
    for r in ops:
        if r["operation_type"] == "deposit" and r["login"] in owner:
            mine = (r["operation_date"], r["operation_uid"], r["login"])
            earliest[owner[r["login"]]] = min(mine, earliest.get(owner[r["login"]], mine))
    for r in trades:
        traded[r["login"]] = min(r["order_close_date"], traded.get(r["login"], r["order_close_date"]))
    waits, closes = {}, {}
    for u in users:
        if u["uid"] in earliest and u["registration_date"] >= dt.datetime(1996, 12, 1) - dt.timedelta(days=900):
            day, _, login = earliest[u["uid"]]
            waits.setdefault(u["country"], []).append((day.date() - u["registration_date"].date()).days)
            if login in traded:
                closes.setdefault(u["country"], []).append((traded[login].date() - day.date()).days)
    rows = deposits.first_deposit_funnel(*views, as_of="1996-12-01", days=900).collect()
    assert {r.country: r.login_count for r in rows} == {c: len(w) for c, w in waits.items()}
    for r in rows:
        assert abs(r.avg_reg_to_dep - sum(waits[r.country]) / len(waits[r.country])) < 1e-9
        own = closes.get(r.country)
        assert r.avg_dep_to_ord is None if not own else abs(r.avg_dep_to_ord - sum(own) / len(own)) < 1e-9
    counts = [(-r.login_count, r.country) for r in rows]
    assert counts == sorted(counts)
