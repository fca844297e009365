"""Deposit analytics over users, logins, operations and trades.

Plans are shaped for skew: every per-user answer is first reduced per login
(partial aggregation or a per-login top-n) before the joins, so a login or user
holding a large share of the operations never sends its raw rows through a
join or into a single window task.
"""

from __future__ import annotations

import datetime as dt

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPOSIT = "deposit"
REAL = "real"


def _as_of_sql(as_of) -> str:
    """``as_of`` as a SQL timestamp expression (default: now)."""
    if as_of is None:
        return "CAST(current_timestamp() AS TIMESTAMP_NTZ)"
    if isinstance(as_of, dt.datetime):
        return f"TIMESTAMP_NTZ'{as_of.isoformat(sep=' ')}'"
    if isinstance(as_of, dt.date):
        return f"TIMESTAMP_NTZ'{as_of.isoformat()} 00:00:00'"
    return f"CAST('{as_of}' AS TIMESTAMP_NTZ)"


def deposits(operations: DataFrame) -> DataFrame:
    return operations.filter(f"operation_type = '{DEPOSIT}'")


# Date and operation_uid in one number that orders like the two together
# (2**64 uids from -2**63 on): a fixed-width buffer, which hash-aggregates.
DEPOSIT_ORDER = (
    "CAST(unix_micros(CAST(operation_date AS TIMESTAMP)) AS DECIMAL(18,0)) * 18446744073709551616BD"
    " + (CAST(operation_uid AS DECIMAL(19,0)) + 9223372036854775808BD)"
)


def first_deposit_per_user(logins: DataFrame, operations: DataFrame, account_type: str | None = REAL) -> DataFrame:
    """Earliest deposit per user over the user's logins (ties: lowest
    operation_uid; deposits without a date are none).

    Columns: user_uid, login, operation_uid, operation_date. The earliest
    deposit is found per login first (partial aggregation), then per user.
    """
    place = F.expr(f"CAST({DEPOSIT_ORDER} AS DECIMAL(38,0)) AS place")
    first = ("min_by(operation_uid, place) AS operation_uid", "min_by(operation_date, place) AS operation_date")
    per_login = (
        deposits(operations).filter("operation_date IS NOT NULL").select("login", "operation_uid", "operation_date", place)
        .groupBy("login").agg(*map(F.expr, first), F.expr("min(place) AS place"))
    )
    owned = logins if account_type is None else logins.filter(f"account_type = '{account_type}'")
    return (
        per_login.join(owned.select("user_uid", "login"), "login", "inner")
        .groupBy("user_uid").agg(F.expr("min_by(login, place) AS login"), *map(F.expr, first))
    )


def first_trade_per_login(trades: DataFrame) -> DataFrame:
    return trades.groupBy("login").agg(F.expr("min(order_close_date) AS first_order_date"))


def first_deposit_funnel(
    users: DataFrame,
    logins: DataFrame,
    operations: DataFrame,
    trades: DataFrame | None = None,
    as_of=None,
    days: int = 900,
    first_trades: DataFrame | None = None,
) -> DataFrame:
    """Per country, users whose first deposit (on a real login) is known.

    Trades enter only as the first close date per login: pass ``trades``
    (order_uid, login, order_close_date) or an already reduced
    ``first_trades`` (login, first_order_date).

    Only users registered within ``days`` before ``as_of`` count (default:
    now); that filter is applied to the users before the joins (uid is the
    users' key, so it commutes with the per-user first deposit).
    Columns: country, login_count, avg_reg_to_dep, avg_dep_to_ord (calendar
    days; users without a trade only count in the first average).
    """
    recent = users.filter(
        f"registration_date >= timestampadd(DAY, -{int(days)}, {_as_of_sql(as_of)})"
    ).select("uid", "registration_date", "country")
    first = first_deposit_per_user(logins, operations, REAL)
    if first_trades is None:
        if trades is None:
            raise ValueError("pass trades or first_trades")
        first_trades = first_trade_per_login(trades)
    funnel = first.join(recent, F.expr("user_uid = uid"), "inner").join(first_trades, "login", "left")
    return (
        funnel.groupBy("country")
        .agg(
            F.expr("count(login) AS login_count"),
            F.expr("avg(date_diff(to_date(operation_date), to_date(registration_date))) AS avg_reg_to_dep"),
            F.expr("avg(date_diff(to_date(first_order_date), to_date(operation_date))) AS avg_dep_to_ord"),
        )
        .orderBy(F.expr("login_count DESC"), F.expr("country"))
    )


def high_avg_deposit_by_country(
    users: DataFrame,
    logins: DataFrame,
    operations: DataFrame,
    threshold=1000,
) -> DataFrame:
    """Users whose average deposit is >= threshold, counted per country.

    Columns: country, avg_dep_gte_1k (users over the threshold), count_all
    (all users of the country). Countries without such a user are left out.
    Sums and counts are reduced per login, then per user, before the users
    join; the average is compared as ``sum >= threshold * count`` (exact).
    """
    per_login = deposits(operations).groupBy("login").agg(F.expr("sum(amount) AS s"), F.expr("count(amount) AS n"))
    per_user = (
        per_login.join(logins.select("user_uid", "login"), "login", "inner")
        .groupBy("user_uid")
        .agg(F.expr("sum(s) AS s"), F.expr("sum(n) AS n"))
    )
    qualified = (
        per_user.join(users.select("uid", "country"), F.expr("user_uid = uid"), "inner")
        .groupBy("uid", "country")
        .agg(F.expr("sum(s) AS s"), F.expr("sum(n) AS n"))
        .filter(f"n > 0 AND s >= {_number(threshold)} * n")
    )
    high = qualified.groupBy("country").agg(F.expr("count(uid) AS avg_dep_gte_1k"))
    all_clients = users.groupBy("country").agg(F.expr("count(uid) AS count_all"))
    return high.join(all_clients, "country", "inner").select("country", "avg_dep_gte_1k", "count_all").orderBy("country")


def _number(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        raise TypeError(f"threshold must be a number, got {value!r}")
    return f"{Decimal(str(value))}BD"


def first_n_deposits(users: DataFrame, logins: DataFrame, operations: DataFrame, n: int = 3) -> DataFrame:
    """Each user's deposits ranked by date, ``rank <= n`` (ties may give more).

    Columns: uid, login, operation_date, dep_rank; ordered by uid, dep_rank.

    A deposit ranked <= n within its user is ranked <= n within its login, and
    dropping login-rank > n rows never changes a kept row's user rank, so the
    operations are first cut to the per-login top n. Both windows carry a
    ``rank <= n`` filter, which Spark runs as a partial group limit before the
    shuffle, so a hot login or user sends at most its top n (plus ties) per
    map partition.
    """
    n = int(n)
    top_per_login = (
        deposits(operations)
        .selectExpr("login", "operation_date", "rank() OVER (PARTITION BY login ORDER BY operation_date) AS _r")
        .filter(f"_r <= {n}")
        .drop("_r")
    )
    joined = top_per_login.join(logins.select("user_uid", "login"), "login", "inner").join(
        users.select("uid"), F.expr("user_uid = uid"), "inner"
    )
    return (
        joined.selectExpr(
            "uid", "login", "operation_date", "rank() OVER (PARTITION BY uid ORDER BY operation_date) AS dep_rank"
        )
        .filter(f"dep_rank <= {n}")
        .orderBy("uid", "dep_rank")
    )
