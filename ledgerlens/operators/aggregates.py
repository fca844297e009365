"""Signed sums per login: daily, monthly, total, and the latest recalculation.

Sums are decomposable, so every aggregate runs as a partial (map-side)
aggregation followed by a final one: a login holding a large share of the
transactions is reduced to one row per map task before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.schemas import MONEY_SUM

SUM_TYPE = MONEY_SUM.simpleString()


def _calc_ts(calculation_ts) -> str | None:
    if calculation_ts is False:
        return None
    if calculation_ts is None:
        return "CAST(current_timestamp() AS TIMESTAMP_NTZ)"
    if isinstance(calculation_ts, dt.datetime):
        return f"TIMESTAMP_NTZ'{calculation_ts.isoformat(sep=' ')}'"
    if isinstance(calculation_ts, str):
        return f"CAST('{calculation_ts}' AS TIMESTAMP_NTZ)"
    raise TypeError(f"calculation_ts: unsupported {calculation_ts!r}")


def signed_amounts(clean: DataFrame) -> DataFrame:
    """Login, transaction_type, transaction_ts, amount, sign_amount = amount * type."""
    return clean.selectExpr(
        "login",
        "transaction_type",
        "transaction_ts",
        "amount",
        f"CAST(amount * transaction_type AS {SUM_TYPE}) AS sign_amount",
    )


def _finish(df: DataFrame, calculation_ts) -> DataFrame:
    ts = _calc_ts(calculation_ts)
    return df if ts is None else df.selectExpr("*", f"{ts} AS calculation_ts")


def _sum(col: str, out: str):
    return F.expr(f"CAST(sum({col}) AS {SUM_TYPE}) AS {out}")


def daily_agg(signed: DataFrame, calculation_ts=None) -> DataFrame:
    """C14: login, date_from (day), daily_sum[, calculation_ts].

    ``calculation_ts``: None -> now; a datetime or text -> that instant; False
    -> no column. The column has no time zone in any case (UTC is meant).
    """
    out = signed.groupBy("login", F.expr("to_date(transaction_ts) AS date_from")).agg(_sum("sign_amount", "daily_sum"))
    return _finish(out, calculation_ts)


def monthly_agg(signed: DataFrame, calculation_ts=None) -> DataFrame:
    """Login, date_from (first day of the month, a date), monthly_sum[, calculation_ts]."""
    month = F.expr("trunc(to_date(transaction_ts), 'MM') AS date_from")
    out = signed.groupBy("login", month).agg(_sum("sign_amount", "monthly_sum"))
    return _finish(out, calculation_ts)


def total_agg(signed: DataFrame, calculation_ts=None) -> DataFrame:
    """Login, total_sum[, calculation_ts]."""
    out = signed.groupBy("login").agg(_sum("sign_amount", "total_sum"))
    return _finish(out, calculation_ts)


def rollup_from_daily(daily: DataFrame, calculation_ts=None) -> tuple[DataFrame, DataFrame]:
    """Monthly and total sums derived from daily sums (far fewer rows than transactions)."""
    monthly = daily.groupBy("login", F.expr("trunc(date_from, 'MM') AS date_from")).agg(
        _sum("daily_sum", "monthly_sum")
    )
    total = daily.groupBy("login").agg(_sum("daily_sum", "total_sum"))
    return _finish(monthly, calculation_ts), _finish(total, calculation_ts)


def latest_aggregates(history: DataFrame, keys: Sequence[str], ts_col: str = "calculation_ts") -> DataFrame:
    """Newest row per key from an aggregate history, whose own key is
    (keys, ``ts_col``): one calculation has one row per key.

    Runs as ``max_by`` per key over fixed-width buffers: a partial hash
    aggregation, so a key with many recalculations never gathers its rows in
    one task, and no task sorts.
    """
    keys = list(keys)
    others = [c for c in history.columns if c not in keys and c != ts_col]
    return history.groupBy(*keys).agg(*(F.max_by(c, ts_col).alias(c) for c in others), F.max(ts_col).alias(ts_col))
