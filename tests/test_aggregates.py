"""Signed sums and the latest-calculation pick."""

import datetime as dt
from decimal import Decimal

from ledgerlens import schemas
from ledgerlens.operators import aggregates as agg

ROWS = [  # login, time, signed amount: month and year ends, mixed signs, a day that nets to zero
    (31, "2023-12-31 23:59:59", "70.2500"),
    (31, "2024-01-01 00:00:00", "-20.0000"),
    (31, "2024-01-01 18:30:00", "20.0000"),
    (31, "2024-02-29 12:00:00", "0.0001"),
    (44, "2024-01-31 08:00:00", "-5.5000"),
    (44, "2024-01-31 09:00:00", "-4.5000"),
    (44, "2024-02-01 00:00:00", "1000000.0000"),
]


def signed(spark, rows):
    frame = spark.createDataFrame([(k, t, Decimal(a)) for k, t, a in rows], "login long, transaction_ts string, sign_amount decimal(38,4)")
    return frame.selectExpr("login", "CAST(transaction_ts AS TIMESTAMP_NTZ) AS transaction_ts", "sign_amount")


def sums(rows, bucket):
    out = {}
    for login, ts, amount in rows:
        out[login, bucket(ts)] = out.get((login, bucket(ts)), Decimal(0)) + Decimal(amount)
    return out


def test_daily_sums(spark):
    got = {(r.login, r.date_from.isoformat()): r.daily_sum for r in agg.daily_agg(signed(spark, ROWS), calculation_ts=False).collect()}
    assert got == sums(ROWS, lambda ts: ts[:10])
    assert got[31, "2024-01-01"] == 0  # a day that nets to zero stays


def test_monthly_sums_start_on_the_first(spark):
    got = {(r.login, r.date_from.isoformat()): r.monthly_sum for r in agg.monthly_agg(signed(spark, ROWS), calculation_ts=False).collect()}
    assert got == sums(ROWS, lambda ts: ts[:7] + "-01")


def test_total_sums(spark):
    got = {(r.login, ""): r.total_sum for r in agg.total_agg(signed(spark, ROWS), calculation_ts=False).collect()}
    assert got == sums(ROWS, lambda ts: "")


def test_calculation_time_has_one_type(spark):
    at = dt.datetime(2024, 3, 1, 7, 8, 9, 123456)
    for fn in (agg.daily_agg, agg.monthly_agg, agg.total_agg):
        stamped = [fn(signed(spark, ROWS), calculation_ts=c) for c in (None, at, "2024-03-01 07:08:09.123456")]
        assert {df.schema["calculation_ts"].dataType.simpleString() for df in stamped} == {"timestamp_ntz"}
        assert {r.calculation_ts for df in stamped[1:] for r in df.collect()} == {at}
    assert all(r.calculation_ts is not None for r in agg.total_agg(signed(spark, ROWS)).collect())
    assert {schemas.DAILY_AGG["calculation_ts"].dataType.simpleString(), schemas.TOTAL_AGG["calculation_ts"].dataType.simpleString()} == {"timestamp_ntz"}


def test_signed_amounts_sign(spark):
    df = spark.createDataFrame(
        [(1, -1, "2020-01-01 00:00:00", Decimal("10.5"))], "login long, transaction_type long, transaction_ts string, amount decimal(18,4)"
    )
    out = agg.signed_amounts(df).collect()[0]
    assert out.sign_amount == Decimal("-10.5")


def test_rollup_from_daily_matches_direct(spark):
    df = signed(spark, ROWS)
    daily = agg.daily_agg(df, calculation_ts=False)
    monthly, total = agg.rollup_from_daily(daily, calculation_ts=False)
    assert sorted(map(tuple, monthly.collect())) == sorted(map(tuple, agg.monthly_agg(df, calculation_ts=False).collect()))
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, agg.total_agg(df, calculation_ts=False).collect()))


def test_latest_aggregates_picks_newest_per_key(spark):
    hist = spark.createDataFrame(
        [
            (1, dt.date(2020, 4, 9), Decimal("250"), dt.datetime(2020, 5, 1)),
            (1, dt.date(2020, 4, 9), Decimal("260"), dt.datetime(2020, 6, 1)),
            (1, dt.date(2020, 4, 10), Decimal("5"), dt.datetime(2020, 5, 1)),
            (2, dt.date(2020, 4, 9), Decimal("1"), dt.datetime(2020, 4, 1)),
        ],
        "login long, date_from date, daily_sum decimal(38,4), calculation_ts timestamp_ntz",
    )
    got = sorted(tuple(r) for r in agg.latest_aggregates(hist, ["login", "date_from"]).collect())
    assert got == [
        (1, dt.date(2020, 4, 9), Decimal("260"), dt.datetime(2020, 6, 1)),
        (1, dt.date(2020, 4, 10), Decimal("5"), dt.datetime(2020, 5, 1)),
        (2, dt.date(2020, 4, 9), Decimal("1"), dt.datetime(2020, 4, 1)),
    ]
