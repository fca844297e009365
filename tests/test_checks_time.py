"""Data checks, time helpers and re-run behaviour of the jobs."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.config import Tolerances
from ledgerlens.functions import time as tm
from ledgerlens.operators import checks
from ledgerlens.plans import jobs
from ledgerlens.sources import views as v


def test_seed_timestamps_with_and_without_seconds(spark):
    df = spark.createDataFrame([("01.01.2019 12:00",), ("02.01.2020 13:00:05",), ("2020-01-01",), (None,)], "t string")
    got = [r.ts for r in df.select(tm.parse_seed_timestamp("t").alias("ts")).collect()]
    assert got == [dt.datetime(2019, 1, 1, 12, 0), dt.datetime(2020, 1, 2, 13, 0, 5), None, None]


def test_epoch_round_trip_and_calendar_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 4, 9, 23, 30, 1, 900000),)], "ts timestamp_ntz")
    r = df.select(
        tm.to_epoch_seconds("ts").alias("e"),
        tm.epoch_to_text(tm.to_epoch_seconds("ts")).alias("txt"),
        tm.epoch_to_timestamp(tm.to_epoch_seconds("ts")).alias("back"),
        tm.day_of("ts").alias("d"),
        tm.month_start("ts").alias("m"),
        tm.day_diff("ts", F.lit(dt.datetime(2020, 4, 10, 0, 30)).cast("timestamp_ntz")).alias("dd"),
    ).collect()[0]
    assert r.e == 1586475001 and r.txt == "2020-04-09 23:30:01"
    assert r.back == dt.datetime(2020, 4, 9, 23, 30, 1)
    assert r.d == dt.date(2020, 4, 9) and r.m == dt.date(2020, 4, 1)
    assert r.dd == 1  # one calendar day, though only one hour apart


def test_duplicate_keys_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "b", 5), (2, None, 6)], "id long, name string, counter long"
    )
    assert [tuple(r) for r in checks.duplicate_keys(df, ["id"]).collect()] == [(1, 2)]
    assert sorted(r.id for r in checks.not_null_violations(df, ["name", "counter"]).collect()) == [1, 2]
    counts = {r.column: r.nulls for r in checks.null_counts(df, ["name", "counter"]).collect()}
    assert counts == {"name": 1, "counter": 1}


def test_over_length_reports_each_violation(spark):
    df = spark.createDataFrame([(1, "RUSSIA", "x" * 81), (2, "UK", "ok")], "uid long, country string, first_name string")
    got = sorted(tuple(r) for r in checks.over_length(df, {"country": 4, "first_name": 80}, keys=["uid"]).collect())
    assert got == [(1, "country", 6, 4), (1, "first_name", 81, 80)]


def test_default_timestamp_fills_only_missing(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, None)], "id long, ts timestamp_ntz")
    got = {r.id: r.ts for r in checks.fill_default_timestamp(df, "ts", "2000-01-01 00:00:00").collect()}
    assert got == {1: dt.datetime(2020, 1, 1), 2: dt.datetime(2000, 1, 1)}
    now_filled = checks.fill_default_timestamp(df, "ts").filter("id = 2").collect()[0].ts
    assert now_filled is not None


def test_reconcile_rerun_replaces_its_output(spark, tmp_dir):
    ledger, second = v.ledger(spark, SF_SMALL), v.second_source(spark, SF_SMALL)
    out = jobs.reconcile(spark, ledger, second, f"{tmp_dir}/rec", Tolerances())
    first = spark.read.parquet(out.clean).count()
    jobs.reconcile(spark, ledger, second, f"{tmp_dir}/rec", Tolerances())
    assert spark.read.parquet(out.clean).count() == first
    pairs = spark.read.parquet(out.pairs).count()
    assert pairs == spark.read.parquet(out.pairs).select("transaction_uid", "transaction_uid_2").distinct().count()


def test_multi_reconcile_job_matches_union_form(spark, tmp_dir):
    from ledgerlens.plans.registry import QUERIES

    out = jobs.reconcile(spark, v.ledger(spark, SF_SMALL), v.second_source(spark, SF_SMALL), f"{tmp_dir}/m", multi=True)
    got = jobs.read_clean(spark, out.clean).count()
    assert got == QUERIES["c12_clean_transactions_multi"](spark, SF_SMALL).count()
    amounts = jobs.read_clean(spark, out.clean).agg(F.sum("amount")).collect()[0][0]
    assert isinstance(amounts, Decimal)
