"""Sums brought up to date by changed dates only."""

import datetime as dt
import os
import random
from decimal import Decimal

from ledgerlens.operators import aggregates as agg
from ledgerlens.plans import refresh as rf
from ledgerlens.schemas import LEDGER


def rows(seed, days):
    rng = random.Random(seed)
    return [
        (rng.randrange(10**6), rng.randrange(5), None, rng.choice([1, -1]), dt.datetime(2023, m, d, rng.randrange(24)), rng.choice(["a", "", None]), Decimal(rng.randrange(10**6)) / 100)
        for m, d in days
        for _ in range(rng.randrange(2, 9))
    ]


def shown(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


def assert_full(spark, clean, done):
    signed = agg.signed_amounts(rf.clean_rows(spark, clean))
    for path, schema, full in (
        (done.daily, rf.DAILY, agg.daily_agg(signed, False)), (done.monthly, rf.MONTHLY, agg.monthly_agg(signed, False)), (done.total, rf.TOTAL, agg.total_agg(signed, False)),
    ):
        assert shown(rf._read(spark, path, schema)) == shown(full)


def files(path):
    return {f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for folder, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_only_the_changed_date_and_its_month_are_written(spark, tmp_dir):
    clean, out = f"{tmp_dir}/clean", f"{tmp_dir}/sums"
    table = spark.createDataFrame(rows(1, [(1, 5), (1, 9), (2, 3), (2, 4), (3, 7)]), LEDGER)
    rf.write_dates(spark, table, clean)
    done = rf.refresh(spark, clean, out)
    assert len(done.dates) == 5 and len(done.months) == 3
    assert_full(spark, clean, done)
    # The same rows in another order are no change.
    rf.write_dates(spark, table.repartition(3), clean)
    assert rf.refresh(spark, clean, out).dates == ()
    before = files(out)
    rf.write_dates(spark, spark.createDataFrame(rows(2, [(2, 4)]), LEDGER), clean)
    done = rf.refresh(spark, clean, out)
    assert done.dates == (dt.date(2023, 2, 4),) and done.months == (dt.date(2023, 2, 1),)
    assert_full(spark, clean, done)
    after = files(out)
    changed = {k for k in set(before) ^ set(after) if "/daily/" in k or "/monthly/" in k}
    assert {k.split("date_from=")[1].split("/")[0] for k in changed if "/daily/" in k} == {"2023-02-04"}
    assert {k.split("date_from=")[1].split("/")[0] for k in changed if "/monthly/" in k} == {"2023-02-01"}


def test_only_changed_folders_are_read(spark, tmp_dir):
    clean = f"{tmp_dir}/clean"
    rf.write_dates(spark, spark.createDataFrame(rows(3, [(1, 5), (1, 9), (2, 3)]), LEDGER), clean)
    some = rf.clean_rows(spark, clean, [dt.date(2023, 1, 9)])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "transaction_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0].rsplit("/", 2)[1] for r in some.selectExpr("input_file_name()").collect()} == {"transaction_date=2023-01-09"}


def test_new_and_lost_dates_and_empty_tables(spark, tmp_dir):
    clean, out = f"{tmp_dir}/clean", f"{tmp_dir}/sums"
    rf.write_dates(spark, spark.createDataFrame([], LEDGER), clean)
    assert rf.refresh(spark, clean, out).dates == ()
    rf.write_dates(spark, spark.createDataFrame(rows(4, [(5, 1), (5, 2), (6, 1)]), LEDGER), clean)
    rf.refresh(spark, clean, out)
    rf.write_dates(spark, spark.createDataFrame(rows(5, [(7, 8)]), LEDGER), clean, gone=(dt.date(2023, 6, 1),))
    done = rf.refresh(spark, clean, out)
    assert done.dates == (dt.date(2023, 6, 1), dt.date(2023, 7, 8))
    assert_full(spark, clean, done)


def test_digests_count_repeats_and_tell_nulls(spark):
    one = rows(6, [(1, 1)])
    base = spark.createDataFrame(one, LEDGER).selectExpr("*", "to_date(transaction_ts) AS transaction_date")
    digest = shown(rf.digests(base))
    assert digest == shown(rf.digests(base.repartition(4)))
    assert digest != shown(rf.digests(base.unionByName(base.limit(1))))
    assert digest != shown(rf.digests(base.selectExpr(*(f"coalesce({c}, 0) AS {c}" if c == "counter_login" else c for c in base.columns))))
