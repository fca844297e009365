"""Signed sums kept up to date: only dates whose clean rows changed are calculated anew.

Next to the clean rows (a folder a date) lies a digest of each date: the number of
its rows and sums of row hashes, which do not depend on the order of rows and count
repeated ones. The sums keep the digests they were made from; dates whose digests
differ are read again by a partition filter, then the daily sums of their months.
Totals come from the monthly sums.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ledgerlens.operators import aggregates as agg
from ledgerlens.schemas import LEDGER
from ledgerlens.session import scratch, stored
from ledgerlens.sources.sinks import write_partitioned

DATE = "transaction_date"
DIGEST = "transaction_date date, n long, high decimal(38,0), low decimal(38,0)"
DAILY = "login long, daily_sum decimal(38,4), date_from date"
MONTHLY = "login long, monthly_sum decimal(38,4), date_from date"
TOTAL = "login long, total_sum decimal(38,4)"


@dataclass(frozen=True)
class Refreshed:
    daily: str
    monthly: str
    total: str
    dates: tuple[dt.date | None, ...]
    months: tuple[dt.date | None, ...]


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    store, folder = _folder(spark, path)
    return spark.read.schema(schema).parquet(path) if store.exists(folder) else spark.createDataFrame([], schema)


def digests(clean: DataFrame) -> DataFrame:
    """(transaction_date, n, high, low): an order-independent digest of the rows of
    each date, by partial aggregation. NULLs have their own hash, dates may be NULL."""
    row = ", ".join(f"`{c}`, `{c}` IS NULL" for c in clean.columns if c != DATE)
    sums = [F.expr(f"sum(CAST(xxhash64({row}, {k}) AS DECIMAL(38,0))) AS {name}") for k, name in enumerate(("high", "low"))]
    return clean.groupBy(DATE).agg(F.expr("count(1) AS n"), *sums).selectExpr(DATE, "n", "CAST(high AS DECIMAL(38,0)) AS high", "CAST(low AS DECIMAL(38,0)) AS low")


def write_dates(spark: SparkSession, rows: DataFrame, clean: str, gone: tuple[dt.date, ...] = ()) -> None:
    """Replace the dates of ``rows`` (the columns of the ledger) in the clean table,
    drop those that are ``gone``, then bring the digests of these dates up to date.
    A date whose rows were replaced without that, by a failure in between, is right
    after the next run of its delivery."""
    whole = rows.withColumn(DATE, F.expr("to_date(transaction_ts)"))
    with scratch(spark):
        kept = stored(whole, "clean-dates")
        write_partitioned(kept, f"{clean}/rows", DATE, cluster_by=("transaction_uid",))
        for day in gone:
            store, folder = _folder(spark, f"{clean}/rows/{DATE}={day.isoformat()}")
            store.delete(folder, True)
        new = digests(kept).unionByName(spark.createDataFrame([(d, 0, None, None) for d in gone], DIGEST))
        old = _read(spark, f"{clean}/digests", DIGEST)
        left = old.join(new.select(F.col(DATE).alias("_day")), F.expr(f"{DATE} <=> _day"), "left_anti")
        stored(left.unionByName(new.filter("n > 0")), "clean-digests").coalesce(1).write.mode("overwrite").parquet(f"{clean}/digests")


def changed_dates(spark: SparkSession, clean: str, out_dir: str) -> list:
    """Dates whose digests are not those the sums were made from; bounded by the
    number of dates."""
    now, seen = _read(spark, f"{clean}/digests", DIGEST), _read(spark, f"{out_dir}/seen", DIGEST)
    different = now.exceptAll(seen).unionByName(seen.exceptAll(now)).select(DATE).distinct()
    return sorted((r[0] for r in different.collect()), key=lambda d: (d is not None, d))


def _among(column: str, days: list) -> Column:
    some = F.col(column).isin([d for d in days if d is not None])
    return some | F.col(column).isNull() if None in days else some


def clean_rows(spark: SparkSession, clean: str, days: list | None = None) -> DataFrame:
    """The clean rows, of some dates only: other folders are not read."""
    rows = _read(spark, f"{clean}/rows", StructType([*LEDGER.fields, StructField(DATE, DateType())]))
    return rows if days is None else rows.filter(_among(DATE, days))


def _replace(spark: SparkSession, df: DataFrame, path: str, days: list) -> None:
    """Replace the partitions ``days`` of a table of sums by those of ``df``; a day
    without rows loses its folder."""
    kept = stored(df, "sums")
    have = {r[0] for r in kept.select("date_from").distinct().collect()}
    write_partitioned(kept, path, "date_from", cluster_by=("login",))
    for day in set(days) - have:
        store, folder = _folder(spark, f"{path}/date_from={day.isoformat() if day else '__HIVE_DEFAULT_PARTITION__'}")
        store.delete(folder, True)


def refresh(spark: SparkSession, clean: str, out_dir: str) -> Refreshed:
    """Bring the daily, monthly and total sums of ``out_dir`` up to date with the clean
    table written by ``write_dates``. The digests are noted last, so a run that failed
    is made good by the next."""
    out = out_dir.rstrip("/")
    days = changed_dates(spark, clean, out)
    months = sorted({d.replace(day=1) if d else None for d in days}, key=lambda d: (d is not None, d))
    done = Refreshed(f"{out}/daily", f"{out}/monthly", f"{out}/total", tuple(days), tuple(months))
    if not days:
        return done
    with scratch(spark):
        noted = stored(_read(spark, f"{clean}/digests", DIGEST), "seen")
        daily = agg.daily_agg(agg.signed_amounts(clean_rows(spark, clean, days)), calculation_ts=False)
        _replace(spark, daily, done.daily, days)
        in_months = [F.col("date_from").between(m, F.last_day(F.lit(m))) if m else F.col("date_from").isNull() for m in months]
        some = in_months[0]
        for one in in_months[1:]:
            some = some | one
        monthly, _ = agg.rollup_from_daily(_read(spark, done.daily, DAILY).filter(some), calculation_ts=False)
        _replace(spark, monthly, done.monthly, months)
        total = _read(spark, done.monthly, MONTHLY).groupBy("login").agg(F.expr("CAST(sum(monthly_sum) AS DECIMAL(38,4)) AS total_sum"))
        total.write.mode("overwrite").parquet(done.total)
        noted.coalesce(1).write.mode("overwrite").parquet(f"{out}/seen")
    return done
