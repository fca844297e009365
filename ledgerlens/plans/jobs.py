"""End-to-end jobs: reconcile two sources into a clean table, then signed sums.

Each stage reads what the previous stage wrote, so a lost executor only costs
the tasks of the running stage, never a recomputation of the whole chain, and
no stage holds more than one join in its lineage.

Reconciliation writes every pair once, with its status (and, for the
multi-rule variant, every accepting rule), partitioned by status; the clean
table is then a partition-pruned read of the accepted statuses, written
partitioned by transaction date. Both are replaced as a whole by each run. Aggregates add one calculation to history
tables partitioned by calculation and ``date_from`` (so ``latest_aggregates``
can pick the newest calculation per key, and a rerun of a calculation
replaces it); monthly and total sums are rolled up from the daily rows of the
same calculation instead of rescanning transactions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ledgerlens.config import Tolerances
from ledgerlens.operators import aggregates as agg
from ledgerlens.operators import checks
from ledgerlens.operators import reconcile as rec
from ledgerlens.schemas import LEDGER, MAX_LENGTH, NOT_NULL
from ledgerlens.session import scratch
from ledgerlens.sources.sinks import write_partitioned


@dataclass(frozen=True)
class ReconcileOutput:
    pairs: str
    clean: str
    checks: Mapping[str, int] = field(default_factory=dict)


def pair_checks() -> list:
    """What the write of the pairs counts as it goes: rows, rows by status, and for
    each source (first:, second:) its rows with a NULL or an over-long text."""
    statuses = (*rec.ACCEPTED, rec.UNRECONCILED, rec.LEFT_ONLY, rec.RIGHT_ONLY)
    counts = [F.expr("count(1)").alias("rows"), *checks.metrics(groups={"status": statuses})]
    # The compared rows hold the time as unix_timestamp.
    required = ["unix_timestamp" if c == "transaction_ts" else c for c in NOT_NULL["ledger"]]
    for side, suffix, absent in (("first:", "", rec.RIGHT_ONLY), ("second:", rec.SUFFIX, rec.LEFT_ONLY)):
        limits = {c + suffix: n for c, n in MAX_LENGTH["ledger"].items()}
        counts += checks.metrics([c + suffix for c in required], limits, where=f"status <> '{absent}'", prefix=side)
    return counts


def reconcile(
    spark: SparkSession,
    ledger: DataFrame,
    second: DataFrame,
    out_dir: str,
    tol: Tolerances | None = None,
    multi: bool = False,
    null_token: str | None = None,
) -> ReconcileOutput:
    """Pair, classify and write; returns the paths of the pairs and clean tables.

    The pairs table holds both sides' values of every pair, matched or not. The
    output's ``checks`` (``pair_checks``) are counted by the tasks that write it,
    each partition once, without a further scan; K1 stays a query of its own.
    ``null_token`` marks NULLs in the row hashes of both sources."""
    tol = tol or Tolerances()
    out = ReconcileOutput(pairs=f"{out_dir.rstrip('/')}/pairs", clean=f"{out_dir.rstrip('/')}/clean")
    first, other = rec.load_ledger(ledger, null_token=null_token), rec.load_second_source(second, null_token=null_token)
    with scratch(spark):  # the tables of the pairing go once the pairs are written
        paired = rec.pair_sources(first, other, how="full", tol=tol)
        classified = paired.selectExpr(
            *rec.TRANSACTION_COLUMNS,
            *(c + rec.SUFFIX for c in rec.TRANSACTION_COLUMNS),
            f"{rec.status_sql(tol)} AS status",
            f"{rec.passed_statuses_sql(tol)} AS passed",
        )
        seen = Observation("pairs")
        write_partitioned(classified.observe(seen, *pair_checks()), out.pairs, "status", dynamic=False)  # a full report per run

    pairs = spark.read.parquet(out.pairs)
    accepted = pairs.filter(F.col("status").isin(*rec.ACCEPTED))
    if multi:
        accepted = accepted.selectExpr("*", "explode(passed) AS rule")
    clean = accepted.selectExpr(*rec.CLEAN_SELECT)
    write_partitioned(clean, out.clean, "transaction_date", "to_date(transaction_ts)", cluster_by=("transaction_uid",), dynamic=False)
    return ReconcileOutput(out.pairs, out.clean, dict(seen.get))


def read_clean(spark: SparkSession, clean_path: str) -> DataFrame:
    """The clean table, also when no row was accepted (it has no files then)."""
    stored = StructType([*LEDGER.fields, StructField("transaction_date", DateType())])
    return spark.read.schema(stored).parquet(clean_path).drop("transaction_date")


@dataclass(frozen=True)
class AggregateOutput:
    daily: str
    monthly: str
    total: str
    calculation_ts: dt.datetime

    @property
    def calc_id(self) -> str:
        return self.calculation_ts.strftime("%Y%m%dT%H%M%S%f")


def _write_calculation(df: DataFrame, path: str, partition_cols: tuple[str, ...]) -> None:
    """Write one calculation; a re-run of the same calculation replaces its
    own partitions (dynamic overwrite) and leaves other calculations alone.
    Rows are ranged by (partition, login) first: few files for each partition,
    and a large one is split over several tasks."""
    (
        df.repartitionByRange(*partition_cols, "login")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def read_calculation(spark: SparkSession, path: str, calc_id: str) -> DataFrame:
    """One calculation of a history table: only its own folder is listed."""
    return spark.read.option("basePath", path).parquet(f"{path}/calc_id={calc_id}")


def aggregates(spark: SparkSession, clean: DataFrame, out_dir: str, calculation_ts: dt.datetime | None = None) -> AggregateOutput:
    """Add one calculation of daily, monthly and total signed sums to the history.

    Each history table is partitioned by ``calc_id`` (the calculation time as
    text) and, for daily and monthly sums, ``date_from``; rerunning a
    calculation after a failure rewrites exactly its own partitions.
    """
    calc = calculation_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    base = out_dir.rstrip("/")
    out = AggregateOutput(f"{base}/daily", f"{base}/monthly", f"{base}/total", calc)
    calc_id = out.calc_id
    tag = F.lit(calc_id).alias("calc_id")

    daily = agg.daily_agg(agg.signed_amounts(clean), calculation_ts=calc)
    _write_calculation(daily.select("*", tag), out.daily, ("calc_id", "date_from"))

    this_run = read_calculation(spark, out.daily, calc_id)
    monthly, total = agg.rollup_from_daily(this_run.drop("calculation_ts", "calc_id"), calculation_ts=calc)
    _write_calculation(monthly.select("*", tag), out.monthly, ("calc_id", "date_from"))
    _write_calculation(total.select("*", tag), out.total, ("calc_id",))
    return out
