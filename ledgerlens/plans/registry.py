"""Named queries over the test tables: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables: lazy, but for queries that pair sources (one small job finds out
whether keys repeat) and those of the file layouts (s3, s5 - s8; w1, w2), which write
their tables first. Parameters are fixed here and mirrored by ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.config import Tolerances
from ledgerlens.operators import aggregates as agg
from ledgerlens.operators import checks, deposits
from ledgerlens.operators import reconcile as rec
from ledgerlens.plans import jobs
from ledgerlens.plans import oracle as o
from ledgerlens.schemas import MONEY
from ledgerlens.session import apply_plan_settings, apply_required, scratch_path
from ledgerlens.sources import append, files, jdbc, sinks
from ledgerlens.sources import views as v

Query = Callable[[SparkSession, str], DataFrame]

TOL = Tolerances(percent=o.TOL_PERCENT, levenshtein=o.TOL_LEVENSHTEIN, seconds=o.TOL_SECONDS)

QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_required(spark)
            apply_plan_settings(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return register


def _first(spark, sf):
    return rec.load_ledger(v.ledger(spark, sf))


def _second(spark, sf):
    return rec.load_second_source(v.second_source(spark, sf))


def _paired(spark, sf, how="full", tol=TOL):
    return rec.pair_sources(_first(spark, sf), _second(spark, sf), how=how, tol=tol)


def _clean(spark, sf, multi=False):
    return rec.clean_transactions(_first(spark, sf), _second(spark, sf), TOL, multi=multi)


def _repeating(spark, sf):
    return rec.load_ledger(v.repeating_ledger(spark, sf)), rec.load_second_source(v.repeating_second_source(spark, sf))


def _paired_repeating(spark, sf, how="full", tol=TOL):
    return rec.pair_sources(*_repeating(spark, sf), how=how, tol=tol)


def _signed(spark, sf):
    return agg.signed_amounts(_clean(spark, sf))


@query("c1_first_deposit_funnel")
def c1(spark, sf):
    return deposits.first_deposit_funnel(
        v.users(spark, sf), v.logins(spark, sf), v.operations(spark, sf),
        first_trades=v.first_trades(spark, sf), as_of=o.AS_OF, days=o.FUNNEL_DAYS,
    )


@query("c2_high_avg_deposit_by_country")
def c2(spark, sf):
    return deposits.high_avg_deposit_by_country(
        v.users(spark, sf), v.logins(spark, sf), v.operations(spark, sf), threshold=o.HIGH_AVG_THRESHOLD
    )


@query("c3_first_n_deposits")
def c3(spark, sf):
    return deposits.first_n_deposits(v.users(spark, sf), v.logins(spark, sf), v.operations(spark, sf), n=o.FIRST_N)


@query("c4_row_hash")
def c4(spark, sf):
    return rec.with_row_hash(v.operations(spark, sf))


@query("c5_load_ledger")
def c5(spark, sf):
    return _first(spark, sf)


@query("c6_load_second_source")
def c6(spark, sf):
    return _second(spark, sf)


@query("c7_pair_sources")
def c7(spark, sf):
    return _paired(spark, sf)


@query("c8_exact_matches")
def c8(spark, sf):
    return rec.exact_matches(_paired(spark, sf))


@query("c9_char_rec")
def c9(spark, sf):
    return rec.char_rec(_paired(spark, sf), 1)


@query("c9_char_rec_tol2")
def c9b(spark, sf):
    return rec.char_rec(_paired(spark, sf, tol=replace(TOL, levenshtein=2)), 2)


@query("c10_date_rec")
def c10(spark, sf):
    return rec.date_rec(_paired(spark, sf), 300)


@query("c10_date_rec_symmetric")
def c10b(spark, sf):
    return rec.date_rec(_paired(spark, sf), 300, symmetric=True)


@query("c11_int_rec")
def c11(spark, sf):
    return rec.int_rec(_paired(spark, sf), 5)


@query("c12_clean_transactions")
def c12(spark, sf):
    return _clean(spark, sf)


@query("c12_clean_transactions_multi")
def c12b(spark, sf):
    return _clean(spark, sf, multi=True)


@query("c13_signed_amounts")
def c13(spark, sf):
    return _signed(spark, sf)


@query("c14_daily_agg")
def c14(spark, sf):
    return agg.daily_agg(_signed(spark, sf), calculation_ts=o.HISTORY_TS_2)


@query("c15_monthly_agg")
def c15(spark, sf):
    return agg.monthly_agg(_signed(spark, sf), calculation_ts=o.HISTORY_TS_2)


@query("c16_total_agg")
def c16(spark, sf):
    return agg.total_agg(_signed(spark, sf), calculation_ts=o.HISTORY_TS_2)


TOL2 = replace(TOL, levenshtein=2)


@query("c7_pair_repeating_keys")
def c7r(spark, sf):
    return _paired_repeating(spark, sf)


@query("c9_char_rec_repeating_keys")
def c9r(spark, sf):
    return rec.char_rec(_paired_repeating(spark, sf, tol=TOL2), 2)


@query("c10_date_rec_repeating_keys")
def c10r(spark, sf):
    return rec.date_rec(_paired_repeating(spark, sf), 300)


@query("c11_int_rec_repeating_keys")
def c11r(spark, sf):
    return rec.int_rec(_paired_repeating(spark, sf), 5)


@query("c12_clean_repeating_keys")
def c12r(spark, sf):
    return rec.clean_transactions(*_repeating(spark, sf), TOL)


@query("c17_report_repeating_keys")
def c17r(spark, sf):
    return rec.reconciliation_report(_paired_repeating(spark, sf), TOL)


SCARCE = Tolerances(percent=o.SCARCE_PERCENT, levenshtein=o.SCARCE_EDITS, seconds=o.SCARCE_SECONDS, char_inclusive=True, symmetric_time=True)


@query("c17_surplus_rows_by_key")
def c17s(spark, sf):
    """Pairs by status for each key where one source has surplus rows: as many
    are accepted as can be, whichever rows those are."""
    first, second = rec.load_ledger(v.surplus_ledger(spark, sf)), rec.load_second_source(v.surplus_second_source(spark, sf))
    report = rec.reconciliation_report(rec.pair_sources(first, second, tol=SCARCE), SCARCE)
    counts = [f"count_if(status = '{s}') AS {s}" for s in rec.STATUSES]
    return report.groupBy(F.expr("coalesce(transaction_uid, transaction_uid_2) AS transaction_uid")).agg(*map(F.expr, counts))


@query("c17_reconciliation_report")
def c17(spark, sf):
    return rec.reconciliation_report(_paired(spark, sf), TOL)


@query("c17_reconciliation_summary")
def c17b(spark, sf):
    return rec.reconciliation_summary(rec.reconciliation_report(_paired(spark, sf), TOL))


@query("k_checks_while_writing")
def k_write(spark, sf):
    """What ``jobs.reconcile`` counted as it wrote the pairs: K2, K3, rows by status."""
    out = jobs.reconcile(spark, v.ledger(spark, sf), v.second_source(spark, sf), scratch_path(spark, "k-reconciled"), TOL)
    return spark.createDataFrame(sorted(out.checks.items()), "rule string, n long")


@query("c18_latest_aggregates")
def c18(spark, sf):
    before = agg.daily_agg(agg.signed_amounts(v.ledger(spark, sf)), calculation_ts=o.HISTORY_TS_1)
    after = agg.daily_agg(_signed(spark, sf), calculation_ts=o.HISTORY_TS_2)
    return agg.latest_aggregates(before.unionByName(after), ["login", "date_from"])


@query("k1_duplicate_keys")
def k1(spark, sf):
    return checks.duplicate_keys(v.operations(spark, sf), ["login", "operation_date"])


@query("k2_null_counts")
def k2(spark, sf):
    cols = ["login", "counter_login", "transaction_type", "epoch_seconds", "comment"]
    return checks.null_counts(v.second_source(spark, sf), cols)


@query("k2_not_null_violations")
def k2b(spark, sf):
    return checks.not_null_violations(v.second_source(spark, sf), ["counter_login", "comment"])


@query("k3_over_length")
def k3(spark, sf):
    return checks.over_length(v.users(spark, sf), {"country": o.COUNTRY_LENGTH, "first_name": 80}, keys=["uid"])


@query("k_constraint_report_users")
def k_users(spark, sf):
    from ledgerlens import schemas

    return checks.constraint_report(
        v.users(spark, sf), keys=schemas.PRIMARY_KEYS["users"], not_null=["uid", "country"],
        max_length=schemas.MAX_LENGTH["users"],
    )


@query("k_constraint_report_ledger")
def k_ledger(spark, sf):
    from ledgerlens import schemas

    return checks.constraint_report(
        v.ledger(spark, sf), keys=schemas.PRIMARY_KEYS["ledger"], not_null=schemas.NOT_NULL["ledger"],
        max_length=schemas.MAX_LENGTH["ledger"],
    )


@query("k4_fill_default_timestamp")
def k4(spark, sf):
    return checks.fill_default_timestamp(v.ledger(spark, sf), "transaction_ts", o.DEFAULT_TS)


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _table_name(path: str) -> str:
    return "ll_" + path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")


@query("s3_csv_second_source")
def s3(spark, sf):
    """The second source written as headerless CSV and loaded back from it."""
    path = scratch_path(spark, "s3-second-source-csv")
    files.write_source_csv(v.second_source(spark, sf), path)
    return rec.load_second_source(files.read_source_csv(spark, path))


@query("s1_split_ranges")
def s1(spark, sf):
    """The ledger by the time ranges of a parallel read: rows, those in exactly one
    range, and whether the largest range is near an equal share."""
    ledger = v.ledger(spark, sf)
    ranges = jdbc.split_predicates(ledger, "transaction_ts", o.SPLITS)
    hits = " + ".join(f"CAST(coalesce({p}, false) AS INT)" for p in ranges)
    largest = "greatest(" + ", ".join(f"count_if({p})" for p in ranges) + ", 0L)"
    return ledger.selectExpr(
        "count(1) AS rows_read", f"count_if({hits} = 1) AS in_one_range",
        f"{largest} * {o.SPLITS} <= 2 * count(1) + count_if(transaction_ts IS NULL) * {o.SPLITS} AS level",
    )


@query("s5_guarded_append")
def s5(spark, sf):
    """The ledger delivered twice: its rows until a day, then all of it with some
    amounts restated. Rows of the target, and the restated ones that clash."""
    whole = v.ledger(spark, sf).withColumn("transaction_date", F.expr("to_date(transaction_ts)"))
    early = whole.filter(f"transaction_ts < TIMESTAMP_NTZ'{o.DELIVERY_TS}'")
    restated = whole.withColumn("amount", F.expr(f"CAST(CASE WHEN transaction_uid % {o.RESTATED} = 0 THEN amount + 1 ELSE amount END AS {MONEY.simpleString()})"))
    path = scratch_path(spark, "s5-ledger")
    append.guarded_append(early, path, "transaction_date", ["transaction_uid"])
    done = append.guarded_append(restated, path, "transaction_date", ["transaction_uid"])
    stored = append.read_appended(spark, path, whole.schema).withColumn("state", F.lit("stored"))
    return stored.unionByName(spark.read.schema(whole.schema).parquet(done.clashes).withColumn("state", F.lit("clash")))


@query("s6_partitioned_clean")
def s6(spark, sf):
    """Clean rows written partitioned by date, read back for a date range."""
    path = scratch_path(spark, "s6-clean-by-date")
    sinks.write_partitioned(_clean(spark, sf), path, "transaction_date", "to_date(transaction_ts)",
                            cluster_by=("transaction_uid",))
    lo, hi = o.PARTITION_RANGE
    return sinks.read_partitioned(spark, path).filter(
        f"transaction_date BETWEEN DATE'{lo}' AND DATE'{hi}'"
    )


@query("s7_bucketed_reconciliation")
def s7(spark, sf):
    """Status counts over both sources stored bucketed by transaction_uid."""
    n = _buckets(spark)
    p1, p2 = scratch_path(spark, "s7-first"), scratch_path(spark, "s7-second")
    first = sinks.write_bucketed(_first(spark, sf), _table_name(p1), p1, "transaction_uid", n)
    second = sinks.write_bucketed(_second(spark, sf), _table_name(p2), p2, "transaction_uid_2", n)
    return rec.reconciliation_summary(rec.reconciliation_report(rec.pair_sources(first, second, tol=TOL), TOL))


@query("s8_join_copies")
def s8(spark, sf):
    """C2 over copies of operations and logins both bucketed by login."""
    n = _buckets(spark)
    p1, p2 = scratch_path(spark, "s8-operations-by-login"), scratch_path(spark, "s8-logins-by-login")
    ops = sinks.write_copy(v.operations(spark, sf), _table_name(p1), p1, "login", n,
                           ["operation_uid", "operation_type", "operation_date", "login", "amount"])
    logins = sinks.write_copy(v.logins(spark, sf), _table_name(p2), p2, "login", n,
                              ["user_uid", "login", "account_type"])
    return deposits.high_avg_deposit_by_country(v.users(spark, sf), logins, ops, threshold=o.HIGH_AVG_THRESHOLD)


@query("s8_logins_by_user")
def s8b(spark, sf):
    """Logins of each type per country, over a copy of the logins and one of the
    users that are both bucketed by the user."""
    n = _buckets(spark)
    p1, p2 = scratch_path(spark, "s8-logins-by-user"), scratch_path(spark, "s8-users-by-uid")
    logins = sinks.write_copy(v.logins(spark, sf), _table_name(p1), p1, "user_uid", n, ["user_uid", "login", "account_type"])
    users = sinks.write_copy(v.users(spark, sf), _table_name(p2), p2, "uid", n, ["uid", "country"])
    owned = users.join(logins, F.expr("uid = user_uid"))
    return owned.groupBy("country", "account_type").agg(F.expr("count(login) AS logins"))
