"""Split predicates of parallel reads, and checks counted by the pass that writes."""

import datetime as dt

import pytest

from conftest import SF_SMALL
from ledgerlens.operators import reconcile as rec
from ledgerlens.plans import jobs
from ledgerlens.sources import jdbc
from ledgerlens.sources import views as v


def counts(df, predicates):
    """Rows by predicate, and rows that meet any number of them but one."""
    own = [f"count_if({p})" for p in predicates]
    hits = " + ".join(f"CAST(coalesce({p}, false) AS INT)" for p in predicates)
    row = df.selectExpr(*own, f"count_if({hits} <> 1)").first()
    return list(row)[:-1], row[-1]


@pytest.mark.parametrize("column", ["transaction_uid", "transaction_ts", "amount", "CAST(transaction_ts AS DATE)"])
def test_ranges_cover_every_row_once(spark, column):
    ledger = v.ledger(spark, SF_SMALL).selectExpr(f"{column} AS c").union(spark.sql("SELECT NULL FROM range(7)"))
    predicates = jdbc.split_predicates(ledger, "c", 8)
    by_range, others = counts(ledger, predicates)
    assert others == 0 and sum(by_range) == ledger.count()
    assert 1 < len(predicates) <= 8


def test_ranges_are_of_equal_height_where_values_crowd(spark):
    crowded = spark.range(10_000).selectExpr("TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, pow(id, 3) / 1e6) AS c")
    by_range, others = counts(crowded, jdbc.split_predicates(crowded, "c", 10))
    assert others == 0 and len(by_range) == 10 and max(by_range) < 1.1 * min(by_range)


def test_rows_that_the_sketch_has_not_seen_are_read_too(spark):
    known = spark.createDataFrame([(dt.date(2020, 1, d),) for d in range(1, 29)], "c date")
    later = spark.createDataFrame([(dt.date(1999, 1, 1),), (dt.date(2031, 5, 5),), (None,)], "c date")
    assert counts(later, jdbc.split_predicates(known, "c", 5))[1] == 0


def test_ties_empty_columns_and_texts(spark):
    same = spark.range(100).selectExpr("5 AS c")
    assert counts(same, jdbc.split_predicates(same, "c", 9)) == ([0, 100], 0)
    assert jdbc.split_predicates(spark.createDataFrame([], "c int"), "c", 4) == ["1 = 1"]
    assert jdbc.split_predicates(same, "c", 1) == ["1 = 1"]
    with pytest.raises(ValueError):
        jdbc.split_predicates(spark.sql("SELECT 'x' AS c"), "c", 4)
    with pytest.raises(ValueError):
        jdbc.split_predicates(same, "c", 0)


def test_the_write_counts_its_checks(spark, tmp_dir):
    out = jobs.reconcile(spark, v.ledger(spark, SF_SMALL), v.second_source(spark, SF_SMALL), f"{tmp_dir}/checks")
    pairs = spark.read.parquet(out.pairs)
    by_status = {r["status"]: r["count"] for r in pairs.groupBy("status").count().collect()}
    assert out.checks["rows"] == sum(by_status.values()) == pairs.count()
    assert {k.removeprefix("status:"): n for k, n in out.checks.items() if k.startswith("status:") and n} == by_status
    nulls = {
        f"{side}nulls:{c}{suffix}": pairs.filter(f"status <> '{absent}' AND {c}{suffix} IS NULL").count()
        for side, suffix, absent in (("first:", "", rec.RIGHT_ONLY), ("second:", rec.SUFFIX, rec.LEFT_ONLY))
        for c in ("login", "transaction_type", "unix_timestamp")
    }
    assert nulls == {k: n for k, n in out.checks.items() if "nulls:" in k}
    assert sum(nulls.values()) > 0
    assert out.checks["first:long:comment"] == 0


def test_checks_are_no_scan_of_their_own(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").selectExpr("'exact' AS status", *(f"CAST(NULL AS STRING) AS {c}{s}" for s in ("", rec.SUFFIX) for c in ("login", "transaction_type", "unix_timestamp", "comment")))
    plan = rows.observe("checks", *jobs.pair_checks())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
