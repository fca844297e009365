"""Plan shapes the design relies on."""

import contextlib
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import reconcile as rec
from ledgerlens.plans import inspect, primitives  # noqa: F401  (registers the single-operator queries)
from ledgerlens.plans.registry import QUERIES


def q(spark, name):
    return QUERIES[name](spark, SF_SMALL)


@contextlib.contextmanager
def no_broadcast(spark):
    """Plan as at scale: no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_unique_keys_pair_in_one_join(spark):
    """Where no key repeats, one join over two exchanges decides all rules."""
    for name, kind in (("c12_clean_transactions", "Inner"), ("c12_clean_transactions_multi", "Inner"), ("c17_reconciliation_report", "FullOuter")):
        with no_broadcast(spark):
            df = q(spark, name)
            joins, shuffles = inspect.joins(df), inspect.exchanges(df)
            text = inspect.plan_text(df, "simple")
        assert len(joins) == 1 and len(shuffles) == 2, (name, joins, shuffles)
        assert re.findall(r"SortMergeJoin \[transaction_uid#\d+L\], \[transaction_uid_2#\d+L\], (\w+)", text) == [kind]
        assert "Window" not in text


def test_first_and_latest_rows_hash_aggregate(spark):
    for name in ("c1_first_deposit_funnel", "c18_latest_aggregates"):
        text = inspect.plan_text(q(spark, name), "simple")
        assert "HashAggregate" in text and "SortAggregate" not in text, name


def test_full_outer_is_one_salted_join(spark):
    with no_broadcast(spark):
        df = q(spark, "j3_full_outer")
        text = inspect.plan_text(df, "simple")
        assert len(re.findall(r"SortMergeJoin \[\w+#\d+L, _salt_1#\d+L\], \[\w+#\d+L, _salt_2#\d+L\], FullOuter", text)) == 1
        assert "LeftAnti" not in text and len(re.findall("FileScan parquet", text)) == 2


def test_ranks_are_split_within_a_user(spark):
    for name in ("w1_row_number", "w2_rank"):
        text = inspect.plan_text(q(spark, name), "simple")
        assert re.search(r"windowspecdefinition\(uid#\d+L, _range#\d+", text), name


def test_first_n_uses_partial_group_limit(spark):
    text = inspect.plan_text(q(spark, "c3_first_n_deposits"), "simple")
    assert text.count("WindowGroupLimit") >= 2
    assert "Partial" in text


def test_aggregates_are_partial_then_final(spark):
    text = inspect.plan_text(q(spark, "c14_daily_agg"), "simple")
    assert len(re.findall(r"HashAggregate", text)) >= 2


def test_scans_read_only_needed_columns(spark):
    schemas = inspect.read_schemas(q(spark, "c5_load_ledger"))
    assert schemas and all("props" not in s for s in schemas)
    schemas = inspect.read_schemas(q(spark, "c3_first_n_deposits"))
    assert all("o_totalprice" not in s and "c_name" not in s for s in schemas)


def test_trades_filter_reaches_the_scan(spark):
    text = inspect.plan_text(q(spark, "c1_first_deposit_funnel"), "formatted")
    assert re.search(r"PushedFilters: \[[^\]]*Not\(EqualTo\(o_orderstatus,P\)\)", text)


def test_bucketed_sources_pair_without_shuffling(spark):
    with no_broadcast(spark):
        ex = inspect.exchanges(q(spark, "s7_bucketed_reconciliation"))
    assert not [e for e in ex if "hashpartitioning(transaction_uid" in e]


def test_users_copy_joins_without_shuffle(spark):
    with no_broadcast(spark):
        ex = inspect.exchanges(q(spark, "s8_logins_by_user"))
    assert not [e for e in ex if "hashpartitioning(uid" in e or "hashpartitioning(user_uid" in e]


def test_bucketed_copies_join_without_shuffle_on_login(spark):
    with no_broadcast(spark):
        ex = inspect.exchanges(q(spark, "s8_join_copies"))
    assert not [e for e in ex if "hashpartitioning(login" in e]


def test_partitioned_read_prunes_folders(spark):
    text = inspect.plan_text(q(spark, "s6_partitioned_clean"), "simple")
    m = re.search(r"PartitionFilters: \[([^\]]*)\]", text)
    assert m and "transaction_date" in m.group(1)


def test_first_trade_is_reduced_per_order_before_the_join(spark):
    with no_broadcast(spark):
        text = inspect.plan_text(q(spark, "c1_first_deposit_funnel"), "simple")
    lines = text.splitlines()
    join = next(i for i, l in enumerate(lines) if "SortMergeJoin [l_orderkey" in l)
    below = "\n".join(lines[join:])
    # the line items reach the join as one row per order (partial + final min)
    assert "partial_min(l_shipdate" in below and "functions=[min(l_shipdate" in below


def _hot_sources(spark):
    cols = "transaction_uid long, login long, counter_login long, transaction_type long, epoch_seconds long, comment string, amount decimal(18,4)"

    def rows(side, hot, lone):
        some = [(k, side, None, 1, 0, "c", None) for k in range(50)] + [(None, side, None, 1, k, "n", None) for k in range(40)]
        some += [(-1, side, None, 1, k % 3, "hot", None) for k in range(hot)] + [(-2, side, None, 1, k, "other", None) for k in range(9 * side)]
        return spark.createDataFrame(some + [(-9 - side, side, None, 1, 0, "one side", None)] * lone, cols)

    left, right = rows(1, 400, 300), rows(2, 7, 200)
    first = rec.load_ledger(left.selectExpr("*", "CAST(timestamp_seconds(epoch_seconds) AS TIMESTAMP_NTZ) AS transaction_ts"))
    return first, rec.load_second_source(right)


def test_full_outer_join_scans_once_and_spreads_heavy_keys(spark, tmp_dir, monkeypatch):
    from collections import Counter

    monkeypatch.setattr(rec, "HEAVY_ROWS", 20)
    for k, df in enumerate(_hot_sources(spark)):
        df.write.parquet(f"{tmp_dir}/{k}")
    first, second = (spark.read.parquet(f"{tmp_dir}/{k}") for k in range(2))
    assert rec.heavy_keys(first, second) == [(-11, 0, 200), (-10, 300, 0), (-1, 400, 7)]
    joined = rec.full_outer_spread(first, second)
    assert inspect.count(joined, "FileScan parquet") == 2
    plain = first.join(second, F.expr("transaction_uid = transaction_uid_2"), "full")
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for kind in ("transaction_uid = -1", "transaction_uid IS NULL AND transaction_uid_2 IS NULL", "transaction_uid = -10", "transaction_uid_2 = -11"):
            sizes = [r["count"] for r in joined.filter(kind).groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) > 3 and max(sizes) <= 5 * sorted(sizes)[len(sizes) // 2], (kind, sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_full_outer_join_without_heavy_keys(spark):
    from collections import Counter

    first, second = _hot_sources(spark)
    assert rec.heavy_keys(first, second) == []
    plain = first.join(second, F.expr("transaction_uid = transaction_uid_2"), "full")
    for other in (rec.full_outer_spread(first, second), rec.pair_sources(first, second, one_to_one=False)):
        assert Counter(map(tuple, other.collect())) == Counter(map(tuple, plain.collect()))
    empty = rec.full_outer_spread(first.filter("false"), second.filter("false"))
    assert empty.count() == 0
