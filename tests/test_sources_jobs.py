"""Sources, sinks, end-to-end jobs and the streaming sums."""

import datetime as dt
from decimal import Decimal

import pytest

from conftest import SF_SMALL
from ledgerlens.config import Tolerances
from ledgerlens.operators import aggregates as agg
from ledgerlens.operators import matching
from ledgerlens.operators import reconcile as rec
from ledgerlens.plans import jobs
from ledgerlens.sources import catalog, files, jdbc
from ledgerlens.sources import views as v
from ledgerlens.streaming import signed_sums


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_round_trip_keeps_values(spark, tmp_dir):
    src = v.second_source(spark, SF_SMALL)
    files.write_source_csv(src, f"{tmp_dir}/csv")
    back = files.read_source_csv(spark, f"{tmp_dir}/csv")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in src.schema]
    expected = src.selectExpr(*[("coalesce(comment, '') AS comment" if c == "comment" else c) for c in src.columns])
    assert rows(back) == rows(expected)


def test_parquet_reader_with_schema(spark, tmp_dir):
    from ledgerlens.schemas import SECOND_SOURCE

    v.second_source(spark, SF_SMALL).write.parquet(f"{tmp_dir}/p")
    df = files.read_parquet(spark, f"{tmp_dir}/p", SECOND_SOURCE)
    assert df.schema == SECOND_SOURCE and df.count() == v.second_source(spark, SF_SMALL).count()


def test_jdbc_options_validate_split():
    opts = jdbc.jdbc_read_options("jdbc:x", "bank.tb_transactions", {"user": "u"}, "transaction_uid", 0, 1000, 16)
    assert opts["partitionColumn"] == "transaction_uid" and opts["numPartitions"] == "16" and opts["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.jdbc_read_options("jdbc:x", "t", partition_column="id")
    w = jdbc.jdbc_write_options("jdbc:x", "t", num_partitions=8)
    assert w["numPartitions"] == "8" and w["batchsize"] == "10000"


def test_create_schemas_is_idempotent(spark, tmp_dir):
    first = catalog.create_schemas(spark, root=f"{tmp_dir}/tables")
    again = catalog.create_schemas(spark, root=f"{tmp_dir}/tables")
    assert first == again and "bank.tb_transactions_clean" in first
    assert spark.table("bank.tb_daily_agg").schema.fieldNames() == ["login", "date_from", "daily_sum", "calculation_ts"]


def test_row_hash_null_token_separates_null_positions(spark):
    df = spark.createDataFrame([(1, None, -1), (1, -1, None)], "a long, b long, c long")
    plain = {r.h for r in rec.with_row_hash(df, ["a", "b", "c"], "h").collect()}
    marked = {r.h for r in rec.with_row_hash(df, ["a", "b", "c"], "h", null_token="\\N").collect()}
    assert len(plain) == 1 and len(marked) == 2


def test_duplicate_keys_pair_one_to_one(spark):
    left = spark.createDataFrame(
        [(7, 1, None, 1, 100, "a", Decimal("1"))] * 3, "transaction_uid long, login long, counter_login long, "
        "transaction_type long, transaction_ts long, comment string, amount decimal(18,4)"
    ).selectExpr("*", "CAST(timestamp_seconds(transaction_ts) AS TIMESTAMP_NTZ) AS ts").drop("transaction_ts")
    first = rec.load_ledger(left, ts_col="ts")
    second = rec.load_second_source(
        left.selectExpr("transaction_uid", "login", "counter_login", "transaction_type",
                        "unix_timestamp(ts) AS epoch_seconds", "comment", "amount").limit(2)
    )
    report = rec.reconciliation_report(rec.pair_sources(first, second), Tolerances())
    got = sorted(r.status for r in report.collect())
    assert got == ["exact", "exact", "left_only"]  # 3 x 2 rows -> 3 pairs, not 6
    all_pairs = rec.pair_sources(first, second, one_to_one=False)
    assert all_pairs.count() == 6


def test_reconcile_and_aggregate_jobs(spark, tmp_dir):
    tol = Tolerances()
    out = jobs.reconcile(spark, v.ledger(spark, SF_SMALL), v.second_source(spark, SF_SMALL), f"{tmp_dir}/rec", tol)
    clean = jobs.read_clean(spark, out.clean)
    direct = rec.clean_transactions(
        rec.load_ledger(v.ledger(spark, SF_SMALL)), rec.load_second_source(v.second_source(spark, SF_SMALL)), tol
    )
    assert rows(clean.select(*rec.CLEAN_COLUMNS)) == rows(direct)
    pairs = spark.read.parquet(out.pairs)
    n_left = v.ledger(spark, SF_SMALL).count()
    n_right = v.second_source(spark, SF_SMALL).count()
    statuses = {r.status: r.n for r in pairs.groupBy("status").count().withColumnRenamed("count", "n").collect()}
    # every source row sits in exactly one pair
    assert sum(statuses.values()) - statuses.get("right_only", 0) == n_left
    assert sum(statuses.values()) - statuses.get("left_only", 0) == n_right

    calc = dt.datetime(2024, 3, 1, 0, 0, 0)
    a = jobs.aggregates(spark, clean, f"{tmp_dir}/agg", calc)
    daily = spark.read.parquet(a.daily)
    monthly = spark.read.parquet(a.monthly)
    total = spark.read.parquet(a.total)
    s = lambda df, c: df.agg({c: "sum"}).collect()[0][0]
    assert s(daily, "daily_sum") == s(monthly, "monthly_sum") == s(total, "total_sum")
    assert rows(daily.select("login", "date_from", "daily_sum")) == rows(
        agg.daily_agg(agg.signed_amounts(direct), calculation_ts=False)
    )
    # rerunning the same calculation replaces it (no doubled history) ...
    n_daily, total_before = daily.count(), s(total, "total_sum")
    jobs.aggregates(spark, clean, f"{tmp_dir}/agg", calc)
    assert spark.read.parquet(a.daily).count() == n_daily
    assert s(spark.read.parquet(a.total), "total_sum") == total_before
    # ... a second calculation adds history; latest_aggregates keeps one row per key
    jobs.aggregates(spark, clean, f"{tmp_dir}/agg", calc + dt.timedelta(days=1))
    hist = spark.read.parquet(a.daily)
    assert hist.count() == 2 * n_daily
    latest = agg.latest_aggregates(hist, ["login", "date_from"])
    assert latest.count() == n_daily
    assert {r.calculation_ts for r in latest.select("calculation_ts").distinct().collect()} == {calc + dt.timedelta(days=1)}


def test_streaming_daily_partials_match_batch(spark, tmp_dir):
    clean = rec.clean_transactions(
        rec.load_ledger(v.ledger(spark, SF_SMALL)), rec.load_second_source(v.second_source(spark, SF_SMALL))
    )
    src = f"{tmp_dir}/clean"
    # two arrivals of clean rows
    clean.filter("transaction_uid % 2 = 0").write.parquet(f"{src}/part-a")
    clean.filter("transaction_uid % 2 = 1").write.parquet(f"{src}/part-b")
    q = signed_sums.start_daily_partials(
        spark, f"{src}/*", f"{tmp_dir}/partials", f"{tmp_dir}/ckpt", max_files_per_trigger=1
    )
    q.awaitTermination(300)
    got = signed_sums.daily_sums(spark, f"{tmp_dir}/partials")
    want = agg.daily_agg(agg.signed_amounts(clean), calculation_ts=False)
    assert rows(got) == rows(want)
    assert spark.read.parquet(f"{tmp_dir}/partials").select("batch_id").distinct().count() >= 2


def test_windowed_daily_sums_emit_closed_days(spark, tmp_dir):
    clean = rec.clean_transactions(
        rec.load_ledger(v.ledger(spark, SF_SMALL)), rec.load_second_source(v.second_source(spark, SF_SMALL))
    )
    clean.write.parquet(f"{tmp_dir}/clean")
    stream = signed_sums.read_clean_stream(spark, f"{tmp_dir}/clean")
    q = (
        signed_sums.windowed_daily_sums(stream, watermark="0 seconds")
        .writeStream.outputMode("append")
        .format("memory")
        .queryName("ll_windowed")
        .option("checkpointLocation", f"{tmp_dir}/wckpt")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    got = spark.table("ll_windowed")
    want = agg.daily_agg(agg.signed_amounts(clean), calculation_ts=False)
    last_day = want.agg({"date_from": "max"}).collect()[0][0]
    # days before the last one are final and exact; the last day stays open
    assert rows(got.filter(f"date_from < DATE'{last_day}'")) == rows(want.filter(f"date_from < DATE'{last_day}'"))


def test_large_group_of_copies_pairs_by_count(spark):
    """One row repeated 5000 times on the left and 3000 times on the right:
    3000 exact pairs and 2000 left-only rows, without numbering the copies."""
    cols = ("transaction_uid long, login long, counter_login long, transaction_type long, "
            "ts timestamp_ntz, comment string, amount decimal(18,4)")
    base = spark.range(5000).selectExpr(
        "7L AS transaction_uid", "1L AS login", "CAST(NULL AS BIGINT) AS counter_login", "1L AS transaction_type",
        "TIMESTAMP_NTZ'2020-01-01 00:00:00' AS ts", "'copy' AS comment", "CAST(5 AS DECIMAL(18,4)) AS amount",
    )
    other = spark.createDataFrame([(8, 2, None, 1, dt.datetime(2020, 1, 1), "x", Decimal("1"))], cols)
    left = base.unionByName(other)
    right_rows = base.limit(3000).unionByName(
        spark.createDataFrame([(8, 2, None, 1, dt.datetime(2020, 1, 1), "X", Decimal("1"))], cols)
    )
    first = rec.load_ledger(left, ts_col="ts")
    second = rec.load_second_source(right_rows.selectExpr(
        "transaction_uid", "login", "counter_login", "transaction_type", "unix_timestamp(ts) AS epoch_seconds",
        "comment", "amount"))
    summary = {r.status: r.pairs for r in rec.reconciliation_summary(
        rec.reconciliation_report(rec.pair_sources(first, second), Tolerances())).collect()}
    assert summary == {"exact": 3000, "left_only": 2000, "char": 1}


COLS = "transaction_uid long, login long, counter_login long, transaction_type long, epoch long, comment string, amount decimal(18,4)"


def sources(spark, left_rows, right_rows, null_token=None):
    left, right = spark.createDataFrame(left_rows, COLS), spark.createDataFrame(right_rows, COLS)
    ts = "CAST(timestamp_seconds(epoch) AS TIMESTAMP_NTZ) AS ts"
    return (
        rec.load_ledger(left.selectExpr("*", ts), ts_col="ts", null_token=null_token),
        rec.load_second_source(right.withColumnRenamed("epoch", "epoch_seconds"), null_token=null_token),
    )


def statuses(paired):
    return {r.status: r.pairs for r in rec.reconciliation_summary(rec.reconciliation_report(paired, Tolerances())).collect()}


def test_lines_that_do_not_parse_are_kept_apart(spark, tmp_dir):
    import os

    src = v.second_source(spark, SF_SMALL)
    files.write_source_csv(src, f"{tmp_dir}/csv")
    bad = ["not,a,transaction", "x1,2,3,4,5,pay,6.0", "1,2,3,4,five,pay,6.0", "1,2,3,4,5,pay,6.0,7,extra"]
    with open(f"{tmp_dir}/csv/part-extra.csv", "w") as f:
        f.write("\n".join([*bad, "", "77,2,3,4,5,late,6.0"]) + "\n")
    for _ in range(2):  # a rerun replaces both tables
        out = files.load_source_csv(spark, f"{tmp_dir}/csv", f"{tmp_dir}/loaded")
        assert (out.loaded, out.rejected) == (src.count() + 1, len(bad))
    lines = spark.read.parquet(out.quarantine).collect()
    assert sorted(r.line for r in lines) == sorted(bad) and all(r.file.endswith("part-extra.csv") for r in lines)
    rows = spark.read.parquet(out.rows)
    good = files.read_source_csv(spark, f"{tmp_dir}/csv/part-0*")
    assert rows.columns == good.columns and rows.filter("transaction_uid <> 77").exceptAll(good).isEmpty() and rows.count() == good.count() + 1
    assert rows.filter("comment IS NULL").isEmpty()
    os.makedirs(f"{tmp_dir}/none")
    empty = files.load_source_csv(spark, f"{tmp_dir}/none", f"{tmp_dir}/nothing")
    assert (empty.loaded, empty.rejected) == (0, 0)


@pytest.mark.parametrize("chunk, stretch", [(4, 10), (100_000, 86_400), (1, 10**9)])
def test_no_constant_changes_the_pairs(spark, monkeypatch, chunk, stretch):
    """600 rows of 200 keys, each of which differs from exactly one partner in
    letter case only, next to rows that no rule accepts, copies and NULL keys."""
    monkeypatch.setattr(matching, "COPIES_PER_CHUNK", chunk)
    monkeypatch.setattr(matching, "GROUP_ROWS", chunk)
    monkeypatch.setattr(rec, "STRETCH_SECONDS", stretch)
    left = [(k, 1, None, 1, 1000 * i, f"text {k} {i}", Decimal(i)) for k in range(200) for i in range(3)]
    right = [(k, 1, None, 1, 1000 * i, f"TEXT {k} {i}", Decimal(i)) for i in (1, 2, 0) for k in range(199, -1, -1)]
    left += [(900, 1, None, 1, 7 * i, "c", Decimal(i)) for i in range(50)] + [(901, 1, None, 1, 1, "copy", Decimal(5))] * 25 + [(None, 1, None, 1, 1, "n", Decimal(1))] * 3
    right += [(900, 2, None, 1, 7 * i, "c", Decimal(10**6 + i)) for i in range(30)] + [(901, 1, None, 1, 1, "copy", Decimal(5))] * 10 + [(None, 1, None, 1, 1, "n", Decimal(1))] * 2
    paired = rec.pair_sources(*sources(spark, left, right))
    assert statuses(paired) == {"char": 600, "exact": 10, "unreconciled": 30, "left_only": 20 + 15 + 3, "right_only": 2}
    hot = sorted((r.unix_timestamp, r.unix_timestamp_2) for r in paired.filter("transaction_uid = 900 AND transaction_uid_2 = 900").collect())
    assert hot == [(7 * i, 7 * i) for i in range(30)]


def test_null_token_reaches_the_pairs(spark, tmp_dir):
    """NULLs in different columns: equal texts without a token, not with one."""
    rows = [(1, 2, None, 3, 4, "5", None)], [(1, None, 2, 3, 4, "5", None)]
    for repeats in (1, 2):  # unique and repeated keys
        left, right = rows[0] * repeats, rows[1] * repeats
        assert statuses(rec.pair_sources(*sources(spark, left, right))) == {"exact": repeats}
        assert statuses(rec.pair_sources(*sources(spark, left, right, "~"))) == {"unreconciled": repeats}
    assert rec.clean_transactions(*sources(spark, *rows)).count() == 1
    assert rec.clean_transactions(*sources(spark, *rows, "~")).count() == 0
    ledger = spark.createDataFrame(rows[0], COLS).selectExpr("*", "CAST(timestamp_seconds(epoch) AS TIMESTAMP_NTZ) AS transaction_ts")
    second = spark.createDataFrame(rows[1], COLS).withColumnRenamed("epoch", "epoch_seconds")
    for token, want in ((None, 1), ("~", 0)):
        out = jobs.reconcile(spark, ledger, second, f"{tmp_dir}/{want}", null_token=token)
        assert jobs.read_clean(spark, out.clean).count() == want


def test_rerun_with_fewer_rows_leaves_none_behind(spark, tmp_dir):
    left = [(1, 2, None, 1, 86_400, "a", Decimal(100)), (2, 2, None, 1, 900_000, "a", Decimal(100))]
    right = [(1, 2, None, 1, 86_400, "a", Decimal(100)), (2, 2, None, 1, 900_000, "a", Decimal(103))]
    ledger = spark.createDataFrame(left, COLS).selectExpr("*", "CAST(timestamp_seconds(epoch) AS TIMESTAMP_NTZ) AS transaction_ts")
    second = spark.createDataFrame(right, COLS).withColumnRenamed("epoch", "epoch_seconds")
    for percent, want in ((5, 2), (1, 1)):
        out = jobs.reconcile(spark, ledger, second, f"{tmp_dir}/r", Tolerances(percent=percent))
        assert jobs.read_clean(spark, out.clean).count() == want
    pairs = {r.transaction_uid: r for r in spark.read.parquet(out.pairs).collect()}
    assert pairs[2].status == "unreconciled" and pairs[2].amount_2 == Decimal(103) and pairs[2].login_2 == 2


def _files(path):
    from pathlib import Path

    return [f for f in Path(path).rglob("*.parquet")]


def test_writers_make_few_files(spark, tmp_dir):
    from ledgerlens.sources import sinks

    rows = spark.range(0, 4000, 1, 8).selectExpr("id", "id % 97 AS login")
    sinks.write_bucketed(rows, "few_files_bucketed", f"{tmp_dir}/b", "login", 4)
    assert len(_files(f"{tmp_dir}/b")) <= 4
    clean = spark.range(0, 6000, 1, 8).selectExpr(
        "id AS transaction_uid", "id % 50 AS login", "CAST(NULL AS BIGINT) AS counter_login", "1L AS transaction_type",
        "timestampadd(DAY, CAST(id % 30 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS transaction_ts", "'c' AS comment",
        "CAST(1 AS DECIMAL(18,4)) AS amount",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = jobs.aggregates(spark, clean, f"{tmp_dir}/a")
        again = jobs.aggregates(spark, clean, f"{tmp_dir}/a")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out.calculation_ts != again.calculation_ts
    # about one file a date: a range border may cut a date in two
    assert len(_files(out.daily)) <= 2 * (30 + 8)
    assert spark.read.parquet(out.total).count() == 100


def test_insert_rows_with_column_list_and_default(spark, tmp_dir):
    catalog.create_schemas(spark, root=f"{tmp_dir}/tables")
    cols = ["transaction_uid", "login", "counter_login", "transaction_type", "comment", "amount"]
    catalog.insert_rows(
        spark, "bank.tb_transactions",
        [(501, 71, None, 1, "", Decimal("250")), (502, 72, 73, -1, "refund", Decimal("12.5"))],
        cols,
    )
    got = spark.table("bank.tb_transactions").orderBy("transaction_uid").collect()
    assert [r.transaction_uid for r in got][-2:] == [501, 502]
    assert all(r.transaction_ts is not None for r in got)  # declared default: load time


def test_command_line_jobs(spark, tmp_dir, capsys):
    from ledgerlens.__main__ import main

    v.ledger(spark, SF_SMALL).write.parquet(f"{tmp_dir}/ledger")
    files.write_source_csv(v.second_source(spark, SF_SMALL), f"{tmp_dir}/second_csv")
    ini = f"{tmp_dir}/config.ini"
    with open(ini, "w") as fh:
        fh.write("[tolerance_vars]\ntolerance_percent = 5\ntolerance_levenshtein = 1\ntolerance_seconds = 300\n")
    assert main(["reconcile", "--ledger", f"{tmp_dir}/ledger", "--second", f"{tmp_dir}/second_csv",
                 "--second-format", "csv", "--tolerances", ini, "--out", f"{tmp_dir}/rec"]) == 0
    assert main(["aggregates", "--clean", f"{tmp_dir}/rec/clean", "--out", f"{tmp_dir}/agg",
                 "--calculation-ts", "2024-03-01 00:00:00"]) == 0
    out = capsys.readouterr().out
    assert '"clean":' in out and '"daily":' in out
    clean = jobs.read_clean(spark, f"{tmp_dir}/rec/clean")
    total = spark.read.parquet(f"{tmp_dir}/agg/total").agg({"total_sum": "sum"}).collect()[0][0]
    assert clean.count() > 0
    assert total == agg.signed_amounts(clean).agg({"sign_amount": "sum"}).collect()[0][0]


def test_pairing_join_types(spark):
    first = rec.load_ledger(v.ledger(spark, SF_SMALL))
    second = rec.load_second_source(v.second_source(spark, SF_SMALL))
    n_left, n_right = first.count(), second.count()
    full = rec.pair_sources(first, second, how="full")
    both = full.filter("row_sha2 IS NOT NULL AND row2_sha2 IS NOT NULL").count()
    assert rec.pair_sources(first, second, how="inner").count() == both
    assert rec.pair_sources(first, second, how="left").count() == n_left
    assert rec.pair_sources(first, second, how="right").count() == n_right
    with pytest.raises(ValueError):
        rec.pair_sources(first, second, how="cross")


def test_command_line_options(tmp_dir, monkeypatch):
    """Options reach the readers, writers and the session; nothing is connected."""
    import ledgerlens.__main__ as cli

    with open(f"{tmp_dir}/db.properties", "w") as fh:
        fh.write("# login\nuser = reader\n\npassword=a=b\ndriver=org.example.Driver\n")
    calls = {}
    monkeypatch.setattr(cli, "build_session", lambda **kw: calls.setdefault("session", kw))
    monkeypatch.setattr(cli.jdbc, "read_table", lambda spark, *a, **kw: calls.setdefault("read", (a, kw)))
    monkeypatch.setattr(cli.jdbc, "append_table", lambda df, *a, **kw: calls.setdefault("append", []).append((a, kw)))
    monkeypatch.setattr(cli.files, "read_parquet", lambda *a: None)
    monkeypatch.setattr(cli.jobs, "read_clean", lambda *a: None)
    monkeypatch.setattr(cli.jobs, "reconcile", lambda *a, **kw: (calls.setdefault("job", kw), cli.jobs.ReconcileOutput("p", "c"))[1])
    argv = ["reconcile", "--ledger-jdbc", "jdbc:x:y", "ledger", "--jdbc-split", "transaction_uid", "0", "1000", "16", "--second", "s", "--out", "o",
            "--jdbc-properties", f"{tmp_dir}/db.properties", "--append-jdbc", "jdbc:x:y", "clean", "--append-connections", "4",
            "--input-bytes", "1000000000", "--total-cores", "64", "--null-token", "~"]
    assert cli.main(argv) == 0
    login = {"user": "reader", "password": "a=b", "driver": "org.example.Driver"}
    assert calls["session"]["input_bytes"] == 1_000_000_000 and calls["session"]["total_cores"] == 64
    (url, table, properties), split = calls["read"]
    assert (url, table, properties) == ("jdbc:x:y", "ledger", login)
    assert jdbc.jdbc_read_options(url, table, properties, **split)["numPartitions"] == "16"
    assert calls["append"] == [(("jdbc:x:y", "clean", login), {"num_partitions": 4})]
    assert calls["job"]["null_token"] == "~"
    with pytest.raises(SystemExit):
        cli.main([*argv[:-4], "--input-bytes", "5"])
