"""Single-operator queries: each join, aggregate, window, union and scalar
function the composites use, checked on its own over the whole test tables.

Registered into ``plans.registry.QUERIES``; SQL in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import text as tx
from ledgerlens.functions import time as tm
from ledgerlens.operators import deposits
from ledgerlens.operators import reconcile as rec
from ledgerlens.operators.ranking import split_rank
from ledgerlens.plans import oracle as o
from ledgerlens.plans.registry import TOL, _first, _second, query
from ledgerlens.sources import views as v

# --- joins ------------------------------------------------------------------


@query("j1_inner_chain")
def j1(spark, sf):
    """users -> logins -> operations, inner equi joins."""
    users, logins, ops = v.users(spark, sf), v.logins(spark, sf), v.operations(spark, sf)
    return (
        users.select("uid", "country")
        .join(logins.select("user_uid", "login"), F.expr("uid = user_uid"))
        .join(ops.select("operation_uid", "login", "amount"), "login")
        .select("uid", "country", "login", "operation_uid", "amount")
    )


@query("j2_left_outer_preaggregate")
def j2(spark, sf):
    """Operations left-joined to the first trade of their login."""
    first = deposits.first_trade_per_login(v.trades(spark, sf))
    return v.operations(spark, sf).select("operation_uid", "login").join(first, "login", "left")


@query("j3_full_outer")
def j3(spark, sf):
    """Plain full outer join of the two loaded sources on the key."""
    paired = rec.full_outer_spread(_first(spark, sf), _second(spark, sf))
    return paired.select("transaction_uid", "transaction_uid_2", "row_sha2", "row2_sha2")


@query("j4_aggregate_join")
def j4(spark, sf):
    """Per-country deposit totals joined to per-country user counts."""
    users, logins, ops = v.users(spark, sf), v.logins(spark, sf), v.operations(spark, sf)
    per_login = deposits.deposits(ops).groupBy("login").agg(F.expr("sum(amount) AS s"))
    per_country = (
        per_login.join(logins.select("user_uid", "login"), "login")
        .join(users.select("uid", "country"), F.expr("user_uid = uid"))
        .groupBy("country")
        .agg(F.expr("CAST(sum(s) AS decimal(38,4)) AS deposit_sum"))
    )
    counts = users.groupBy("country").agg(F.expr("count(uid) AS users"))
    return per_country.join(counts, "country")


# --- aggregates -------------------------------------------------------------


@query("a1_count_non_null")
def a1(spark, sf):
    return v.second_source(spark, sf).groupBy("transaction_type").agg(
        F.expr("count(counter_login) AS with_counter"), F.expr("count(comment) AS with_comment"), F.expr("count(1) AS n")
    )


@query("a2_avg_day_difference")
def a2(spark, sf):
    """The operations are reduced per login and type to the number of days that
    they hold, before the join."""
    first = deposits.first_trade_per_login(v.trades(spark, sf))
    per_login = v.operations(spark, sf).groupBy("login", "operation_type").agg(
        F.expr("count(operation_date) AS n"), F.expr("sum(CAST(unix_date(to_date(operation_date)) AS BIGINT)) AS days")
    )
    return (
        per_login.join(first, "login", "left")
        .groupBy("operation_type")
        .agg(F.expr(
            "sum(n * unix_date(to_date(first_order_date)) - IF(first_order_date IS NULL, NULL, days))"
            " / sum(IF(first_order_date IS NULL, NULL, n)) AS avg_days"
        ))
    )


@query("a3_avg_having")
def a3(spark, sf):
    ops = deposits.deposits(v.operations(spark, sf))
    return (
        ops.groupBy("login")
        .agg(F.expr("count(amount) AS deposits"), F.expr("CAST(sum(amount) AS decimal(38,4)) AS deposit_sum"))
        .filter(f"deposit_sum >= {o.HIGH_AVG_THRESHOLD} * deposits")
    )


@query("a4_min_timestamp")
def a4(spark, sf):
    return deposits.first_trade_per_login(v.trades(spark, sf))


@query("a5_sum_signed")
def a5(spark, sf):
    return v.ledger(spark, sf).groupBy("login").agg(
        F.expr("CAST(sum(amount * transaction_type) AS decimal(38,4)) AS signed_sum")
    )


@query("a6_group_one_key")
def a6(spark, sf):
    return v.operations(spark, sf).groupBy("operation_type").agg(
        F.expr("count(1) AS n"), F.expr("CAST(sum(amount) AS decimal(38,4)) AS total")
    )


@query("a7_group_several_keys")
def a7(spark, sf):
    return v.ledger(spark, sf).groupBy("login", "transaction_type").agg(
        F.expr("count(1) AS n"), F.expr("CAST(sum(amount) AS decimal(38,4)) AS total")
    )


@query("a8_group_calendar_bucket")
def a8(spark, sf):
    return (
        v.operations(spark, sf)
        .groupBy(tm.month_start("operation_date").alias("month"))
        .agg(F.expr("count(1) AS n"), F.expr("CAST(sum(amount) AS decimal(38,4)) AS total"))
    )


# --- windows ----------------------------------------------------------------


def _user_deposits(spark, sf):
    users, logins, ops = v.users(spark, sf), v.logins(spark, sf), v.operations(spark, sf)
    return (
        deposits.deposits(ops)
        .select("operation_uid", "login", "operation_date")
        .join(logins.select("user_uid", "login"), "login")
        .join(users.select("uid"), F.expr("user_uid = uid"))
    )


@query("w1_row_number")
def w1(spark, sf):
    numbered = split_rank(_user_deposits(spark, sf), "row_number", "uid", "operation_date", ("operation_uid",), "rn")
    return numbered.select("uid", "operation_uid", "rn")


@query("w2_rank")
def w2(spark, sf):
    ranked = split_rank(_user_deposits(spark, sf), "rank", "uid", "operation_date", (), "dep_rank")
    return ranked.select("uid", "operation_uid", "dep_rank")


# --- union ------------------------------------------------------------------


@query("u1_union_all_rules")
def u1(spark, sf):
    """The per-rule results combined with UNION ALL (one join per branch)."""
    paired = rec.pair_sources(_first(spark, sf), _second(spark, sf), one_to_one=False)
    parts = [
        rec.exact_matches(paired),
        rec.char_rec(paired, TOL.levenshtein),
        rec.date_rec(paired, TOL.seconds),
        rec.int_rec(paired, TOL.percent),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- scalar functions -------------------------------------------------------


@query("f1_epoch_seconds")
def f1(spark, sf):
    return v.ledger(spark, sf).select("transaction_uid", tm.to_epoch_seconds("transaction_ts").alias("epoch"))


@query("f2_epoch_to_text")
def f2(spark, sf):
    return v.second_source(spark, sf).select("transaction_uid", tm.epoch_to_text("epoch_seconds").alias("ts_text"))


@query("f3_to_date")
def f3(spark, sf):
    return v.ledger(spark, sf).select("transaction_uid", tm.day_of("transaction_ts").alias("day"))


@query("f4_month_start")
def f4(spark, sf):
    return v.ledger(spark, sf).select("transaction_uid", tm.month_start("transaction_ts").alias("month"))


@query("f6_day_difference")
def f6(spark, sf):
    """Calendar days from each transaction to 0 - 71 hours after it."""
    return v.ledger(spark, sf).withColumn("later", F.expr("timestampadd(HOUR, transaction_uid % 72, transaction_ts)")).select(
        "transaction_uid", tm.day_diff("transaction_ts", "later").alias("days")
    )


@query("f7_add_days")
def f7(spark, sf):
    return v.users(spark, sf).select("uid", tm.add_days("registration_date", -o.FUNNEL_DAYS).alias("shifted"))


@query("f8_parse_timestamp_text")
def f8(spark, sf):
    """Times written as seed text (with and without seconds) and parsed back."""
    text = F.when(
        F.col("transaction_uid") % 2 == 0, F.date_format("transaction_ts", tm.SEED_FORMAT_SECONDS)
    ).otherwise(F.date_format("transaction_ts", tm.SEED_FORMAT_MINUTES))
    return v.ledger(spark, sf).select("transaction_uid", tm.parse_seed_timestamp(text).alias("parsed"))


@query("f9_explicit_casts")
def f9(spark, sf):
    ledger = v.ledger(spark, sf)
    return ledger.selectExpr(
        "transaction_uid",
        "CAST(CAST(login AS STRING) AS BIGINT) AS login",
        "CAST(date_format(transaction_ts, 'yyyy-MM-dd HH:mm:ss') AS TIMESTAMP_NTZ) AS ts",
    )


@query("f10_concat_ws")
def f10(spark, sf):
    return v.ledger(spark, sf).select(
        "transaction_uid",
        F.concat_ws(tx.HASH_SEPARATOR, F.col("counter_login").cast("string"), "comment").alias("joined"),
    )


@query("f11_sha256")
def f11(spark, sf):
    return v.second_source(spark, sf).select("transaction_uid", F.sha2("comment", 256).alias("comment_sha2"))


@query("f12_lower")
def f12(spark, sf):
    return v.second_source(spark, sf).select("transaction_uid", F.lower("comment").alias("comment_lower"))


@query("f13_levenshtein")
def f13(spark, sf):
    paired = rec.pair_sources(_first(spark, sf), _second(spark, sf), how="inner", tol=TOL)
    return paired.filter("comment IS NOT NULL AND comment_2 IS NOT NULL").select(
        "transaction_uid", tx.edit_distance_ci("comment", "comment_2").alias("distance")
    )


@query("f14_coalesce")
def f14(spark, sf):
    return v.second_source(spark, sf).selectExpr(
        "transaction_uid", "coalesce(counter_login, 0L) AS counter_login", "coalesce(comment, '0') AS comment"
    )


@query("f15_epoch_difference")
def f15(spark, sf):
    paired = rec.pair_sources(_first(spark, sf), _second(spark, sf), how="inner", tol=TOL)
    return paired.selectExpr("transaction_uid", "unix_timestamp - unix_timestamp_2 AS delta")


@query("f16_percent_deviation")
def f16(spark, sf):
    paired = rec.pair_sources(_first(spark, sf), _second(spark, sf), how="inner", tol=TOL)
    return paired.selectExpr(
        "transaction_uid",
        "CAST(round(try_divide((amount - amount_2) * 100, amount), 4) AS decimal(38,4)) AS percent_diff",
    )


@query("f17_sign_product")
def f17(spark, sf):
    return v.ledger(spark, sf).selectExpr(
        "transaction_uid", "CAST(amount * transaction_type AS decimal(38,4)) AS sign_amount"
    )
