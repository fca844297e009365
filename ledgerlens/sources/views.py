"""Domain views over the driver's TPC-H-like test tables.

The test data has no users, deposits or ledgers, so these views map its tables
onto the domain. Each view is a lazy DataFrame: it reads only the columns it
needs (the Parquet scan shows them in ``ReadSchema``) and grows with the input.

Mapping rules (fixed values, shared with the SQL oracle in ``plans.oracle``):

* users: customer joined to nation; uid = c_custkey; registration_date =
  1994-01-01 plus (c_custkey % 365) days; country = n_name; first_name = c_name
* logins: two per customer, k in (1, 2); login = c_custkey * 10 + k;
  account_type = 'demo' when (c_custkey + k) % 3 = 0, else 'real';
  created_ts = registration_date plus k hours
* operations: one per order; type 'withdrawal' when o_orderstatus = 'P', else
  'deposit'; login = o_custkey * 10 + 1 + o_orderkey % 2;
  amount = o_totalprice as decimal(18,4)
* trades: one per line item of orders that are no withdrawals
  (o_orderstatus <> 'P'); order_uid = l_orderkey * 10 + l_linenumber;
  order_close_date = l_shipdate
* ledger (first source): one per event; counter_login = user_id + 1 when
  event_id % 3 = 0; transaction_type = -1 for 'purchase', else 1;
  transaction_ts = ts, but NULL when event_id % 50 = 9;
  comment = '' when event_id % 4 = 0, else NULL when event_id % 11 = 0,
  else event_type; amount = value as decimal(18,4), but 0 when event_id % 50 =
  3 and NULL when event_id % 50 = 7
* second source: the ledger altered by m = event_id % 20 -- 0 absent;
  1 upper(comment); 2 comment || 'x'; 3, 4, 5, 6, 11 epoch +120, -120, -300,
  +100000, +60; 7 amount * 1.05; 8 amount * 0.94; 11 amount * 1.01;
  9 login + 1; 10 counter_login NULL -> 0; 12 transaction_uid + 10000000
* repeating sources: both sources with fewer, repeating keys -- NULL when
  event_id % 13 = 0, -1 (a hot key) when event_id % 10 = 1, else event_id DIV 3
  (plus 10000000 where the second source is shifted)
* surplus sources: every event is a row of either source; 16 events share a key,
  of which the first source has 9 and 7 in turn. With h = event_id * 7919 % 1009,
  rows of a key differ in one column by the key's remainder by 3 -- 0 the
  comment ('ref ' and two letters, in upper case for odd ids), 1 the time (minutes h
  % 40), 2 the amount ((1000 + h % 400) / 10) -- so that partners are scarce
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schemas import MONEY

# Fixed values of the mapping (see module docstring).
REGISTRATION_BASE = "1994-01-01"
REGISTRATION_SPREAD_DAYS = 365
LOGINS_PER_USER = (1, 2)
DEMO_MODULUS = 3
WITHDRAWAL_STATUS = "P"
ALTERATION_MODULUS = 20
UID_SHIFT = 10_000_000
EPOCH_SHIFTS = {3: 120, 4: -120, 5: -300, 6: 100_000, 11: 60}
AMOUNT_FACTORS = {7: "1.05", 8: "0.94", 11: "1.01"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _registration(custkey: str) -> str:
    return (
        f"CAST(date_add(DATE'{REGISTRATION_BASE}', CAST({custkey} % {REGISTRATION_SPREAD_DAYS} AS INT))"
        " AS TIMESTAMP_NTZ)"
    )


def _login_of_order(custkey: str, orderkey: str) -> str:
    return f"CAST({custkey} * 10 + 1 + {orderkey} % 2 AS BIGINT)"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    # nation is a fixed 25-row dimension at every scale factor, so it is
    # broadcast; the join then runs map-side on the customer scan.
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customer.join(F.broadcast(nation), F.expr("c_nationkey = n_nationkey"), "inner").selectExpr(
        "CAST(c_custkey AS BIGINT) AS uid",
        f"{_registration('c_custkey')} AS registration_date",
        "n_name AS country",
        "c_name AS first_name",
    )


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    ks = ", ".join(str(k) for k in LOGINS_PER_USER)
    per_login = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"explode(array({ks})) AS k")
    return per_login.selectExpr(
        "CAST(c_custkey AS BIGINT) AS user_uid",
        "CAST(c_custkey * 10 + k AS BIGINT) AS login",
        f"CASE WHEN (c_custkey + k) % {DEMO_MODULUS} = 0 THEN 'demo' ELSE 'real' END AS account_type",
        f"timestampadd(HOUR, k, {_registration('c_custkey')}) AS created_ts",
    )


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS BIGINT) AS operation_uid",
        "CASE WHEN o_orderstatus = 'P' THEN 'withdrawal' ELSE 'deposit' END AS operation_type",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS operation_date",
        f"{_login_of_order('o_custkey', 'o_orderkey')} AS login",
        f"CAST(o_totalprice AS {MONEY.simpleString()}) AS amount",
    )


def _traded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(f"o_orderstatus <> '{WITHDRAWAL_STATUS}'").select("o_orderkey", "o_custkey")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return lineitem.join(_traded_orders(spark, sf_dir), F.expr("l_orderkey = o_orderkey"), "inner").selectExpr(
        "CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS order_uid",
        f"{_login_of_order('o_custkey', 'o_orderkey')} AS login",
        "CAST(l_shipdate AS TIMESTAMP_NTZ) AS order_close_date",
    )


def first_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First trade close date per login (login, first_order_date).

    Equal to ``min(order_close_date)`` over ``trades`` per login, but the
    minimum is taken per order on the line items first (partial aggregation,
    before the join shuffles them), so the join sees one row per order.
    """
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.expr("min(l_shipdate) AS first_ship"))
    return (
        per_order.join(_traded_orders(spark, sf_dir), F.expr("l_orderkey = o_orderkey"), "inner")
        .groupBy(F.expr(f"{_login_of_order('o_custkey', 'o_orderkey')} AS login"))
        .agg(F.expr("CAST(min(first_ship) AS TIMESTAMP_NTZ) AS first_order_date"))
    )


LEDGER_SELECT = (
    "CAST(event_id AS BIGINT) AS transaction_uid",
    "CAST(user_id AS BIGINT) AS login",
    "CAST(CASE WHEN event_id % 3 = 0 THEN user_id + 1 END AS BIGINT) AS counter_login",
    "CAST(CASE WHEN event_type = 'purchase' THEN -1 ELSE 1 END AS BIGINT) AS transaction_type",
    "CASE WHEN event_id % 50 <> 9 THEN CAST(ts AS TIMESTAMP_NTZ) END AS transaction_ts",
    "CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS comment",
    f"CAST(CASE event_id % 50 WHEN 3 THEN 0 WHEN 7 THEN NULL ELSE value END AS {MONEY.simpleString()}) AS amount",
)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First source: the bank ledger table (schema ``schemas.LEDGER``)."""
    return table(spark, sf_dir, "events").selectExpr(*LEDGER_SELECT)


def _case(residues: dict, otherwise: str, template: str) -> str:
    whens = " ".join(f"WHEN {r} THEN {template.format(v)}" for r, v in residues.items())
    return f"CASE transaction_uid % {ALTERATION_MODULUS} {whens} ELSE {otherwise} END"


def second_source(spark: SparkSession, sf_dir: str, uid: str = "transaction_uid") -> DataFrame:
    """Second source as stored (schema ``schemas.SECOND_SOURCE``); ``uid`` is its
    key before the shift, from the ledger's columns."""
    m = f"transaction_uid % {ALTERATION_MODULUS}"
    base = ledger(spark, sf_dir).filter(f"{m} <> 0")
    shift = _case(EPOCH_SHIFTS, "0", "{}")
    amount = _case(AMOUNT_FACTORS, "amount", "amount * {}BD")
    return base.selectExpr(
        f"CASE WHEN {m} = 12 THEN {uid} + {UID_SHIFT} ELSE {uid} END AS transaction_uid",
        f"CASE WHEN {m} = 9 THEN login + 1 ELSE login END AS login",
        f"CASE WHEN {m} = 10 THEN coalesce(counter_login, 0L) ELSE counter_login END AS counter_login",
        "transaction_type",
        f"CAST(unix_timestamp(transaction_ts) + {shift} AS BIGINT) AS epoch_seconds",
        f"CASE WHEN {m} = 1 THEN upper(comment) WHEN {m} = 2 THEN concat(comment, 'x') ELSE comment END AS comment",
        f"CAST({amount} AS {MONEY.simpleString()}) AS amount",
    )


REPEATING_UID = (
    "CASE WHEN transaction_uid % 13 = 0 THEN CAST(NULL AS BIGINT) WHEN transaction_uid % 10 = 1 THEN -1L ELSE transaction_uid DIV 3 END"
)


def repeating_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with keys that repeat (see above)."""
    return ledger(spark, sf_dir).withColumn("transaction_uid", F.expr(REPEATING_UID))


def repeating_second_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return second_source(spark, sf_dir, REPEATING_UID)


SURPLUS_EPOCH = 1577836800
SURPLUS_SELECT = (
    "key AS transaction_uid",
    "key % 1000 AS login",
    "CAST(NULL AS BIGINT) AS counter_login",
    "1L AS transaction_type",
    f"{SURPLUS_EPOCH}L + CASE WHEN key % 3 = 1 THEN h % 40 * 60 ELSE 0L END AS epoch_seconds",
    "CASE WHEN key % 3 <> 0 THEN 'pay' WHEN event_id % 2 = 0 THEN text ELSE upper(text) END AS comment",
    f"CAST(CASE WHEN key % 3 = 2 THEN CAST(1000 + h % 400 AS DECIMAL(10,0)) * 0.1BD ELSE 50 END AS {MONEY.simpleString()}) AS amount",
)


def _surplus(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    keyed = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(event_id DIV 16 AS BIGINT) AS key", "CAST(event_id * 7919 % 1009 AS BIGINT) AS h", "event_id % 16 AS slot"
    )
    texts = keyed.selectExpr("*", "concat('ref ', chr(97 + h % 5), chr(97 + h DIV 5 % 4)) AS text")
    return texts.filter(f"slot {side} CASE WHEN key % 2 = 0 THEN 9 ELSE 7 END").selectExpr(*SURPLUS_SELECT)


def surplus_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First source of keys with more rows on one side (see above)."""
    rows = _surplus(spark, sf_dir, "<")
    return rows.withColumn("epoch_seconds", F.expr("CAST(timestamp_seconds(epoch_seconds) AS TIMESTAMP_NTZ)")).withColumnRenamed("epoch_seconds", "transaction_ts")


def surplus_second_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surplus(spark, sf_dir, ">=")
