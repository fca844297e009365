"""Typed schemas of the domain tables.

Integer keys are 64-bit, money is ``decimal(18,4)``, timestamps carry no time
zone, epoch values are seconds as ``long``. Names, types, keys and rules of the
tables below are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 4)
MONEY_SUM = DecimalType(38, 4)


def _schema(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


USERS = _schema(
    ("uid", LongType(), True),
    ("registration_date", TimestampNTZType(), True),
    ("country", StringType(), True),
    ("first_name", StringType(), True),
)

LOGINS = _schema(
    ("user_uid", LongType(), True),
    ("login", LongType(), True),
    ("account_type", StringType(), True),
    ("created_ts", TimestampNTZType(), True),
)

OPERATIONS = _schema(
    ("operation_uid", LongType(), True),
    ("operation_type", StringType(), True),
    ("operation_date", TimestampNTZType(), True),
    ("login", LongType(), True),
    ("amount", MONEY, True),
)

TRADES = _schema(
    ("order_uid", LongType(), True),
    ("login", LongType(), True),
    ("order_close_date", TimestampNTZType(), True),
)

LEDGER = _schema(
    ("transaction_uid", LongType(), True),
    ("login", LongType(), False),
    ("counter_login", LongType(), True),
    ("transaction_type", LongType(), False),
    ("transaction_ts", TimestampNTZType(), False),
    ("comment", StringType(), True),
    ("amount", MONEY, True),
)

# The second source stores the time as epoch seconds.
SECOND_SOURCE = _schema(
    ("transaction_uid", LongType(), True),
    ("login", LongType(), True),
    ("counter_login", LongType(), True),
    ("transaction_type", LongType(), True),
    ("epoch_seconds", LongType(), True),
    ("comment", StringType(), True),
    ("amount", MONEY, True),
)

DAILY_AGG = _schema(
    ("login", LongType(), True),
    ("date_from", DateType(), True),
    ("daily_sum", MONEY_SUM, True),
    ("calculation_ts", TimestampNTZType(), True),
)

MONTHLY_AGG = _schema(
    ("login", LongType(), True),
    ("date_from", DateType(), True),
    ("monthly_sum", MONEY_SUM, True),
    ("calculation_ts", TimestampNTZType(), True),
)

TOTAL_AGG = _schema(
    ("login", LongType(), True),
    ("total_sum", MONEY_SUM, True),
    ("calculation_ts", TimestampNTZType(), True),
)

# Column order of a compared transaction; it fixes the row hash.
TRANSACTION_COLUMNS = (
    "transaction_uid",
    "login",
    "counter_login",
    "transaction_type",
    "unix_timestamp",
    "comment",
    "amount",
)

# Primary keys and NOT NULL / length rules declared for the tables.
PRIMARY_KEYS = {
    "users": ("uid",),
    "logins": ("login",),
    "operations": ("operation_uid",),
    "trades": ("order_uid",),
    "ledger": ("transaction_uid",),
    "daily_agg": ("login", "date_from", "calculation_ts"),
    "monthly_agg": ("login", "date_from", "calculation_ts"),
    "total_agg": ("login", "calculation_ts"),
}

NOT_NULL = {
    "ledger": ("login", "transaction_type", "transaction_ts"),
}

MAX_LENGTH = {
    "users": {"country": 4, "first_name": 80},
    "logins": {"account_type": 8},
    "operations": {"operation_type": 10},
    "ledger": {"comment": 256},
}
