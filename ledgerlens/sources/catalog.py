"""Schema (database) and empty table creation, plus typed seed-row loading."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlens import schemas

# Fixed layout: database -> table -> schema.
DATABASES: Mapping[str, Mapping[str, StructType]] = {
    "default": {"tb_users": schemas.USERS, "tb_logins": schemas.LOGINS},
    "billing": {"tb_operations": schemas.OPERATIONS},
    "orderstat": {"tb_orders": schemas.TRADES},
    "bank": {
        "tb_transactions": schemas.LEDGER,
        "tb_transactions_clean": schemas.LEDGER,
        "tb_daily_agg": schemas.DAILY_AGG,
        "tb_monthly_agg": schemas.MONTHLY_AGG,
        "tb_total_agg": schemas.TOTAL_AGG,
    },
}


def create_schemas(spark: SparkSession, root: str | None = None, fmt: str = "parquet") -> list[str]:
    """Create the databases and their empty tables (idempotent).

    With ``root`` the tables are external tables under ``root/<db>/<table>``.
    Returns the qualified table names.
    """
    created = []
    for db, tables in DATABASES.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        for name, schema in tables.items():
            qualified = f"`{db}`.`{name}`"
            if spark.catalog.tableExists(f"{db}.{name}"):
                created.append(f"{db}.{name}")
                continue
            kwargs = {"path": f"{root.rstrip('/')}/{db}/{name}"} if root else {}
            spark.catalog.createTable(qualified.replace("`", ""), source=fmt, schema=schema, **kwargs)
            created.append(f"{db}.{name}")
    return created


# Fixed column defaults declared by the table definitions (SQL expressions).
DEFAULTS: Mapping[str, Mapping[str, str]] = {
    "bank.tb_transactions": {"transaction_ts": "CAST(current_timestamp() AS TIMESTAMP_NTZ)"},
}


def load_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Typed rows (e.g. seed values) as a DataFrame with a fixed schema."""
    return spark.createDataFrame(list(rows), schema=schema)


def insert_rows(
    spark: SparkSession,
    table: str,
    rows: Iterable[tuple],
    columns: Sequence[str] | None = None,
) -> None:
    """Append rows to a created table, like ``INSERT INTO t (cols) VALUES``.

    Columns left out take the table's declared default (``DEFAULTS``) or NULL.
    """
    schema = spark.table(table).schema
    names = list(columns) if columns is not None else schema.fieldNames()
    given = load_rows(spark, rows, StructType([schema[n] for n in names]))
    defaults = DEFAULTS.get(table, {})
    exprs = []
    for field in schema.fields:
        if field.name in names:
            exprs.append(f"`{field.name}`")
        else:
            value = defaults.get(field.name, "NULL")
            exprs.append(f"CAST({value} AS {field.dataType.simpleString()}) AS `{field.name}`")
    given.selectExpr(*exprs).write.insertInto(table)
