"""JDBC table source and append sink.

A JDBC read without a partition column is one task over one connection; at
scale the read must be split by a numeric or date column into
``num_partitions`` ranges, which is what ``read_table`` asks for. Equal steps
between two bounds give unequal ranges where values crowd: ``split_predicates``
takes the bounds from a quantile sketch, also for dates, times and decimals,
and ``read_split`` reads one range a task. Writes go
out from every partition in batches; ``num_partitions`` caps concurrent
connections.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_read_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = 10_000,
) -> dict[str, str]:
    """Options for a (range-partitioned) JDBC read; validated, not connected."""
    opts = {"url": url, "dbtable": table, **{k: str(v) for k, v in (properties or {}).items()}}
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(x is not None for x in split):
        if any(x is None for x in split):
            raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
        if int(num_partitions) < 1:
            raise ValueError("num_partitions must be >= 1")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(int(num_partitions)),
        )
    if fetch_size:
        opts["fetchsize"] = str(int(fetch_size))
    return opts


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None, **split) -> DataFrame:
    """JDBC table scan; see ``jdbc_read_options`` for the split arguments."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, properties, **split)).load()


def _literal(value) -> str:
    """A bound as standard SQL."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return format(value, "f") if isinstance(value, Decimal) else repr(value)


def split_predicates(known: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """At most ``parts`` predicates on ``column`` whose ranges hold about the same
    number of rows, by the quantile sketch (``percentile_approx``) of ``known``: an
    earlier copy of the table, or a read of that column alone.

    Every row meets exactly one of them, whatever ``known`` held: the first and
    the last range have one bound only, rows with a NULL go with the first. A
    value with a large share of the rows ends up in fewer ranges; an empty or
    all-NULL column gives one predicate that is always true. Numbers, dates and
    times; the order of texts differs between databases."""
    kind = known.schema[column].dataType.typeName()
    if kind in ("string", "char", "varchar", "binary", "boolean"):
        raise ValueError(f"{column} ({kind}) cannot be cut into ranges: take a number, date or time")
    if parts < 1:
        raise ValueError("parts must be >= 1")
    shares = [k / parts for k in range(1, parts)]
    cuts = known.select(F.percentile_approx(column, shares, accuracy)).first()[0] if shares else None
    bounds = [_literal(b) for b in sorted(set(cuts or ()))]
    if not bounds:
        return ["1 = 1"]
    first, last = f"{column} < {bounds[0]} OR {column} IS NULL", f"{column} >= {bounds[-1]}"
    return [first, *(f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:], strict=False)), last]


def read_split(spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: Mapping[str, str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    """JDBC table scan, one task for each of the ``predicates``."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties={"fetchsize": str(int(fetch_size)), **{k: str(v) for k, v in (properties or {}).items()}})


def jdbc_write_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    isolation_level: str = "READ_COMMITTED",
) -> dict[str, str]:
    opts = {
        "url": url,
        "dbtable": table,
        "batchsize": str(int(batch_size)),
        "isolationLevel": isolation_level,
        **{k: str(v) for k, v in (properties or {}).items()},
    }
    if num_partitions is not None:
        opts["numPartitions"] = str(int(num_partitions))
    return opts


def append_table(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, **opts) -> None:
    """Append rows to a database table.

    Appending is not idempotent: a retried job appends again. Check the key
    (``checks.duplicate_keys``) against the target before appending, or
    prefer the file sinks of ``sources.sinks``, which overwrite by partition.
    """
    df.write.format("jdbc").options(**jdbc_write_options(url, table, properties, **opts)).mode("append").save()
