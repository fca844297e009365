"""Data checks for the constraints the table definitions declare.

Each check is one distributed pass and returns the offending keys or rows (or
per-column counts), never a driver-side loop over the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K1: key values that occur more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.expr("count(1) AS n")).filter("n > 1")


def _q(name: str) -> str:
    return f"`{name}`"


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K2: rows with a NULL in any of the columns."""
    return df.filter(" OR ".join(f"{_q(c)} IS NULL" for c in columns))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K2 summary: one row per column with its NULL count (``column``, ``nulls``)."""
    counts = df.selectExpr(*[f"count_if({_q(c)} IS NULL) AS {_q(c)}" for c in columns])
    return counts.unpivot([], list(columns), "column", "nulls")


def over_length(df: DataFrame, limits: Mapping[str, int], keys: Sequence[str] = ()) -> DataFrame:
    """K3: one row per text value longer than its limit.

    Columns: the ``keys``, ``column``, ``length``, ``max_length``.
    """
    items = ", ".join(
        f"CASE WHEN length({_q(c)}) > {int(n)} THEN named_struct('column', '{c}', "
        f"'length', length({_q(c)}), 'max_length', {int(n)}) END"
        for c, n in limits.items()
    )
    found = f"explode(filter(array({items}), s -> s IS NOT NULL)) AS v"
    return df.selectExpr(*keys, found).selectExpr(*keys, "v.column", "v.length", "v.max_length")


def fill_default_timestamp(df: DataFrame, column: str, default: dt.datetime | str | None = None) -> DataFrame:
    """K4: replace a missing timestamp by a default (the load time when not given)."""
    if default is None:
        value = "CAST(current_timestamp() AS TIMESTAMP_NTZ)"
    elif isinstance(default, dt.datetime):
        value = f"TIMESTAMP_NTZ'{default.isoformat(sep=' ')}'"
    else:
        value = f"CAST('{default}' AS TIMESTAMP_NTZ)"
    return df.withColumn(column, F.expr(f"coalesce({_q(column)}, {value})"))


def metrics(
    not_null: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
    groups: Mapping[str, Sequence[str]] | None = None,
    where: str = "true",
    prefix: str = "",
) -> list[Column]:
    """K2 and K3 as counts for ``DataFrame.observe``, taken in the pass that writes:
    ``nulls:column``, ``long:column`` and, for the values of ``groups`` (column:
    values), ``column:value``, over the rows that meet ``where``."""
    counts = {f"nulls:{c}": f"{_q(c)} IS NULL" for c in not_null}
    counts |= {f"long:{c}": f"length({_q(c)}) > {int(n)}" for c, n in (max_length or {}).items()}
    counts |= {f"{c}:{value}": f"{_q(c)} = '{value}'" for c, values in (groups or {}).items() for value in values}
    return [F.expr(f"count_if(({where}) AND ({rule}))").alias(prefix + name) for name, rule in counts.items()]


def constraint_report(
    df: DataFrame,
    keys: Sequence[str] = (),
    not_null: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
) -> DataFrame:
    """K1-K3 together: one row per rule and column with its violation count.

    Columns: ``check`` ('duplicate_key', 'not_null', 'max_length'), ``column``
    (the key columns joined by ',' for duplicates), ``violations`` (rows
    breaking the rule; for keys, rows beyond the first per key value). NULL
    and length counts come from one aggregation pass; duplicates from one
    aggregation by key (partial, so a hot key value costs one row per task).
    """
    limits = dict(max_length or {})
    parts = []
    exprs = [f"count_if({_q(c)} IS NULL) AS `nn:{c}`" for c in not_null]
    exprs += [f"count_if(length({_q(c)}) > {int(n)}) AS `ml:{c}`" for c, n in limits.items()]
    if exprs:
        counts = df.selectExpr(*exprs)
        stacked = counts.unpivot([], [c for c in counts.columns], "rule", "violations")
        parts.append(
            stacked.selectExpr(
                "CASE WHEN rule LIKE 'nn:%' THEN 'not_null' ELSE 'max_length' END AS check",
                "substr(rule, 4) AS column",
                "violations",
            )
        )
    if keys:
        dup = (
            df.groupBy(*keys)
            .agg(F.expr("count(1) AS n"))
            .agg(F.expr("coalesce(sum(n - 1), 0L) AS violations"))
            .selectExpr("'duplicate_key' AS check", f"'{','.join(keys)}' AS column", "violations")
        )
        parts.append(dup)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
