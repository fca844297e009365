"""Row numbers that no single task has to hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written


def same(a: str, b: str) -> Column:
    """Null-safe equality of two columns, as a join condition."""
    return F.expr(f"{a} <=> {b}")


def numbered(df: DataFrame, group: str | None, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``idx``, the number of a row (from 0) in its group by the SQL
    expressions ``order``, and ``n``, the size of the group. Rows are ranged by
    (group, order) into tasks and numbered there; sizes of the parts add up to
    what lies before a part, so a hot group is numbered by many tasks. Equal rows get
    numbers in any order. ``group`` None: one group. The result is lazy over a
    table written under ``name``."""
    key = group or "CAST(NULL AS STRING)"
    keyed = df.selectExpr("*", f"{key} AS _group")
    spread = keyed.repartitionByRange("_group", *(F.expr(e) for e in order))
    placed = written(spread.withColumn("_part", F.spark_partition_id()), name)
    sizes = placed.groupBy("_group", "_part").agg(F.expr("count(1) AS _size")).selectExpr(
        "_group AS _g", "_part AS _p",
        "coalesce(sum(_size) OVER (PARTITION BY _group ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _before",
        "sum(_size) OVER (PARTITION BY _group) AS n",
    )
    local = placed.selectExpr("*", f"row_number() OVER (PARTITION BY _group, _part ORDER BY {', '.join(order)}) - 1L AS _at")
    return local.join(sizes, same("_group", "_g") & same("_part", "_p")).selectExpr(*df.columns, "_before + _at AS idx", "n")
