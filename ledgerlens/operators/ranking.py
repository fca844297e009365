"""Row numbers and ranks of groups that one task need not hold.

Rows are dealt by Spark's sampled ranges of (key, order columns, a hash of the
row), so a key larger than a task lies in several ranges, at any spread of its
dates. The window function runs inside (key, range); the rows of the key's earlier
ranges, counted per (key, range), are added. The results are those of one window
over the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stored


def ranges(df: DataFrame, columns: tuple[str, ...], parts: int | None = None) -> DataFrame:
    """``df`` with the number of its range (_range) by ``columns``, then by a hash of
    the row: only rows equal in all columns always stay together. Written, so that
    all readers see the same ranges."""
    hashed = df.withColumn("_spread", F.expr(f"xxhash64({', '.join(f'`{c}`' for c in df.columns)})"))
    by = (*columns, "_spread")
    dealt = hashed.repartitionByRange(parts, *by) if parts else hashed.repartitionByRange(*by)
    return stored(dealt.drop("_spread").withColumn("_range", F.spark_partition_id()), "ranges")


def earlier_rows(dealt: DataFrame, key: str, date: str) -> DataFrame:
    """For each (key, range) that goes on from an earlier range: how many rows of
    the key are in earlier ranges (_before), its first date, and how many rows of
    that date are in earlier ranges (_tied). One key at most goes on into a range, so
    there are at most as many rows as ranges."""
    per_day = dealt.groupBy(key, "_range", date).agg(F.expr("count(1) AS n"))
    # NULL dates are the first of a key; a struct orders them so.
    ends = per_day.groupBy(key, "_range").agg(
        F.expr("sum(n) AS n"), F.expr(f"min(struct({date})) AS _first"), F.expr(f"max(struct(struct({date}) AS day, n)) AS _last")
    )
    over = f"OVER (PARTITION BY {key} ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    # A date that ends several ranges: its rows in all of them so far.
    same = f"sum(_last.n) OVER (PARTITION BY {key}, _last.day ORDER BY _range)"
    running = ends.selectExpr(key, "_range", "_first", "_last.day AS _day", "n", f"{same} AS _same")
    order = f"OVER (PARTITION BY {key} ORDER BY _range)"
    counted = running.selectExpr(
        key, "_range", "_first", f"sum(n) {over} AS _before",
        f"CASE WHEN lag(_day) {order} <=> _first THEN lag(_same) {order} ELSE 0L END AS _tied",
    )
    return counted.filter("_before > 0").selectExpr(f"{key} AS _key", "_range AS _stretch", "_first", "_before", "_tied")


def split_rank(df: DataFrame, function: str, key: str, date: str, ties: tuple[str, ...], out: str, parts: int | None = None) -> DataFrame:
    """``row_number`` or ``rank`` (``function``) within ``key`` by ``date``, then
    ``ties`` (row_number only); NULL dates come first, as in a plain window, and rows
    of a NULL key are a group. An empty table gives an empty one. ``parts`` is the
    number of ranges (``spark.sql.shuffle.partitions`` by default)."""
    if function not in ("row_number", "rank") or (function == "rank" and ties):
        raise ValueError("row_number with any ties, or rank by the date alone")
    dealt = ranges(df, (key, date, *ties), parts)
    inside = f"{function}() OVER (PARTITION BY {key}, _range ORDER BY {', '.join((date, *ties))})"
    # At most one row a range: the bound of the broadcast.
    before = F.broadcast(earlier_rows(dealt, key, date))
    ranked = dealt.selectExpr("*", f"{inside} AS _inside").join(before, F.expr(f"_range = _stretch AND {key} <=> _key"), "left")
    # Rows of the range's first date share the rank of those in earlier ranges.
    tied = f"CASE WHEN struct({date}) <=> _first THEN coalesce(_tied, 0L) ELSE 0L END" if function == "rank" else "0L"
    return ranked.selectExpr(*df.columns, f"CAST(_inside + coalesce(_before, 0L) - {tied} AS INT) AS {out}")
