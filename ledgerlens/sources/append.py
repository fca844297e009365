"""S5 on file targets: an append that a rerun does not repeat.

A target folder holds ``data`` (Parquet, a folder for each value of the partition
column) and ``filters``: for every partition a Bloom filter of its keys, as rows
(part, word, bits). All bits of a key lie in one 64-bit word, so one equality join
by word tells which partitions may hold a key, and only those are read for the
exact check of keys (K1).

Filters are written before the rows they stand for: after a failure between the
two the filter only names a partition too many, and a rerun adds what is missing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch, stored

WORDS = 1 << 18  # words of a partition's filter: 2 MB, about 1.5 million keys at 11 bits each
MARKS = 4  # bits of a key


@dataclass(frozen=True)
class Appended:
    """Rows added, rows that were there already (repeated ones of the batch too), and
    rows in conflict, which lie in the table ``clashes``; the partitions read."""

    added: int
    present: int
    clashing: int
    clashes: str
    read: tuple


def _paths(path: str) -> tuple[str, str, str]:
    base = path.rstrip("/")
    return f"{base}/data", f"{base}/filters", f"{base}/clashes"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _word(keys: Sequence[str], words: int) -> list[str]:
    """SQL: the word of a key, and the bits it sets there."""
    names = ", ".join(f"`{k}`" for k in keys)
    bits = " | ".join(f"shiftleft(1L, CAST(pmod(xxhash64({names}, {n}), 64) AS INT))" for n in range(1, MARKS + 1))
    return [f"pmod(xxhash64({names}), {int(words)}) AS word", f"({bits}) AS bits"]


def key_filters(df: DataFrame, partition_col: str, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """(part, word, bits): Bloom filters of the keys of each partition; partial
    aggregation, at most ``words`` rows a partition and task."""
    marked = df.selectExpr(f"`{partition_col}` AS part", *_word(keys, words))
    return marked.groupBy("part", "word").agg(F.expr("bit_or(bits) AS bits"))


def touched(spark: SparkSession, path: str, rows: DataFrame, partition_col: str, keys: Sequence[str], words: int = WORDS) -> list:
    """The partitions of the target that may hold a key of ``rows``: all that do, and
    few others. The list is bounded by the number of partitions."""
    schema = f"part {rows.schema[partition_col].dataType.simpleString()}, word long, bits long"
    filters = spark.read.schema(schema).parquet(_paths(path)[1])
    # One row a word, with the bits of every partition: a key meets one row.
    by_word = filters.groupBy("part", "word").agg(F.expr("bit_or(bits) AS bits")).groupBy("word").agg(F.expr("collect_list(struct(part, bits)) AS parts"))
    probes = rows.selectExpr(*_word(keys, words)).distinct().withColumnRenamed("bits", "mask")
    found = probes.join(by_word, "word").selectExpr("explode(filter(parts, p -> (p.bits & mask) = mask)) AS p")
    return sorted((r.part for r in found.selectExpr("p.part AS part").distinct().collect()), key=lambda v: (v is not None, v))


def in_partitions(partition_col: str, values: Sequence) -> Column:
    column = F.col(partition_col)
    some = column.isin([v for v in values if v is not None])
    return some | column.isNull() if None in values else some


def read_appended(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of a target; an empty table where nothing was appended yet."""
    data = _paths(path)[0]
    return spark.read.schema(schema).parquet(data) if _exists(spark, data) else spark.createDataFrame([], schema)


def guarded_append(df: DataFrame, path: str, partition_col: str, keys: Sequence[str], words: int = WORDS) -> Appended:
    """Append the rows of ``df`` whose key is not in the target yet.

    A row that the target holds with the same values in all columns is left out (so
    a rerun adds nothing), as are repeated rows of ``df``. A row whose key the target
    holds with other values clashes, and so do all rows of ``df`` that share a key but
    not their values: none of them is added, and ``clashes`` is replaced by them.
    NULLs in keys and columns compare as values; a NULL partition has its folder.
    One writer at a time; the number of words must be the same for all appends."""
    spark, columns = df.sparkSession, df.columns
    if partition_col not in columns or not set(keys) <= set(columns):
        raise ValueError("the partition column and the keys must be columns of the table")
    data, filters, clashes = _paths(path)
    same_key = " AND ".join(f"n.`{k}` <=> o.`{k}`" for k in keys)
    with scratch(spark):
        rows = stored(df.groupBy(*columns).agg(F.expr("count(1) AS _copies")), "append-rows")
        own = rows.drop("_copies")
        read = touched(spark, path, own, partition_col, keys, words) if _exists(spark, filters) else []
        old = read_appended(spark, path, df.schema).filter(in_partitions(partition_col, read)).selectExpr(
            *(f"`{k}`" for k in keys), f"struct({', '.join(f'`{c}`' for c in columns)}) AS _old"
        )
        values = f"struct({', '.join(f'n.`{c}`' for c in columns)})"
        met = rows.alias("n").join(old.alias("o"), F.expr(same_key), "left").selectExpr(
            *(f"n.`{c}`" for c in columns), "_copies", f"CASE WHEN _old IS NULL THEN 'new' WHEN _old <=> {values} THEN 'present' ELSE 'clash' END AS _found"
        )
        # Rows that differ but share a key: found by one aggregation, then joined back.
        shared = rows.groupBy(*keys).agg(F.expr("count(1) AS _rows")).filter("_rows > 1")
        state = "CASE WHEN _found = 'new' AND _rows IS NOT NULL THEN 'clash' ELSE _found END AS _state"
        judged = stored(
            met.alias("n").join(shared.alias("o"), F.expr(same_key), "left").selectExpr(*(f"n.`{c}`" for c in columns), "_copies", state), "append-judged"
        )
        new = judged.filter("_state = 'new'").select(*columns)
        counts = judged.selectExpr(
            "count_if(_state = 'new') AS added",
            "coalesce(sum(CASE _state WHEN 'present' THEN _copies WHEN 'new' THEN _copies - 1 ELSE 0 END), 0L) AS present",
            "coalesce(sum(CASE _state WHEN 'clash' THEN _copies ELSE 0 END), 0L) AS clashing",
        ).first()
        judged.filter("_state = 'clash'").select(*columns).write.mode("overwrite").parquet(clashes)
        if counts.added:
            key_filters(new, partition_col, keys, words).write.mode("append").parquet(filters)
            new.repartitionByRange(partition_col, *keys).write.mode("append").partitionBy(partition_col).parquet(data)
    return Appended(counts.added, counts.present, counts.clashing, clashes, tuple(read))
