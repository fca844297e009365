"""File table layouts: date-partitioned, bucketed, and a second bucketed copy.

* ``write_partitioned`` -- one folder per date; a filter on that date reaches
  the scan as ``PartitionFilters`` and skips whole folders. Overwrites only the
  dates present in the written data (dynamic partition overwrite), so a
  re-run replaces its own output instead of appending it again.
* ``write_bucketed`` -- rows hashed into a fixed number of buckets by a key
  and sorted within each bucket; joins and aggregations on that key between
  tables with the same bucket count need no shuffle.
* ``write_copy`` -- the same rows (or a column subset) bucketed by another
  key, for joins on that key.

Tables are written under a path (on a cluster: the shared folder named by
``spark.checkpoint.dir`` or a warehouse); bucketed tables are registered in
the session catalog since bucket metadata lives there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str,
    source_expr: str | None = None,
    cluster_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    fmt: str = "parquet",
    dynamic: bool = True,
) -> None:
    """Write ``df`` partitioned by ``partition_col`` (derived from
    ``source_expr``, e.g. ``to_date(transaction_ts)``, when given).

    With ``cluster_by`` the rows are first range-partitioned on
    (partition_col, *cluster_by): each date goes to few files, and a date
    holding a large share of the rows is split over several tasks along the
    second key instead of landing in one.

    ``dynamic=True`` replaces only the partitions present in ``df`` (a run
    owns the dates it writes); ``dynamic=False`` replaces the whole table.
    """
    out = df if source_expr is None else df.withColumn(partition_col, F.expr(source_expr))
    if cluster_by:
        out = out.repartitionByRange(partition_col, *cluster_by)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.partitionBy(partition_col).format(fmt).save(path)


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    key: str | Sequence[str],
    buckets: int,
    sort_by: str | Sequence[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Write a table hashed into ``buckets`` by ``key``, sorted within
    buckets, registered as ``table`` at ``path``; returns the table."""
    keys = [key] if isinstance(key, str) else list(key)
    sorts = keys if sort_by is None else ([sort_by] if isinstance(sort_by, str) else list(sort_by))
    (
        # One task a bucket: otherwise every task writes a file into each bucket.
        df.repartition(int(buckets), *keys)
        .write.mode("overwrite")
        .format(fmt)
        .bucketBy(int(buckets), keys[0], *keys[1:])
        .sortBy(sorts[0], *sorts[1:])
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def write_copy(
    df: DataFrame,
    table: str,
    path: str,
    key: str,
    buckets: int,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A second copy of a table (or of some of its columns), bucketed by
    another key for joins on that key."""
    subset = df if columns is None else df.select(*columns)
    return write_bucketed(subset, table, path, key, buckets)
