"""File sources: Parquet and headerless CSV copies of a transaction source.

Readers pass an explicit schema, so no file footer or sample is read on the
driver to infer one, and a file with missing or extra columns fails loudly
(or is cast) instead of silently changing the row hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.schemas import SECOND_SOURCE
from ledgerlens.session import scratch, stored

CORRUPT = "_corrupt_line"


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Parquet scan (optionally with a fixed schema); filters and column
    selections applied later reach the scan as ``PushedFilters`` / ``ReadSchema``."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def read_source_csv(
    spark: SparkSession,
    path: str,
    schema: StructType = SECOND_SOURCE,
    empty_comment_as: str | None = "",
) -> DataFrame:
    """S3: headerless CSV copy of a source (``""`` marks an empty or missing value).

    A quoted empty field reads as NULL; ``empty_comment_as`` (default ``''``)
    restores the text so that row hashes agree with a source holding ``''``.
    Pass ``None`` to keep NULL.
    """
    df = _csv(spark, path, schema, "FAILFAST")
    return _with_empty_comments(df, empty_comment_as)


def _csv(spark: SparkSession, path: str, schema: StructType, mode: str) -> DataFrame:
    reader = spark.read.schema(schema).option("header", "false").option("mode", mode).option("nullValue", "")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def _with_empty_comments(df: DataFrame, empty_comment_as: str | None) -> DataFrame:
    if empty_comment_as is not None and "comment" in df.columns:
        escaped = empty_comment_as.replace("'", "\\'")
        df = df.selectExpr(*[f"coalesce(comment, '{escaped}') AS comment" if c == "comment" else c for c in df.columns])
    return df


@dataclass(frozen=True)
class CsvLoad:
    """Paths of the parsed rows and of the lines that do not parse, and their counts."""

    rows: str
    quarantine: str
    loaded: int
    rejected: int


def load_source_csv(
    spark: SparkSession, path: str, out_dir: str, schema: StructType = SECOND_SOURCE, empty_comment_as: str | None = ""
) -> CsvLoad:
    """S3: load a headerless CSV copy whose lines need not all parse.

    Lines with a value of the wrong type, or with missing or extra columns, go to
    ``<out_dir>/quarantine`` (line, file) as they are; all others to ``<out_dir>/rows``.
    The text is read once, into a scratch table that both tables and their counts
    come from, so loaded + rejected is the number of lines (blank lines are none).
    Both tables are replaced by each run."""
    base = out_dir.rstrip("/")
    out = f"{base}/rows", f"{base}/quarantine"
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    with scratch(spark):
        parsed = _csv(spark, path, wide, "PERMISSIVE").withColumn("_file", F.expr("input_file_name()"))
        # Written first: a scan for the corrupt column alone would not parse the others.
        kept = stored(parsed.withColumn("_bad", F.expr(f"{CORRUPT} IS NOT NULL")), "csv-lines")
        rows = _with_empty_comments(kept.filter("NOT _bad").select(*schema.names), empty_comment_as)
        rows.write.mode("overwrite").parquet(out[0])
        bad = kept.filter("_bad").selectExpr(f"{CORRUPT} AS line", "_file AS file")
        bad.write.mode("overwrite").parquet(out[1])
        counts = kept.agg(F.expr("count_if(NOT _bad) AS loaded"), F.expr("count_if(_bad) AS rejected")).first()
    return CsvLoad(*out, counts.loaded, counts.rejected)


def write_source_csv(df: DataFrame, path: str) -> None:
    """Write a source as headerless CSV with every missing or empty text as ``""``."""
    (
        df.write.mode("overwrite")
        .option("header", "false")
        .option("nullValue", "")
        .option("emptyValue", '""')
        .csv(path)
    )
