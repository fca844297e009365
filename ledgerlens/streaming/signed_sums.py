"""Incremental signed sums over a growing folder of clean transactions.

New clean rows arrive as files (e.g. each reconciliation run appends its
accepted rows). Two Structured Streaming forms are offered:

* ``start_daily_partials`` -- every micro-batch is reduced to partial daily sums
  per (login, day) and written under ``batch_id=<n>`` with dynamic partition
  overwrite. A replayed batch (after a failure) overwrites its own partial
  instead of adding it twice, so the sink is exactly-once; sums are
  decomposable, so ``daily_sums`` folds the partials with one aggregation and
  ``rollup_from_daily`` gives months and totals. No state is kept in the
  stream, whatever the number of logins.
* ``windowed_daily_sums`` -- event-time day windows with a watermark: a day's
  sum is emitted once (append mode) after the watermark passes its end; rows
  later than the watermark are dropped by Spark, as usual for late data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerlens import schemas
from ledgerlens.operators import aggregates as agg

CLEAN_SCHEMA = StructType([f for f in schemas.LEDGER.fields])


def read_clean_stream(spark: SparkSession, source_dir: str, schema: StructType = CLEAN_SCHEMA,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(source_dir)


def start_daily_partials(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Stream clean rows into per-batch partial daily sums under ``out_dir``."""
    stream = read_clean_stream(spark, source_dir, max_files_per_trigger=max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        partial = agg.daily_agg(agg.signed_amounts(batch), calculation_ts=False)
        (
            partial.withColumn("batch_id", F.lit(int(batch_id)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(out_dir)
        )

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def daily_sums(spark: SparkSession, out_dir: str) -> DataFrame:
    """Daily signed sums folded from all written partials.

    Partials accumulate one folder per micro-batch; writing this result to a
    table now and then (and starting a new partials folder) keeps the fold
    cheap -- sums are decomposable, so the compacted table plus the newer
    partials give the same sums.
    """
    return (
        spark.read.parquet(out_dir)
        .groupBy("login", "date_from")
        .agg(F.expr(f"CAST(sum(daily_sum) AS {agg.SUM_TYPE}) AS daily_sum"))
    )


def windowed_daily_sums(clean_stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Per (login, day) signed sums, final once the watermark passes the day."""
    signed = agg.signed_amounts(clean_stream).selectExpr(
        "login", "CAST(transaction_ts AS TIMESTAMP) AS event_time", "sign_amount"
    )
    return (
        signed.withWatermark("event_time", watermark)
        .groupBy("login", F.window("event_time", "1 day").alias("w"))
        .agg(F.expr(f"CAST(sum(sign_amount) AS {agg.SUM_TYPE}) AS daily_sum"))
        .selectExpr("login", "to_date(w.start) AS date_from", "daily_sum")
    )
