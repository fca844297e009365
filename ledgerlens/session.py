"""Spark session settings shared by jobs, tests and the benchmark.

Every job runs with the session time zone pinned to UTC (epoch <-> timestamp
conversions depend on it), ANSI mode on, and adaptive query execution enabled so
that joins are re-planned from runtime sizes (broadcast only when the measured
side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``) and skewed
shuffle partitions are split.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this package needs for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that shape the physical plan; a cluster deployment may override them.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.bucketing.enabled": "true",
}


# Fixed sizing targets: bytes per shuffle partition after AQE coalescing, and
# bytes per input split.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
TARGET_SPLIT_BYTES = 256 * 1024 * 1024


def sizing_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Partition settings for a job reading ``input_bytes`` on ``total_cores``.

    Shuffle partitions start at about one per 256 MB of input (at least three
    waves of tasks); AQE then coalesces small ones to the same advisory size
    and splits skewed join partitions over 5x the median. At 100 TB on
    1000 executors x 8 cores this gives ~400k initial partitions.
    """
    initial = max(3 * total_cores, -(-int(input_bytes) // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_SPLIT_BYTES),
    }


def build_session(
    master: str | None = None,
    app_name: str = "ledgerlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the package's required settings.

    ``master`` is only set when given, so that a cluster launcher keeps control.
    With ``input_bytes`` and ``total_cores`` the partition settings come from
    ``sizing_conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**PLAN_CONF, **REQUIRED_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if input_bytes and total_cores:
        conf.update(sizing_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required(spark)
    return spark


def apply_required(spark: SparkSession) -> None:
    """Pin the settings results depend on (safe on an existing session)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def apply_plan_settings(spark: SparkSession) -> None:
    """Apply the plan-shaping settings that a session created elsewhere leaves
    open; what its deployer has set stays."""
    for key, value in PLAN_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach; it is
    read from the session and never replaced. Only when it is unset (local
    tests) a fresh folder is created and registered as the checkpoint folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name storage every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# The scratch folders of the open ``scratch`` blocks, innermost last.
_SCRATCH: ContextVar[tuple[str, ...]] = ContextVar("ledgerlens_scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables that operators write between steps go to one folder under the
    shared folder, which is removed when the block ends, by success or failure.
    Frames made inside read those tables lazily: write or collect them inside."""
    path = scratch_path(spark, "scratch")
    token = _SCRATCH.set((*_SCRATCH.get(), path))
    try:
        yield path
    finally:
        _SCRATCH.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder for a written table: of the open ``scratch``
    block, or else of the shared folder, where it stays."""
    import uuid

    base = (_SCRATCH.get() or (shared_dir(spark).rstrip("/"),))[-1]
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under ``scratch_path`` and read back: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
