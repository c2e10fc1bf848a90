"""Session settings and lineage control shared by every job."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Results depend on the first two; the rest keep joins on hot keys and small stages in shape.
RUNTIME_OPTIONS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows take some 15 times their shuffled bytes while they are sorted and grouped.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot taxpayer or neighbourhood must be split even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Checkpoints go when nothing refers to them any more; only a new session can be told so, as of the order of jobs.
# Fair scheduling lets models that are trained side by side share the cores.
BUILD_OPTIONS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true", "spark.scheduler.mode": "FAIR"}


def build_session(app: str = "arrears", master: str | None = None, **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_OPTIONS, **BUILD_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime options to a session someone else created."""
    for key, value in RUNTIME_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_A_PARTITION = 4 << 20  # of compressed input


def spread_exchanges(spark: SparkSession, size: int) -> int:
    """Let exchanges begin with as many partitions as an input of that many bytes needs; small ones are merged at run time.

    With a fixed number a task's share, and the memory it sorts and groups in, would grow with the input.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BYTES_A_PARTITION))
    spark.conf.set(FIRST_PARTITIONS, str(parts))
    return parts


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names; there is no substitute for it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for frames that an iterative trainer scans many times.

    Training then restarts from files, not from the source joins, when an executor is lost.
    """
    spark = df.sparkSession
    folder = checkpoint_folder(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def training_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows written once for a trainer that scans them dozens of times, dealt evenly over the cores by their key.

    Without the exchange a small or coalesced input would leave every pass to one task.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return cut_lineage(df.repartition(parts, *key))


ROWS_A_TASK = 1_000_000
TIE = "_vez"  # deals rows that are alike in every column


def tasks_for(rows: int, cores: int) -> int:
    """A task for every core, or for every ``ROWS_A_TASK`` rows if those are more."""
    return max(cores, math.ceil(rows / ROWS_A_TASK))


def neighbouring_rows(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> tuple[DataFrame, int]:
    """Rows written once in the order of their features, those with few values first, and how many they are.

    A deep tree has more nodes than a core's cache holds, and a pass looks up the node of every row: neighbours in
    this order mostly share their nodes. Any order is as good a sample for the trainer.
    """
    counted = df.agg(F.count(F.lit(1)), *[F.approx_count_distinct(c) for c in columns]).first()
    order = [c for _, c in sorted(zip(counted[1:], columns), key=lambda pair: pair[0])]
    parts = tasks_for(counted[0], df.sparkSession.sparkContext.defaultParallelism)
    dealt = df.withColumn(TIE, F.rand(0)).repartitionByRange(parts, *order, TIE).sortWithinPartitions(*order, TIE)
    return cut_lineage(dealt.select(*dict.fromkeys(keep))), counted[0]
