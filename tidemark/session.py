"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings the operators count on. AQE coalesces small shuffles, splits skewed join partitions and switches a
#: join to broadcast only once the measured size of a side is below the threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # many groups with short lists each: hash them instead of sorting the whole partition
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


#: Whether the shuffle files of a SQL execution go at its end.
SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Narrow rows up to which a join side is broadcast.
BROADCAST_ROWS = 100_000


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; `master` only for local runs, a cluster supplies its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of :data:`SETTINGS` to a session somebody else built."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a private one only where none is configured."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-checkpoint-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(named)
    return named


def measured(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for a broadcast if it has no more than `rows` (narrow) rows; beyond that the join stays a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of the executors that computed them."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_once(df: DataFrame) -> DataFrame:
    """`df` as Parquet files below the checkpoint folder, read back: for wide rows that are dear to compute and read several times,
    and that take a fraction of a checkpoint's space as compressed columns. Shuffle files of the write go when it has ended; nothing
    else reads them."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_REMOVED, None)
    spark.conf.set(SHUFFLES_REMOVED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_REMOVED) if before is None else spark.conf.set(SHUFFLES_REMOVED, before)
    return spark.read.schema(df.schema).parquet(path)
