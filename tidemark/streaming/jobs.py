"""Incremental ingest and rollups as Structured Streaming jobs.

All jobs are restartable from their checkpoint. `foreachBatch` sinks replace whole keys or partitions, so a batch that runs
twice leaves the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.costs import partial_read_guard
from tidemark.operators.latest import latest
from tidemark.schemas import record_table
from tidemark.sources.compaction import compact_days, path_exists


def incremental_compaction(
    spark: SparkSession, root: str, table: str, checkpoint: str, available_now: bool = True, files_per_trigger: int = 100_000
) -> StreamingQuery:
    """Watch the raw records of a table and rebuild every day that got new files, whole, from raw.

    A late record for a closed day rebuilds that day; a micro-batch never appends to compacted data."""
    t = record_table(table)
    stream = (
        spark.readStream.schema(t.partitioned_schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(t.raw_path(root))
        .select("dt")
    )

    def rebuild(batch: DataFrame, _: int) -> None:
        days = [r["dt"] for r in batch.distinct().collect()]  # dates touched by the batch
        if days:
            compact_days(batch.sparkSession, root, table, days)

    writer = stream.writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def hourly_costs(stream: DataFrame, event_time: str, keys: Sequence[str], amounts: Sequence[str], watermark: str = "2 hours") -> DataFrame:
    """Hourly cost windows; rows are taken up to `watermark` behind the newest one.

    A later row is not in its hour: :func:`late_rows` counts those, and `costs.hourly_to_day` over the stored rows of the day
    is the batch form that repairs it."""
    return (
        stream.withWatermark(event_time, watermark)
        .groupBy(F.window(event_time, "1 hour"), *keys)
        .agg(*[F.sum(a).alias(a) for a in amounts], F.count(F.lit(1)).alias("n_rows"))
        .select(F.col("window.start").alias("hour"), *keys, *amounts, "n_rows")
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, over the micro-batches whose progress the query still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def write_updates(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = True, mode: str = "update"
) -> StreamingQuery:
    """Write the changed rows of each micro-batch under its batch number; :func:`read_updates` keeps the newest per key.

    Overwriting the batch's own folder makes a repeated batch harmless."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:012d}")

    writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of each key over the written batches."""
    return latest(spark.read.option("basePath", path).parquet(f"{path}/batch=*"), list(keys), "batch").drop("batch")


class PartialScrape(ValueError):
    """A batch declared whole is too short to replace settled figures."""


def settled_upsert(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], age: str = "scrape_age_days", day: str = "date",
    guard_key: str = "workflow_name", floor: float = 0.5, full_scrape: bool = False, tie: Sequence[str] | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Cost re-scrapes: per key the oldest scrape wins, ties by `tie` (all other columns in name order if not given). Days
    that a batch touches are rewritten with the stored rows merged in, so a late row of a day changes nothing else.

    With `full_scrape` every batch is declared to be a whole scrape of its days. One that carries far fewer workflows for
    them than are stored raises :class:`PartialScrape`, so its offset is not committed and it is read again."""

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        new = batch
        if path_exists(spark, path):
            stored = spark.read.schema(batch.schema).parquet(path).join(batch.select(day).distinct(), day, "left_semi")
            if full_scrape and partial_read_guard(batch, stored, guard_key, floor).first()["refuse"]:
                raise PartialScrape(f"batch {number} holds less than {floor:g} of the stored workflows of its days")
            new = stored.unionByName(batch)
        merged = latest(new, list(keys), age, list(tie) if tie is not None else sorted(c for c in batch.columns if c not in (*keys, age)))
        staging = f"{path}_staging/batch={number:012d}"
        merged.write.mode("overwrite").parquet(staging)  # read from `path` must be over before `path` is replaced
        rows = spark.read.schema(batch.schema).parquet(staging)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)

    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
