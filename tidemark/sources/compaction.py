"""Compaction of raw JSON days into partitioned Parquet, and the repairs that keep both in agreement.

Raw is the authority. A day is always rebuilt whole from raw into (dt, schema_version) partitions, never merged, so a
run can be repeated and a lost executor only repeats its tasks. Nothing is written from a read that is incomplete.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import TABLE_NAMES, record_table
from tidemark.sources.records import CORRUPT, scan_raw_counting, version_or_unknown

PARTITIONS = ("dt", "schema_version")


@dataclass
class CompactionReport:
    """Rows written per (dt, schema_version), days left alone and partitions emptied."""

    written: dict[tuple[str, str], int] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    emptied: list[tuple[str, str]] = field(default_factory=list)


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def stored_partitions(spark: SparkSession, path: str, days: Iterable[str]) -> set[tuple[str, str]]:
    """(dt, schema_version) folders that exist for the days, from folder names alone: no file is opened."""
    found = set()
    for dt in days:
        hadoop, fs = _path(spark, f"{path}/dt={dt}")
        if not fs.exists(hadoop):
            continue
        for status in fs.listStatus(hadoop):
            name = status.getPath().getName()
            if name.startswith("schema_version="):
                found.add((dt, name.split("=", 1)[1]))
    return found


def write_partitions(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Replace exactly the partitions present in `df`. AQE sizes the tasks; a big partition becomes several files."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "zstd")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def empty_partitions(spark: SparkSession, path: str, partitions: Iterable[tuple[str, str]], schema) -> None:
    """Make partitions read as no rows, keeping their folder and schema.

    One file without rows is written and copied into each folder once its data files are gone, so many partitions cost file
    system calls and no Spark job. A stop in between leaves a folder without files, which reads as no rows too."""
    partitions = list(partitions)
    if not partitions:
        return
    data_fields = [f for f in schema.fields if f.name not in PARTITIONS]
    model = f"{path.rstrip('/')}_empty/{uuid.uuid4().hex}"
    spark.createDataFrame([], type(schema)(data_fields)).coalesce(1).write.parquet(model)
    source, fs = _path(spark, model)
    files = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")]
    conf, util = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil
    for dt, version in partitions:
        folder, _ = _path(spark, f"{path}/dt={dt}/schema_version={version}")
        for status in fs.listStatus(folder):
            fs.delete(status.getPath(), True)
        for file in files:
            util.copy(fs, file, fs, folder, False, conf)
    fs.delete(source, True)


def compact_days(
    spark: SparkSession, root: str, table: str, days: Sequence[str], compacted_path: str | None = None
) -> CompactionReport:
    """Rebuild the compacted partitions of some days of one table from raw.

    A day without raw records, or with an unreadable one, is left as it is: an empty listing may be a flush, and a short
    read must not shrink a complete day. A version raw no longer has is emptied."""
    t = record_table(table)
    report = CompactionReport()
    raw_path, out_path = t.raw_path(root), compacted_path or t.compacted_path(root)
    days = sorted(set(days))
    if not path_exists(spark, raw_path):
        report.skipped = {d: "no raw records" for d in days}
        return report
    raw = version_or_unknown(scan_raw_counting(spark, root, table).filter(F.col("dt").isin(days)))
    # one pass decides which days are whole; the corrupt column must be read with data columns
    seen = (
        raw.groupBy(*PARTITIONS)
        .agg(F.count(F.lit(1)).alias("n"), F.count(CORRUPT).alias("bad"), F.max("pipeline").alias("_data"))
        .collect()  # one row per (day, version) of the listed days
    )
    bad = {r["dt"] for r in seen if r["bad"]}
    good = sorted({r["dt"] for r in seen} - bad)
    for d in days:
        if d in bad:
            report.skipped[d] = "unreadable raw records"
        elif d not in good:
            report.skipped[d] = "no raw records"
    if not good:
        return report
    before = stored_partitions(spark, out_path, good)
    report.written = {(r["dt"], r["schema_version"]): r["n"] for r in seen if r["dt"] in good}
    rows = raw.filter(F.col("dt").isin(good)).drop(CORRUPT)
    # AQE splits a day that is too big for one task and joins the small ones, by measured size
    write_partitions(rows.hint("rebalance", F.col("dt"), F.col("schema_version")), out_path)
    report.emptied = sorted(before - set(report.written))
    empty_partitions(spark, out_path, report.emptied, t.partitioned_schema)
    return report


def compact_lookback(
    spark: SparkSession, root: str, today: str, lookback: int = 3, tables: Sequence[str] = TABLE_NAMES
) -> Mapping[str, CompactionReport]:
    """Compact the last closed days of several tables. Today is still being written and is never compacted."""
    row = spark.sql(
        f"SELECT transform(sequence(1, {int(lookback)}), i -> date_format(date_sub(to_date('{today}'), i), 'yyyy-MM-dd')) d"
    ).first()
    return {name: compact_days(spark, root, name, row["d"]) for name in tables}


class UnattributableRows(ValueError):
    """The identifying column is missing, so no row can be matched."""


def drop_rows(df: DataFrame, columns: Sequence[str], values: DataFrame, complement: bool = False) -> DataFrame:
    """Rows that stay when the listed (composite) keys are removed, or with `complement` when only they are kept.

    A row with a NULL in any part has no identity and always stays, either way round."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise UnattributableRows(f"no column {', '.join(missing)}: rows cannot be attributed")
    keys = values.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in columns]).distinct()
    if not complement:
        return df.join(keys, list(columns), "left_anti")  # NULL equals nothing, so it is never in the list
    anonymous = F.lit(False)
    for c in columns:
        anonymous = anonymous | F.col(c).isNull()
    listed = df.join(keys.withColumn("_listed", F.lit(True)), list(columns), "left")
    return listed.filter(F.col("_listed").isNotNull() | anonymous).select(*df.columns)


def reconcile(compacted: DataFrame, raw: DataFrame, proven: DataFrame, key: str = "workflow_name") -> DataFrame:
    """Compacted rows after keeping, on days raw was read whole, only what raw still holds; other days are untouched."""
    on = ["dt", key]
    held = raw.select(*on).distinct().withColumn("_held", F.lit(True))
    sure = proven.select("dt").distinct().withColumn("_sure", F.lit(True))
    marked = compacted.join(sure, "dt", "left").join(held, on, "left")
    stays = F.col("_sure").isNull() | F.col("_held").isNotNull() | F.col(key).isNull()
    return marked.filter(stays).select(*compacted.columns)


def flush_subjects(
    df: DataFrame, subjects: DataFrame, index: DataFrame | None = None, subject: str = "subject", key: str = "workflow_name"
) -> DataFrame:
    """Rows left after flushing some subjects. A table without a subject column goes through a workflow → subject index;
    a workflow shared with a subject that stays is kept."""
    if subject in df.columns:
        return drop_rows(df, [subject], subjects.select(F.col(subjects.columns[0]).alias(subject)))
    if index is None:
        raise UnattributableRows(f"no column {subject} and no index to reach it through {key}")
    flushed = subjects.select(F.col(subjects.columns[0]).alias(subject)).withColumn("_gone", F.lit(True)).distinct()
    per_workflow = index.join(flushed, subject, "left").groupBy(key).agg(F.bool_and(F.col("_gone").isNotNull()).alias("_all"))
    return drop_rows(df, [key], per_workflow.filter("_all").select(key))


def rewrite_partitions(
    spark: SparkSession, path: str, schema: T.StructType, keep: Callable[[DataFrame], DataFrame], staging: str
) -> list[tuple[str, str]]:
    """Apply a row rule (:func:`drop_rows`, :func:`reconcile`, :func:`flush_subjects`) to a compacted tree in place.

    The rows that stay are staged as a table first, so that no partition is read while it is replaced and a lost executor
    cannot need a file that is already gone. Only partitions that lost rows are replaced, those that lost all are emptied; the
    staged table is removed once that is done. Returns the partitions touched; one count per partition reaches the driver."""
    stored = spark.read.schema(schema).parquet(path)
    keep(stored).select(*stored.columns).write.mode("overwrite").partitionBy(*PARTITIONS).parquet(staging)
    staged = spark.read.schema(schema).parquet(staging)

    def sizes(df: DataFrame) -> dict[tuple[str, str], int]:
        return {(r["dt"], r["schema_version"]): r["n"] for r in df.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n")).collect()}

    before, after = sizes(stored), sizes(staged)
    touched = sorted(p for p, n in before.items() if after.get(p, 0) != n)
    part = F.struct(F.col("dt"), F.col("schema_version"))
    rewritten = [F.struct(F.lit(d), F.lit(v)) for d, v in touched if (d, v) in after]
    if rewritten:
        rows = staged.filter(F.col("dt").isin(sorted({d for d, _ in touched})) & part.isin(rewritten))
        write_partitions(rows.hint("rebalance", F.col("dt"), F.col("schema_version")), path)
    empty_partitions(spark, path, [p for p in touched if p not in after], schema)
    folder, fs = _path(spark, staging)
    fs.delete(folder, True)
    return touched


__all__ = [
    "CompactionReport", "UnattributableRows", "compact_days", "compact_lookback", "drop_rows",
    "empty_partitions", "flush_subjects", "reconcile", "rewrite_partitions", "stored_partitions", "write_partitions",
]
