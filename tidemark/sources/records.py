"""Raw JSON records: scan, filter, write, re-partition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import day, micros
from tidemark.operators.latest import hybrid_read
from tidemark.schemas import UNKNOWN_VERSION, record_table

CORRUPT = "_corrupt_record"


def scan_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All raw records of a table. The superset schema is declared, so nothing is inferred, a column an older record
    lacks reads NULL, and `dt` comes from the folder names as a string (so it prunes without a cast)."""
    t = record_table(table)
    return spark.read.schema(t.partitioned_schema).json(t.raw_path(root))


def scan_raw_counting(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Raw records with the unreadable lines kept in :data:`CORRUPT`, one record per line."""
    t = record_table(table)
    schema = T.StructType([*t.partitioned_schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(t.raw_path(root))


def read_json_or_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of files that hold either one JSON object (perhaps over several lines) or one object per line.

    Per file: the whole text is tried strictly as one object first; where that fails, each line that is not blank is read by
    itself. Adds `_file`, and :data:`CORRUPT` for every line that is no object (for the text of a file that is blank: nothing)."""
    whole = spark.read.text(path, wholetext=True).select(F.col("value").alias("_text"), F.input_file_name().alias("_file"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = F.filter(F.split("_text", r"\r?\n"), lambda line: F.trim(line) != "")
    # in brackets, text behind the object makes the parse fail, and a second object is a second element
    single = F.try_parse_json(F.concat(F.lit("["), F.col("_text"), F.lit("]")))
    alone = single.isNotNull() & F.try_variant_get(single, "$[1]", "variant").isNull()
    whole_object = F.coalesce(F.ltrim(F.regexp_replace("_text", r"^\s+", "")).startswith("{") & alone, F.lit(False))
    parts = F.when(whole_object, F.array(F.trim("_text"))).otherwise(lines)
    parsed = whole.select("_file", F.explode(parts).alias("_part")).select(
        "_file", F.from_json("_part", with_bad, options).alias("_r")
    )
    return parsed.select("_file", "_r.*")


def unreadable_count(df: DataFrame) -> int:
    return df.filter(F.col(CORRUPT).isNotNull()).count()


def filter_table(
    df: DataFrame,
    filters: Mapping | None = None,
    dt_from: str | None = None,
    dt_to: str | None = None,
    newest_first: str | None = "completed_at",
) -> DataFrame:
    """Equality filters and inclusive `dt` window; newest first where the table has the time column."""
    for name, value in (filters or {}).items():
        df = df.filter(F.col(name) == value)
    if dt_from:
        df = df.filter(F.col("dt") >= dt_from)
    if dt_to:
        df = df.filter(F.col("dt") <= dt_to)
    if newest_first and newest_first in df.columns:
        df = df.orderBy(F.desc(newest_first))
    return df


def query_table(
    spark: SparkSession, root: str, table: str, dt_from: str | None = None, dt_to: str | None = None,
    compacted: bool = False, today: str | None = None, **filters,
) -> DataFrame:
    """The accessor every table has: raw only, or today's raw and older compacted days."""
    t = record_table(table)
    raw = scan_raw(spark, root, table)
    if compacted:
        if today is None:
            raise ValueError("a compacted read needs the date of today")
        stored = spark.read.schema(t.partitioned_schema).option("mergeSchema", "false").parquet(t.compacted_path(root))
        raw = hybrid_read(raw, stored, today, [f.name for f in t.partitioned_schema.fields])
    return filter_table(raw, filters, dt_from, dt_to, t.time_column)


def event_window(df: DataFrame, time_us: str, start: str, end: str, partition: str = "dt") -> DataFrame:
    """Half-open event-time filter on top of a partition window a day wider: a record may be written the day after."""
    first = F.date_format(F.date_sub(F.to_date(F.lit(start)), 1), "yyyy-MM-dd")
    last = F.date_format(F.date_add(F.to_date(F.lit(end)), 1), "yyyy-MM-dd")
    lo, hi = (micros(F.to_timestamp(F.lit(x))) for x in (start, end))
    return df.filter(F.col(partition).between(first, last)).filter((F.col(time_us) >= lo) & (F.col(time_us) < hi))


def write_records(df: DataFrame, path: str, mode: str = "append") -> None:
    """Compact single-line JSON, one object per line, under `dt=`. NULL fields are kept, so a reader sees every column."""
    df.write.mode(mode).option("ignoreNullFields", "false").partitionBy("dt").json(path)


def scan_snapshots(spark: SparkSession, path: str, pod_fields: str) -> DataFrame:
    """Gzipped line-JSON snapshots, one workflow per line with its nested pods; one row per pod."""
    schema = f"workflow STRING, subject STRING, pods ARRAY<STRUCT<{pod_fields}>>"
    rows = spark.read.schema(schema).json(path)
    return rows.select("workflow", "subject", F.inline("pods"))


def with_path(df: DataFrame, out: str = "path", per_object: str | None = "rows_in_object") -> DataFrame:
    """Source path of each row, and how many rows its object holds."""
    df = df.withColumn(out, F.col("_metadata.file_path"))
    if per_object is None:
        return df
    counts = df.groupBy(out).agg(F.count(F.lit(1)).alias(per_object))
    return df.join(counts, out)


def rekey_by_time(df: DataFrame, time: str, fallback: str | None = None) -> DataFrame:
    """Put each record under the date of its own time instead of the folder it was found in."""
    own = day(F.try_to_timestamp(F.col(time)))
    return df.withColumn("dt", F.coalesce(own, F.col(fallback)) if fallback else own)


def version_or_unknown(df: DataFrame, column: str = "schema_version") -> DataFrame:
    named = F.when(F.coalesce(F.col(column), F.lit("")) != "", F.col(column)).otherwise(F.lit(UNKNOWN_VERSION))
    return df.withColumn(column, named)
