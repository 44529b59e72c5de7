"""Streaming jobs run to completion over the event and order files, then read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.records_queries import scratch, write_raw
from tidemark.plans.registry import query, rounded
from tidemark.sources.records import record_table
from tidemark.streaming import jobs as J
from tidemark.streaming import sightings as S


def _stream(t, name: str):
    """The table's file as a stream source."""
    reader = t.spark.readStream.schema(t.read(name).schema)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(t.folder)


@query(
    "r1_incremental_compaction",
    """SELECT dt, COUNT(*) AS n, ROUND(SUM(metric), 4) AS total FROM records GROUP BY dt""",
)
def incremental_compaction(t):
    root = write_raw(t, "r1")
    J.incremental_compaction(t.spark, root, "func_preproc", scratch(t, "r1-checkpoint")).awaitTermination()
    table = record_table("func_preproc")
    stored = t.spark.read.schema(table.partitioned_schema).parquet(table.compacted_path(root))
    return rounded(stored.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("mean_fd").alias("total")), 4)


def _feed(t, name: str, columns):
    """The events as a feed in two deliveries, the second after the first was worked off: the job is started again from its
    checkpoint. `columns` are selected from each row; `arrival` is the time the row's file was written."""
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    middle = events.agg(F.expr("timestamp_micros((min(unix_micros(ts)) + max(unix_micros(ts))) div 2)").alias("m")).first()["m"]
    path = scratch(t, name)
    for part, rows in (("a", F.col("ts") <= F.lit(middle)), ("b", (F.col("ts") > F.lit(middle)) | F.col("ts").isNull())):
        events.filter(rows).write.parquet(f"{path}/part={part}")
        stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(f"{path}/part=*")
        yield stream.select(*columns, F.col("_metadata.file_modification_time").alias("arrival"))


def _sightings(t, name: str, keys, columns, last: bool):
    path, checkpoint = scratch(t, f"{name}-out"), scratch(t, f"{name}-checkpoint")
    for stream in _feed(t, name, columns):
        best = S.best_sightings(stream, keys, "ts", "finished", "arrival", ["event_id"], last, keep="1 second")
        S.run_sightings(best, path, checkpoint).awaitTermination()
    return S.read_sightings(t.spark, path, keys, "ts", "finished", ["event_id"], last)


@query(
    "r2_most_complete_sighting",
    """
    SELECT user_id, event_id, finished, sightings FROM (SELECT user_id, event_id, CASE WHEN value > 40 THEN value END AS finished, COUNT(*) OVER (PARTITION BY user_id) AS sightings,
        ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value > 40 DESC, ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def most_complete_sighting(t):
    """One row per key over the whole feed: a later sighting replaces it only if it is at least as complete."""
    columns = ["user_id", "event_id", "ts", F.when(F.col("value") > 40, F.col("value")).alias("finished")]
    return _sightings(t, "r2", ["user_id"], columns, True).select("user_id", "event_id", "finished", "sightings")


@query(
    "r3_snapshot_dedupe",
    """
    SELECT event_type, k, event_id, has_end, sightings FROM (SELECT event_type, k, event_id, value > 40 AS has_end, COUNT(*) OVER (PARTITION BY event_type, k) AS sightings,
        ROW_NUMBER() OVER (PARTITION BY event_type, k ORDER BY value > 40 DESC, ts, event_id) AS rn FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)) WHERE rn = 1""",
)
def snapshot_dedupe(t):
    """Repeats of one (id, start) collapse to the first sighting that has its end, else to the first."""
    columns = [
        "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"), "event_id", "ts", F.when(F.col("value") > 40, F.col("value")).alias("finished"),
    ]
    rows = _sightings(t, "r3", ["event_type", "k"], columns, False)
    return rows.select("event_type", "k", "event_id", F.col("finished").isNotNull().alias("has_end"), "sightings")


@query(
    "r4_hourly_costs",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, ROUND(SUM(value), 4) AS value, COUNT(*) AS n_rows FROM events GROUP BY ALL""",
)
def hourly_costs(t):
    stream = _stream(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    hours = J.hourly_costs(stream, "ts", ["event_type"], ["value"])
    path = scratch(t, "r4")
    J.write_updates(hours.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH")), path, scratch(t, "r4-checkpoint")).awaitTermination()
    return rounded(J.read_updates(t.spark, path, ["hour", "event_type"]).select("hour", "event_type", "value", "n_rows"), 4)


@query(
    "r5_settled_upsert",
    """
    SELECT date, subject, scrape_age_days, workflow_name FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, subject ORDER BY scrape_age_days DESC, workflow_name DESC) AS rn FROM
        (SELECT substr(date, 1, 7) AS date, subject, scrape_age_days, workflow_name FROM costs)) WHERE rn = 1""",
)
def settled_upsert(t):
    """Re-scraped cost rows: per (month, subject) the oldest scrape wins."""
    stream = _stream(t, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("date"), F.col("o_custkey").alias("subject"), (F.col("o_orderkey") % 4).alias("scrape_age_days"),
        F.col("o_orderkey").cast("string").alias("workflow_name"),
    )
    path = scratch(t, "r5")
    J.settled_upsert(stream, path, scratch(t, "r5-checkpoint"), ["date", "subject"]).awaitTermination()
    return t.spark.read.schema("subject BIGINT, scrape_age_days BIGINT, workflow_name STRING, date STRING").parquet(path)
