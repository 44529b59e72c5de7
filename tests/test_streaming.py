"""Stateful jobs over deliveries of files, started anew from their checkpoint between them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import jobs, sightings

SCHEMA = "pod string, start string, at timestamp, finish string, host string, arrival timestamp"
UTC = dt.timezone.utc


def when(day, hour, minute=0):
    return dt.datetime(2026, 3, day, hour, minute, tzinfo=UTC)


# deliveries: (pod, start, seen at, end, host, arrival)
DELIVERIES = [
    [("a", "s1", when(1, 23, 50), None, "h1", when(1, 23, 55)), ("b", "s1", when(1, 23, 51), "done", "h2", when(1, 23, 55))],
    # the same start after midnight, now with its end; another start of pod a stays apart
    [("a", "s1", when(2, 0, 10), "end", "h1", when(2, 0, 15)), ("a", "s2", when(2, 0, 10), None, None, when(2, 0, 15)), (None, None, when(2, 0, 10), None, "h", when(2, 0, 15))],
    [("c", "s1", when(9, 1), "end", "h3", when(9, 1))],
    [("c", "s1", when(9, 2), "again", "h3", when(9, 2))],  # the states of the first days are gone by now
    # late and less complete, and late and equally complete
    [("a", "s1", when(2, 0, 5), None, "thin", when(9, 3)), ("b", "s1", when(2, 0, 20), "redone", "h2", when(9, 3))],
]


@pytest.mark.parametrize("last", [True, False])
def test_a_key_is_one_row_over_days_and_restarts(spark, tmp_path, last):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    finals = 0
    for number, rows in enumerate(DELIVERIES):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{source}/part={number}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{source}/part=*")
        best = sightings.best_sightings(stream, ["pod", "start"], "at", "finish", "arrival", ["host"], last, keep="12 hours")
        sightings.run_sightings(best, out, checkpoint).awaitTermination()
    finals = spark.read.parquet(f"{out}/batch=*").filter("final").count()
    assert finals >= 3  # a/s1, b/s1 and a/s2 were let go by the timer
    got = sightings.read_sightings(spark, out, ["pod", "start"], "at", "finish", ["host"], last)
    rows = {(r["pod"], r["start"]): (r["finish"], r["host"], r["sightings"], r["returns"]) for r in got.collect()}
    assert rows == {
        ("a", "s1"): ("end", "h1", 3, 1),
        ("b", "s1"): ("redone" if last else "done", "h2", 2, 1),
        ("a", "s2"): (None, None, 1, 0),
        (None, None): (None, "h", 1, 0),
        ("c", "s1"): ("again" if last else "end", "h3", 2, 0),
    }


def test_a_hot_key_leaves_each_batch_as_one_row(spark):
    rows = spark.range(10_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("pod"),
        F.timestamp_seconds("id").alias("at"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("end"),
    ).coalesce(1)
    combined = sightings._combined(rows, ["pod"], ["at"], "end", True)
    got = combined.groupBy("pod").agg(F.count("*").alias("n"), F.sum("sightings").alias("s"), F.max("end").alias("end")).collect()
    assert sum(r["s"] for r in got) == 10_000 and sum(r["n"] for r in got) < 20
    assert {r["pod"]: r["end"] for r in got}["hot"] == max(i for i in range(10_000) if i % 7 == 0 and i % 3)


def test_small_arrow_batches_are_put_together(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "100")
    try:
        rows = spark.range(5_000).select(F.lit("hot").alias("pod"), F.timestamp_seconds("id").alias("at"), F.col("id").alias("end")).coalesce(1)
        got = sightings._combined(rows, ["pod"], ["at"], "end", True).collect()
        assert [(r["sightings"], r["end"]) for r in got] == [(5_000, 4_999)]
    finally:
        spark.conf.set(name, before)


def test_late_rows_are_counted(spark, tmp_path):
    schema = "ts timestamp, kind string, usd double"
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    late = 0
    for number, day in enumerate([1, 5, 5, 1]):
        spark.createDataFrame([(when(day, number), "x", 1.0)], schema).coalesce(1).write.parquet(f"{source}/part={number}")
        hours = jobs.hourly_costs(spark.readStream.schema(schema).parquet(f"{source}/part=*"), "ts", ["kind"], ["usd"])
        query = jobs.write_updates(hours, out, checkpoint)
        query.awaitTermination()
        late += jobs.late_rows(query)
    assert late == 1
    assert jobs.read_updates(spark, out, ["hour", "kind"]).count() == 3
