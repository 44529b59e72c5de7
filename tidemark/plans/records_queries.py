"""Record scans and compaction: the events are written as raw records to the shared folder and read back through the
library, so the queries exercise the real sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.plans.registry import query, rounded
from tidemark.session import checkpoint_dir
from tidemark.sources import compaction as K
from tidemark.sources import records as R


def scratch(t, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def func_records(t):
    """Events as functional QC records; every seventh has no version."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.col("user_id").cast("string").alias("subject"),
        F.col("event_type").alias("session"),
        F.lit("rest").alias("task"),
        F.col("event_id").cast("string").alias("run"),
        F.col("value").alias("mean_fd"),
        F.when(k % 7 != 0, F.concat(F.lit("1."), (k % 3).cast("string"))).alias("schema_version"),
        F.lit("main").alias("pipeline"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("completed_at"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )


def write_raw(t, name: str) -> str:
    root = scratch(t, name)
    R.write_records(func_records(t).hint("rebalance", F.col("dt")), f"{root}/func-preproc")
    return root


def all_days(t) -> list[str]:
    """The days that have records: one short text per day."""
    return sorted(r["dt"] for r in t.records.select("dt").distinct().collect())


@query(
    "s1_raw_scan",
    """SELECT CAST(event_id AS VARCHAR) AS run, dt, metric AS mean_fd, CAST(NULL AS DOUBLE) AS tsnr_median FROM records""",
)
def raw_scan(t):
    """Raw JSON written under `dt=` and scanned with the superset schema: columns no record carries read NULL."""
    return R.scan_raw(t.spark, write_raw(t, "s1"), "func_preproc").select("run", "dt", "mean_fd", "tsnr_median")


@query(
    "s2_table_filter",
    """SELECT CAST(subject AS VARCHAR) AS subject, dt, metric AS mean_fd FROM records WHERE session = 'click' AND dt BETWEEN '2024-01-05' AND '2024-01-09'""",
)
def table_filter(t):
    out = R.query_table(t.spark, write_raw(t, "s2"), "func_preproc", "2024-01-05", "2024-01-09", session="click")
    return out.select("subject", "dt", "mean_fd")


_COMPACTED = """SELECT dt, CASE WHEN k % 7 = 0 THEN 'unknown' ELSE '1.' || (k % 3) END AS schema_version, COUNT(*) AS n, ROUND(SUM(metric), 4) AS total FROM records GROUP BY ALL"""


@query("s5_compaction_round_trip", _COMPACTED)
def compaction_round_trip(t):
    """Every day compacted by (dt, schema_version) and read back; a record without a version is in `unknown`."""
    root = write_raw(t, "s5")
    K.compact_days(t.spark, root, "func_preproc", all_days(t))
    return _compacted_report(t, root)


def _compacted_report(t, root):
    table = R.record_table("func_preproc")
    stored = t.spark.read.schema(table.partitioned_schema).parquet(table.compacted_path(root))
    return rounded(stored.groupBy("dt", "schema_version").agg(F.count(F.lit(1)).alias("n"), F.sum("mean_fd").alias("total")), 4)


@query("s6_lookback_compaction", _COMPACTED.replace("FROM records", "FROM records WHERE dt BETWEEN '2024-01-06' AND '2024-01-08'"))
def lookback_compaction(t):
    root = write_raw(t, "s6")
    K.compact_lookback(t.spark, root, "2024-01-09", 3, ["func_preproc"])
    return _compacted_report(t, root)


@query(
    "s9_drop_rows",
    """
    WITH r AS (SELECT event_id, subject, CASE WHEN k = 0 THEN NULL ELSE session END AS session FROM records), d AS (SELECT DISTINCT subject, session FROM records WHERE dt = '2024-01-03')
    SELECT event_id FROM r WHERE session IS NULL OR NOT EXISTS (SELECT 1 FROM d WHERE d.subject = r.subject AND d.session = r.session)""",
)
def drop_rows(t):
    keys = t.records.filter(F.col("dt") == "2024-01-03").select("subject", "session")
    rows = t.records.withColumn("session", F.when(F.col("k") != 0, F.col("session")))
    return K.drop_rows(rows, ["subject", "session"], keys).select("event_id")


@query(
    "s9_keep_rows",
    """
    WITH r AS (SELECT event_id, subject, CASE WHEN k = 0 THEN NULL ELSE session END AS session FROM records), d AS (SELECT DISTINCT subject, session FROM records WHERE dt = '2024-01-03')
    SELECT event_id FROM r WHERE session IS NULL OR EXISTS (SELECT 1 FROM d WHERE d.subject = r.subject AND d.session = r.session)""",
)
def keep_rows(t):
    keys = t.records.filter(F.col("dt") == "2024-01-03").select("subject", "session")
    rows = t.records.withColumn("session", F.when(F.col("k") != 0, F.col("session")))
    return K.drop_rows(rows, ["subject", "session"], keys, complement=True).select("event_id")


@query(
    "s10_reconcile",
    """
    SELECT event_id FROM records r WHERE dt > '2024-01-20' OR EXISTS (SELECT 1 FROM records w WHERE w.dt = r.dt AND w.subject = r.subject AND w.session = 'click')""",
)
def reconcile(t):
    compacted = t.records.withColumn("workflow_name", F.col("subject"))
    raw = compacted.filter(F.col("session") == "click")
    proven = compacted.filter(F.col("dt") <= "2024-01-20").select("dt")
    return K.reconcile(compacted, raw, proven).select("event_id")


_STORED = """WITH s AS (SELECT dt, subject, session, metric, CASE WHEN k % 7 = 0 THEN 'unknown' ELSE '1.' || (k % 3) END AS schema_version FROM records)"""
_REPORT = " GROUP BY dt, schema_version"


def _rewritten(t, name: str, keep):
    """Every day compacted, rewritten in place by a row rule, and read back."""
    root = write_raw(t, name)
    K.compact_days(t.spark, root, "func_preproc", all_days(t))
    table = R.record_table("func_preproc")
    K.rewrite_partitions(t.spark, table.compacted_path(root), table.partitioned_schema, keep, f"{root}/staging")
    return _compacted_report(t, root)


@query(
    "s9_drop_rewritten",
    _STORED
    + """, d AS (SELECT DISTINCT subject, session FROM s WHERE dt = '2024-01-03')
    SELECT dt, schema_version, COUNT(*) AS n, ROUND(SUM(metric), 4) AS total FROM s WHERE (subject, session) NOT IN (SELECT subject, session FROM d)"""
    + _REPORT,
)
def drop_rewritten(t):
    keys = func_records(t).filter(F.col("dt") == "2024-01-03").select("subject", "session")
    return _rewritten(t, "s9", lambda df: K.drop_rows(df, ["subject", "session"], keys))


@query(
    "s10_reconcile_rewritten",
    _STORED
    + """ SELECT dt, schema_version, COUNT(*) AS n, ROUND(SUM(metric), 4) AS total FROM s
    WHERE dt > '2024-01-20' OR EXISTS (SELECT 1 FROM s w WHERE w.dt = s.dt AND w.subject = s.subject AND w.session = 'click')"""
    + _REPORT,
)
def reconcile_rewritten(t):
    raw = func_records(t).filter(F.col("session") == "click").select("dt", "subject")
    proven = func_records(t).filter(F.col("dt") <= "2024-01-20").select("dt")
    return _rewritten(t, "s10", lambda df: K.reconcile(df, raw, proven, "subject"))


@query(
    "s20_flush_rewritten",
    _STORED + " SELECT dt, schema_version, COUNT(*) AS n, ROUND(SUM(metric), 4) AS total FROM s WHERE subject % 2 = 1" + _REPORT,
)
def flush_rewritten(t):
    gone = t.events.filter(F.col("user_id") % 2 == 0).select(F.col("user_id").cast("string").alias("subject")).distinct()
    return _rewritten(t, "s20", lambda df: K.flush_subjects(df, gone))


@query(
    "s20_flush_subjects",
    """
    SELECT workflow_name, l_linenumber FROM (SELECT CAST(l_orderkey AS VARCHAR) AS workflow_name, l_linenumber FROM lineitem) WHERE workflow_name NOT IN
        (SELECT CAST(o_orderkey AS VARCHAR) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')""",
)
def flush_subjects(t):
    subjects = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    index = t.orders.select(F.col("o_orderkey").cast("string").alias("workflow_name"), F.col("o_custkey").alias("subject"))
    rows = t.lineitem.select(F.col("l_orderkey").cast("string").alias("workflow_name"), "l_linenumber")
    return K.flush_subjects(rows, subjects, index)


@query(
    "s12_snapshot_pods",
    """SELECT CAST(l_orderkey AS VARCHAR) AS workflow, l_linenumber AS node_id, COUNT(*) AS n, ROUND(SUM(l_quantity), 4) AS cpu FROM lineitem GROUP BY ALL""",
)
def snapshot_pods(t):
    """Gzipped line-JSON with nested pods, written by Spark and scanned back."""
    path = scratch(t, "s12")
    li = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("cpu"))
    nested = li.groupBy(F.col("l_orderkey").cast("string").alias("workflow")).agg(
        F.collect_list(F.struct(F.col("l_linenumber").alias("node_id"), "n", "cpu")).alias("pods")
    )
    nested.write.option("compression", "gzip").json(path)
    return rounded(R.scan_snapshots(t.spark, path, "node_id: INT, n: BIGINT, cpu: DOUBLE").select("workflow", "node_id", "n", "cpu"), 4)


@query(
    "s18_source_objects",
    """SELECT CAST(event_id AS VARCHAR) AS run, COUNT(*) OVER (PARTITION BY dt) AS rows_in_day FROM records""",
)
def source_objects(t):
    """Rows per source folder: a day's objects lie in one folder."""
    root = scratch(t, "s18")
    R.write_records(func_records(t).hint("rebalance", F.col("dt")), f"{root}/func-preproc")
    rows = R.with_path(R.scan_raw(t.spark, root, "func_preproc").select("run", "_metadata"), per_object=None)
    folder = F.regexp_extract("path", r"dt=([0-9-]+)", 1)
    counted = rows.withColumn("folder", folder)
    return counted.join(counted.groupBy("folder").agg(F.count(F.lit(1)).alias("rows_in_day")), "folder").select("run", "rows_in_day")


@query("s19_rekey_partitions", "SELECT dt, COUNT(*) AS n FROM records GROUP BY dt")
def rekey_partitions(t):
    """Flat records, all found under one folder, move under the date of their own time."""
    flat = func_records(t).withColumn("dt", F.lit("unknown"))
    return R.rekey_by_time(flat, "completed_at", "dt").groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


_EXPORTED = {
    "costs": ("date", "total_cost_usd"), "workflow_runs": ("finished_at", "total_duration_s"), "pod_costs": ("date", "runtime_minutes"), "step_outcomes": ("recorded_at", "outputs"),
}


@query(
    "s14_batch_export",
    "WITH s AS (SELECT c_custkey AS subject FROM customer WHERE c_acctbal > 0) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS exported, COUNT(*) AS n_rows, COUNT(DISTINCT subject) AS n_subjects, MIN({day}) AS first_day, MAX({day}) AS last_day, ROUND(SUM({amount}), 2) AS total "
        f"FROM {name} WHERE subject IN (SELECT subject FROM s) AND {day} BETWEEN '1995-06-01' AND '1997-12-31'"
        for name, (day, amount) in _EXPORTED.items()
    ),
)
def batch_export(t):
    """Four tables scoped to the subjects of a batch and its days, written as CSV and read again as text."""
    from tidemark.sources.wide_runs import export_csv, scoped_tables

    subjects = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("subject"))
    tables = {name: getattr(t, name) for name in _EXPORTED}
    paths = export_csv(scoped_tables(tables, subjects, {n: d for n, (d, _) in _EXPORTED.items()}, "1995-06-01", "1997-12-31"), scratch(t, "s14"))
    out = None
    for name, (day, amount) in _EXPORTED.items():
        # the reader takes empty folders too: columns by the table's own names
        text = t.spark.read.csv(paths[name], header=True, schema=", ".join(f"`{c}` string" for c in tables[name].columns))
        part = text.agg(
            F.count(F.lit(1)).alias("n_rows"), F.countDistinct("subject").alias("n_subjects"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
            F.round(F.sum(F.col(amount).cast("double")), 2).alias("total"),
        ).select(F.lit(name).alias("exported"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "s4_json_or_jsonl",
    """SELECT dt, COUNT(*) FILTER (k <> 5) AS n_records, COUNT(*) FILTER (k = 5) AS n_unreadable, ROUND(SUM(CASE WHEN k <> 5 THEN metric END), 4) AS total FROM records GROUP BY dt""",
)
def json_or_jsonl(t):
    """Line files with unreadable lines: what can be read is kept, the rest is counted."""
    path = scratch(t, "s4")
    r = t.records
    good = F.to_json(F.struct("dt", F.col("metric").alias("value")))
    line = F.when(F.col("k") != 5, good).otherwise(F.concat(F.lit('{"dt": "'), "dt", F.lit('", "value": oops')))
    r.select("dt", line.alias("value")).hint("rebalance", F.col("dt")).write.partitionBy("dt").text(path)
    schema = R.T.StructType.fromDDL("dt STRING, value DOUBLE")
    rows = R.read_json_or_jsonl(t.spark, f"{path}/dt=*", schema)
    folder = F.regexp_extract("_file", r"dt=([0-9-]+)", 1).alias("dt")
    bad = F.col(R.CORRUPT).isNotNull()
    out = rows.select(folder, "value", bad.alias("bad")).groupBy("dt").agg(
        F.count(F.when(~F.col("bad"), 1)).alias("n_records"), F.count(F.when(F.col("bad"), 1)).alias("n_unreadable"),
        F.sum(F.when(~F.col("bad"), F.col("value"))).alias("total"),
    )
    return rounded(out, 4)


@query(
    "s7_orphan_repair",
    """SELECT dt, '2.0' AS schema_version, COUNT(*) AS n, ROUND(SUM(metric), 4) AS total FROM records GROUP BY ALL""",
)
def orphan_repair(t):
    """All days written again under a new version: the old versions' partitions must read as no rows."""
    root = write_raw(t, "s7")
    days = all_days(t)
    K.compact_days(t.spark, root, "func_preproc", days)
    again = scratch(t, "s7-again")
    bumped = func_records(t).withColumn("schema_version", F.lit("2.0"))
    R.write_records(bumped.hint("rebalance", F.col("dt")), f"{again}/func-preproc")
    table = R.record_table("func_preproc")
    # the second raw tree is the authority for the compacted tree of the first
    K.compact_days(t.spark, again, "func_preproc", days, compacted_path=table.compacted_path(root))
    return _compacted_report(t, root)


@query(
    "s8_incomplete_read_stands_down",
    """SELECT dt, COUNT(*) AS n FROM records WHERE dt <> '2024-01-02' GROUP BY dt""",
)
def stand_down(t):
    """One day has an unreadable record: it is not compacted, all other days are."""
    root = write_raw(t, "s8")
    broken = t.records.filter(F.col("dt") == "2024-01-02").select("dt", F.lit('{"subject": "1", ').alias("value"))
    broken.write.mode("append").partitionBy("dt").text(f"{root}/func-preproc")
    K.compact_days(t.spark, root, "func_preproc", all_days(t))
    return _compacted_report(t, root).groupBy("dt").agg(F.sum("n").alias("n"))


@query("s11_record_writer", """SELECT dt, COUNT(*) AS n_lines, TRUE AS single_line_objects FROM records GROUP BY dt""")
def record_writer(t):
    """Records are one compact JSON object per line under their day."""
    root = write_raw(t, "s11")
    lines = t.spark.read.text(f"{root}/func-preproc")
    whole = F.col("value").startswith("{") & F.col("value").endswith("}")
    return lines.groupBy("dt").agg(F.count(F.lit(1)).alias("n_lines"), F.bool_and(whole).alias("single_line_objects"))
