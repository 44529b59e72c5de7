"""Outcome, manifest and coverage reports over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.functions.columns import count_if, micros, version_at_least
from tidemark.operators import inventory as IV
from tidemark.operators import outcomes as O
from tidemark.plans.registry import query, rounded
from tidemark.sources.identifiers import identifying_headers, identifying_keys


@query("p2_flagged_runs", "SELECT event_id, subject, session, metric FROM records WHERE metric > 20.0")
def flagged_runs(t):
    return t.records.filter(F.col("metric") > 20.0).select("event_id", "subject", "session", "metric").orderBy(F.desc("metric"))


@query(
    "p3_failing_verdicts",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus AS verdict, ROUND(l_extendedprice, 1) AS score FROM lineitem
       WHERE l_returnflag = 'R' AND l_linestatus IS NOT NULL AND l_linestatus <> 'O'""",
)
def failing_verdicts(t):
    verdict = F.col("l_linestatus")
    bad = t.lineitem.filter((F.col("l_returnflag") == "R") & verdict.isNotNull() & (verdict != "O"))
    return bad.select(
        "l_orderkey", "l_linenumber", "l_partkey", verdict.alias("verdict"), F.round("l_extendedprice", 1).alias("score")
    ).orderBy(F.when(F.col("verdict") == "F", 0).otherwise(1), "score")


@query(
    "p4_normalised_projection",
    "SELECT c_custkey, ROUND(c_acctbal / 9999.0 * 100, 2) AS pct, ROUND(c_acctbal) AS whole FROM customer WHERE c_acctbal > 0",
)
def normalised_projection(t):
    ok = t.customer.filter(F.col("c_acctbal") > 0)
    return ok.select("c_custkey", F.round(F.col("c_acctbal") / 9999.0 * 100, 2).alias("pct"), F.round("c_acctbal").alias("whole"))


@query("p5_failed_workflows", "SELECT subject, workflow_name, status, message, finished_at FROM workflow_runs WHERE status IN ('Failed', 'Error')")
def failed_workflows(t):
    bad = t.workflow_runs.filter(F.col("status").isin("Failed", "Error"))
    return bad.select("subject", "workflow_name", "status", "message", "finished_at").orderBy(F.desc("finished_at"))


@query(
    "p6_version_gate",
    """SELECT version, COUNT(*) AS n FROM (SELECT '1.' || (k % 12) AS version, k FROM records) WHERE k % 12 >= 9 GROUP BY version""",
)
def version_gate(t):
    v = t.records.select(F.concat(F.lit("1."), (F.col("k") % 12).cast("string")).alias("version"))
    return v.filter(version_at_least("version", "1.9")).groupBy("version").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p7_gate_verdict",
    """
    SELECT l_returnflag, CASE WHEN q IS NULL OR NOT isfinite(q) OR q < 5 OR l_discount >= 0.1 THEN 'fail' ELSE 'pass' END AS verdict, COUNT(*) AS n
    FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 'NaN'::DOUBLE ELSE l_quantity END AS q FROM lineitem) GROUP BY ALL""",
)
def gate_verdict(t):
    n = F.col("l_linenumber")
    q = F.when(n == 7, F.lit(None).cast("double")).when(n == 6, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    df = t.lineitem.select("l_returnflag", "l_discount", q.alias("q"))
    bounds = {"q": ("below", 5.0, False), "l_discount": ("above", 0.1, True), "absent_metric": ("below", 1.0, False)}
    return df.groupBy("l_returnflag", P.gate_verdict(bounds, df.columns).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


_OUTCOME = """
    WITH s AS (SELECT CASE l_linenumber WHEN 1 THEN 'Succeeded' WHEN 2 THEN 'Skipped' WHEN 3 THEN 'Error' ELSE 'Failed' END AS status,
                      CASE l_partkey % 7 WHEN 0 THEN 'container OOMKilled' WHEN 1 THEN 'Missing  Input file' WHEN 2 THEN 'ValueError: bad'
                           WHEN 3 THEN 'Skipped upstream' WHEN 4 THEN 'pod deleted' ELSE '' END AS message,
                      CASE l_suppkey % 5 WHEN 0 THEN '137' WHEN 1 THEN '65' WHEN 2 THEN '70' WHEN 3 THEN '1' ELSE '' END AS code FROM lineitem)"""


def _outcomes(t):
    n, p, s = F.col("l_linenumber"), F.col("l_partkey") % 7, F.col("l_suppkey") % 5
    return t.lineitem.select(
        F.when(n == 1, "Succeeded").when(n == 2, "Skipped").when(n == 3, "Error").otherwise("Failed").alias("status"),
        F.when(p == 0, "container OOMKilled").when(p == 1, "Missing  Input file").when(p == 2, "ValueError: bad")
        .when(p == 3, "Skipped upstream").when(p == 4, "pod deleted").otherwise("").alias("message"),
        F.when(s == 0, "137").when(s == 1, "65").when(s == 2, "70").when(s == 3, "1").otherwise("").alias("code"),
    )


@query(
    "p8_failure_category",
    _OUTCOME
    + """ SELECT status, category, COUNT(*) AS n FROM (SELECT status, CASE WHEN status = 'Succeeded' THEN '' WHEN status = 'Skipped' THEN 'dependency'
          WHEN message LIKE '%OOMKilled%' THEN 'infrastructure' WHEN message LIKE 'Missing%' THEN 'data' WHEN message LIKE 'ValueError%' THEN 'algorithm'
          WHEN message LIKE 'Skipped%' THEN 'dependency' WHEN code = '137' THEN 'infrastructure' WHEN code = '65' THEN 'qc_rejected' WHEN code = '70' THEN 'data'
          WHEN status = 'Error' AND message = '' THEN 'infrastructure' ELSE 'unknown' END AS category FROM s) GROUP BY ALL""",
)
def failure_category(t):
    category = P.failure_category("status", "message", "code").alias("category")
    return _outcomes(t).groupBy("status", category).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p9_attempt_cause",
    _OUTCOME
    + """ SELECT CASE WHEN message = 'pod deleted' THEN 'spot: pod deleted' WHEN message LIKE '%OOM%' THEN 'OOMKilled' WHEN code = '65' THEN 'QC gate (exit 65)'
          ELSE 'other (exit ' || code || ')' END AS cause, COUNT(*) AS n FROM s GROUP BY 1""",
)
def attempt_cause(t):
    return _outcomes(t).groupBy(P.attempt_cause("message", "code").alias("cause")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p10_half_open_window",
    """SELECT event_id, dt FROM records WHERE dt BETWEEN '2024-01-04' AND '2024-01-09'
       AND completed_us >= epoch_us(TIMESTAMP '2024-01-05 06:00:00') AND completed_us < epoch_us(TIMESTAMP '2024-01-08 18:30:00')""",
)
def half_open_window(t):
    from tidemark.sources.records import event_window

    out = event_window(t.records, "completed_us", "2024-01-05 06:00:00", "2024-01-08 18:30:00")
    return out.select("event_id", "dt")


@query(
    "p11_run_status",
    """
    WITH o AS (SELECT l_orderkey, MAX(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS f, COUNT(DISTINCT l_returnflag) AS verified FROM lineitem GROUP BY 1)
    SELECT status, COUNT(*) AS n FROM (SELECT CASE WHEN l_orderkey % 11 = 0 THEN 'Skipped' WHEN l_orderkey % 13 = 0 THEN 'Error'
           WHEN l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
           THEN 'Succeeded' ELSE 'Failed' END AS status FROM o) GROUP BY status""",
)
def run_status(t):
    verified = t.lineitem.select("l_orderkey", "l_returnflag").distinct().groupBy("l_orderkey").agg(
        F.collect_list("l_returnflag").alias("verified")
    )
    k = F.col("l_orderkey")
    empty = F.array().cast("array<string>")
    df = verified.select(
        F.when(k % 11 == 0, "Skipped").when(k % 13 == 0, "Error").otherwise("Succeeded").alias("aggregate"),
        F.when((k % 13 == 0) & (k % 11 != 0), empty).otherwise(F.array(F.lit("A"), F.lit("R"))).alias("expected"),
        "verified",
    )
    status = P.run_status("aggregate", "expected", "verified").alias("status")
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p14_identifying_fields",
    """SELECT field, COUNT(*) AS n FROM (SELECT CASE l_linenumber WHEN 1 THEN 'PatientName' WHEN 2 THEN 'PatientID' WHEN 3 THEN 'DateOfBirth' END AS field FROM lineitem)
       WHERE field IS NOT NULL GROUP BY field""",
)
def identifying_fields(t):
    n = F.col("l_linenumber")
    key = F.when(n == 1, "Patient_Name").when(n == 2, "patient id").when(n == 3, "dateofbirth").when(n == 4, "PatientPosition").otherwise("x")
    body = F.to_json(F.create_map(key, F.lit("v")))
    keys = t.lineitem.select(F.explode(F.map_keys(F.from_json(body, "map<string,string>"))).alias("name"))
    found = keys.withColumn("field", P.identifying_field("name")).filter(F.col("field").isNotNull())
    return found.groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p14_nested_fields",
    """
    WITH d AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p FROM lineitem),
    f AS (SELECT o, n, p, '$.study.series[1].header[0].' || CASE n % 3 WHEN 0 THEN 'Patient_Name' WHEN 1 THEN 'PATIENT ID' ELSE 'position' END AS path, CASE n % 3 WHEN 0 THEN 'PatientName' WHEN 1 THEN 'PatientID' END AS field FROM d
          UNION ALL SELECT o, n, p, '$.accession-number', 'AccessionNumber' FROM d WHERE n = 2 UNION ALL SELECT o, n, p, '$.study.Patients_Age', 'PatientsAge' FROM d WHERE n > 4)
    SELECT path, field, COUNT(*) AS n, COUNT(DISTINCT p) AS n_parts FROM f WHERE field IS NOT NULL GROUP BY ALL""",
)
def nested_fields(t):
    """Field names four and more containers deep, beside others at the top; some documents hold none."""
    n = F.col("l_linenumber")
    deep = F.when(n % 3 == 0, "Patient_Name").when(n % 3 == 1, "PATIENT ID").otherwise("position")
    series = F.array(F.lit("{}"), F.concat(F.lit('{"header": [{"'), deep, F.lit('": "x"}, 3], "note": null}')))
    study = F.concat(F.lit('{"series": ['), F.array_join(series, ", "), F.lit("]"), F.when(n > 4, ', "Patients_Age": 7').otherwise(""), F.lit("}"))
    body = F.concat(F.lit('{"study": '), study, F.when(n == 2, ', "accession-number": [1, [2]]').otherwise(""), F.lit("}"))
    docs = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", body.alias("body"))
    found = identifying_keys(docs, ["l_orderkey", "l_linenumber", "l_partkey"], "body")
    return found.groupBy("path", "field").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_partkey").alias("n_parts"))


@query(
    "p14_table_headers",
    """SELECT o_orderpriority AS unit, CASE WHEN o_orderstatus = 'F' THEN 'patients sex' ELSE 'Patient.Birth.Date' END AS "column", CASE WHEN o_orderstatus = 'F' THEN 'PatientsSex' ELSE 'PatientBirthDate' END AS field, COUNT(*) AS n
       FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL""",
)
def table_headers(t):
    """Header lines of tab-separated texts; a name in a later line is no column."""
    name = F.when(F.col("o_orderstatus") == "F", "patients sex").when(F.col("o_orderstatus") == "O", "Patient.Birth.Date").otherwise("x")
    text = F.concat(F.lit('run\t"'), name, F.lit('"\tvalue\r\n1\tPatientName\t2\n'))
    found = identifying_headers(t.orders.select(F.col("o_orderpriority").alias("unit"), text.alias("text")), ["unit"], "text")
    return found.groupBy("unit", "column", "field").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p14_identifying_words",
    """SELECT conv_id, turn, 2 + len(string_split(text, chr(10))) - 1 AS line_number, CASE WHEN turn % 2 = 0 THEN 'PatientsName' ELSE 'AccessionNumber' END AS field
       FROM conversations""",
)
def identifying_words(t):
    """A field name appended as the last line of every text must be found there, in any spelling."""
    from tidemark.sources.text import identifying_words as words

    name = F.when(F.col("turn") % 2 == 0, "the patient's name is x").otherwise("Accession_Number: 7")
    texts = t.conversations.select("conv_id", "turn", F.concat_ws("\n", "text", name).alias("text"))
    return words(texts, ["conv_id", "turn"], "text")


@query(
    "p14_identifying_values",
    """
    WITH v AS (SELECT DISTINCT conv_id AS doc_id, trim(unnest(string_split(text, ' '))) AS value FROM conversations)
    SELECT doc_id, value FROM documents JOIN v USING (doc_id)
    WHERE length(value) >= 5 AND NOT (regexp_full_match(value, '[\\d\\-/.: ]+') AND length(value) < 8) AND contains(lower(text), lower(value))""",
)
def identifying_values(t):
    """Each document is searched, whole, for the values of its own unit."""
    from tidemark.sources.text import texts_with_values

    values = t.conversations.select(F.col("conv_id").alias("doc_id"), F.explode(F.split("text", " ")).alias("value"))
    return texts_with_values(t.documents, ["doc_id"], "text", values, "value")


@query(
    "p16_coordinate_profile",
    """
    WITH v AS (SELECT c_nationkey % 5 AS hemi, c_acctbal AS x, c_custkey % 3 <> 0 AS covered FROM customer),
    e AS (SELECT hemi, QUANTILE_CONT(x, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM v GROUP BY hemi),
    b AS (SELECT hemi, i, q[i] AS lo, q[i + 1] AS hi FROM e, (SELECT unnest(range(1, 11)) AS i)),
    c AS (SELECT hemi, i, AVG(CASE WHEN covered THEN 1.0 ELSE 0.0 END) AS f FROM b JOIN v USING (hemi) WHERE x BETWEEN lo AND hi GROUP BY ALL)
    SELECT hemi, ROUND(MAX(f) - MIN(f), 6) AS coverage_range, ROUND(MIN(f), 6) AS min_coverage, ROUND(MAX(f), 6) AS max_coverage FROM c GROUP BY hemi""",
)
def coordinate_profile(t):
    from tidemark.operators.statistics import decile_profile

    v = t.customer.select(
        (F.col("c_nationkey") % 5).alias("hemi"), F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 3 != 0).alias("covered")
    )
    return rounded(decile_profile(v, ["hemi"], "x", "covered"), 6)


@query(
    "p17_pending_duration",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000 > 0
              THEN (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000 END AS pending_s
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def pending_duration(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", P.pending_seconds("o_orderdate", "l_shipdate").alias("pending_s")
    )


@query(
    "p18_uniform_value",
    """SELECT l_orderkey, CASE WHEN COUNT(v) < COUNT(*) THEN 'unknown' WHEN MIN(v) = MAX(v) THEN MIN(v) ELSE 'mixed' END AS device FROM
       (SELECT l_orderkey, CASE WHEN l_linenumber <> 7 THEN l_returnflag END AS v FROM lineitem) GROUP BY l_orderkey""",
)
def uniform_value(t):
    v = t.lineitem.select("l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("v"))
    return v.groupBy("l_orderkey").agg(P.uniform_value("v").alias("device"))


@query(
    "p20_expected_outputs",
    """
    WITH k AS (SELECT l_orderkey, l_linenumber, l_returnflag AS step FROM lineitem),
    e AS (SELECT step, CASE WHEN step = 'A' THEN 'anat/' || l_orderkey || '.mat' WHEN step = 'N' AND l_linenumber <> 7 THEN 'func/' || l_orderkey || '_' || l_linenumber || '.nii' END AS key FROM k),
    l AS (SELECT DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN 'anat/' || l_orderkey || '.mat' ELSE 'func/' || l_orderkey || '_' || l_linenumber || '.nii' END AS key FROM lineitem WHERE l_quantity >= 10)
    SELECT step, COUNT(*) AS n_rows, COUNT(e.key) AS n_expected, COUNT(l.key) AS n_intact FROM e LEFT JOIN l ON l.key = e.key GROUP BY step""",
)
def expected_outputs(t):
    n = F.col("l_linenumber")
    li = t.lineitem.select(
        F.col("l_returnflag").alias("step"), "l_orderkey", n, F.when(n == 7, "na").otherwise(n.cast("string")).alias("run")
    )
    keys = P.expected_outputs(
        "step", {"A": "anat/{subject}.mat", "N": "func/{subject}_{run}.nii"}, {"subject": "l_orderkey", "run": "run"}, ["N"]
    )
    listing = t.lineitem.select(
        F.when(n % 2 == 0, F.format_string("anat/%d.mat", "l_orderkey"))
        .otherwise(F.format_string("func/%d_%d.nii", "l_orderkey", n))
        .alias("key"),
        F.col("l_quantity").alias("size"),
    )
    intact = listing.filter(F.col("size") >= 10).select("key").distinct().withColumn("intact", F.lit(1))
    expected = li.select("step", F.explode_outer(keys).alias("key"))
    return expected.join(intact, "key", "left").groupBy("step").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("key").alias("n_expected"), F.count("intact").alias("n_intact")
    )


@query(
    "t1_slowest_runs",
    """SELECT l_orderkey, l_linenumber, l_partkey, ROUND(l_extendedprice / 60, 1) AS runtime_min FROM lineitem
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 20""",
)
def slowest_runs(t):
    top = t.lineitem.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(20)
    return top.select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_extendedprice") / 60, 1).alias("runtime_min"))


@query("t3_newest_first", "SELECT event_id, completed_us FROM records")
def newest_first(t):
    return t.records.select("event_id", "completed_us").orderBy(F.desc("completed_us"), F.desc("event_id"))


@query(
    "t4_recent_workflows",
    """SELECT workflow_name, subject, status, finished_at FROM workflow_runs ORDER BY finished_at DESC, workflow_name DESC LIMIT 50""",
)
def recent_workflows(t):
    recent = t.workflow_runs.orderBy(F.desc("finished_at"), F.desc("workflow_name")).limit(50)
    return recent.select("workflow_name", "subject", "status", "finished_at")


@query(
    "a4_distribution_summary",
    """SELECT pipeline, COUNT(*) AS n_runs, ROUND(AVG(total_cost_usd), 3) AS avg_cost, ROUND(AVG(scrape_age_days), 4) AS avg_age FROM costs GROUP BY pipeline""",
)
def distribution_summary(t):
    return t.costs.groupBy("pipeline").agg(
        F.count(F.lit(1)).alias("n_runs"), F.round(F.avg("total_cost_usd"), 3).alias("avg_cost"), F.round(F.avg("scrape_age_days"), 4).alias("avg_age")
    )


@query(
    "a5_failure_rate_by_day",
    """SELECT finished_at AS day, COUNT(*) AS total, CAST(SUM(CASE WHEN status = 'Succeeded' THEN 1 ELSE 0 END) AS BIGINT) AS succeeded,
              CAST(SUM(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
              ROUND(100.0 * SUM(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) / COUNT(*), 4) AS failure_pct FROM workflow_runs GROUP BY 1""",
)
def failure_rate(t):
    failed = F.col("status") == "Failed"
    return t.workflow_runs.groupBy(F.col("finished_at").alias("day")).agg(
        F.count(F.lit(1)).alias("total"),
        count_if(F.col("status") == "Succeeded").alias("succeeded"),
        count_if(failed).alias("failed"),
        F.round(100.0 * count_if(failed) / F.count(F.lit(1)), 4).alias("failure_pct"),
    )


@query(
    "a6_registration_summary",
    """SELECT l_linenumber AS session, l_returnflag AS task, COUNT(*) AS n_runs, COUNT(*) FILTER (NOT l_discount > 0) AS n_failed,
              ROUND(AVG(CASE WHEN l_discount > 0 THEN l_discount END), 6) AS avg_nmi, MIN(CASE WHEN l_discount > 0 THEN l_discount END) AS min_nmi FROM lineitem GROUP BY ALL""",
)
def registration_summary(t):
    nmi = F.col("l_discount")
    valid = F.when(nmi > 0, nmi)
    return rounded(
        t.lineitem.groupBy(F.col("l_linenumber").alias("session"), F.col("l_returnflag").alias("task")).agg(
            F.count(F.lit(1)).alias("n_runs"),
            count_if(valid.isNull()).alias("n_failed"),
            F.avg(valid).alias("avg_nmi"),
            F.min(valid).alias("min_nmi"),
        ),
        6,
    )


@query(
    "a7_gate_outcomes",
    """SELECT l_linenumber AS session, l_returnflag AS task, COUNT(*) AS n_runs, COUNT(*) FILTER (l_linestatus = 'F') AS n_fail,
              ROUND(AVG(l_extendedprice), 3) AS avg_disp, MAX(l_extendedprice) AS worst_disp, MAX(l_tax) AS worst_rot FROM lineitem WHERE l_suppkey % 12 >= 9 GROUP BY ALL""",
)
def gate_outcomes(t):
    version = F.concat(F.lit("2."), (F.col("l_suppkey") % 12).cast("string"))
    gated = t.lineitem.withColumn("schema_version", version).filter(version_at_least("schema_version", "2.9"))
    return rounded(
        gated.groupBy(F.col("l_linenumber").alias("session"), F.col("l_returnflag").alias("task")).agg(
            F.count(F.lit(1)).alias("n_runs"),
            count_if(F.col("l_linestatus") == "F").alias("n_fail"),
            F.avg("l_extendedprice").alias("avg_disp"),
            F.max("l_extendedprice").alias("worst_disp"),
            F.max("l_tax").alias("worst_rot"),
        ),
        3,
    )


@query(
    "a8_dashboard_stats",
    """SELECT COUNT(*) AS n_runs, ROUND(100.0 * COUNT(*) FILTER (status = 'Succeeded') / COUNT(*), 4) AS success_pct,
              ROUND(AVG(total_duration_s) / 3600.0, 4) AS mean_hours, ROUND(AVG(CASE WHEN subject % 7 <> 0 THEN subject % 600 END), 4) AS mean_wait_s, COUNT(*) FILTER (status = 'Failed') AS n_failed, COUNT(*) FILTER (status = 'Running') AS n_running,
              GREATEST(0, CAST(date_diff('minute', MAX(CAST(finished_at AS TIMESTAMP)), TIMESTAMP '2002-01-01') AS BIGINT)) AS minutes_since_last FROM workflow_runs""",
)
def dashboard_stats(t):
    n = F.count(F.lit(1))
    last = F.max(F.to_timestamp("finished_at", "yyyy-MM-dd"))
    now = F.to_timestamp(F.lit("2002-01-01 00:00:00"))
    return t.workflow_runs.agg(
        n.alias("n_runs"),
        F.round(100.0 * count_if(F.col("status") == "Succeeded") / n, 4).alias("success_pct"),
        F.round(F.avg("total_duration_s") / 3600.0, 4).alias("mean_hours"),
        # a run that never waited for a start has no wait
        F.round(F.avg(F.when(F.col("subject") % 7 != 0, F.col("subject") % 600)), 4).alias("mean_wait_s"),
        count_if(F.col("status") == "Failed").alias("n_failed"),
        count_if(F.col("status") == "Running").alias("n_running"),
        F.greatest(F.lit(0).cast("long"), F.timestamp_diff("MINUTE", last, now)).alias("minutes_since_last"),
    )


_MANIFEST = """
    WITH o AS (SELECT DISTINCT workflow_name, step, session, status FROM step_outcomes),
    m AS (SELECT workflow_name, COUNT(*) AS n_steps, string_agg(DISTINCT step, ',' ORDER BY step) FILTER (status = 'failed') AS failed_steps,
                 string_agg(DISTINCT step, ',' ORDER BY step) FILTER (status = 'skipped') AS skipped_steps FROM o GROUP BY workflow_name)
    SELECT w.workflow_name, COALESCE(n_steps, 0) AS n_steps, COALESCE(failed_steps, '') AS failed_steps, COALESCE(skipped_steps, '') AS skipped_steps,
           CASE WHEN w.status <> 'Succeeded' AND n_steps IS NOT NULL THEN 'partial' WHEN w.status <> 'Succeeded' THEN 'failed'
                WHEN failed_steps IS NOT NULL OR skipped_steps IS NOT NULL THEN 'partial' ELSE 'succeeded' END AS overall_status
    FROM workflow_runs w LEFT JOIN m USING (workflow_name)"""


@query("a17_subject_manifest", _MANIFEST)
def subject_manifest(t):
    workflows = t.workflow_runs.select("workflow_name", F.col("status").alias("workflow_status"))
    out = O.build_manifests(t.step_outcomes, workflows, step_fields=["step", "session", "status"], outputs=None)
    return out.select(
        "workflow_name",
        F.coalesce(F.size(F.col("steps")), F.lit(0)).alias("_n"),
        F.when(F.col("steps").isNull(), 0).otherwise(F.size("steps")).alias("n_steps"),
        F.coalesce(F.array_join("failed_steps", ","), F.lit("")).alias("failed_steps"),
        F.coalesce(F.array_join("skipped_steps", ","), F.lit("")).alias("skipped_steps"),
        "overall_status",
    ).drop("_n")


@query(
    "a18_first_failed_step",
    """SELECT workflow_name, arg_min(step, recorded_at || step || failure_category) AS failed_step, arg_min(failure_category, recorded_at || step || failure_category) AS failure_category
       FROM step_outcomes WHERE status = 'failed' GROUP BY workflow_name""",
)
def first_failed_step(t):
    return O.first_failed_step(t.step_outcomes, ["workflow_name"], tie_break=["step", "failure_category"])


@query(
    "a19_relabel_targets",
    """
    WITH f AS (SELECT workflow_name, min(recorded_at) AS ts FROM step_outcomes WHERE status = 'failed' GROUP BY 1),
    r AS (SELECT s.workflow_name, s.step, CASE WHEN s.outputs > 10 THEN 'rule' END AS rule FROM step_outcomes s JOIN f ON f.workflow_name = s.workflow_name AND f.ts = s.recorded_at WHERE s.status = 'failed')
    SELECT workflow_name, MIN(step) AS step, MIN(rule) AS rule FROM r GROUP BY 1 HAVING bool_and(rule IS NOT NULL) AND COUNT(DISTINCT step) = 1""",
)
def relabel_targets(t):
    so = t.step_outcomes
    identity = ["workflow_name", "step", "session", "run", "task", "outputs", "recorded_at"]
    targets = so.filter((F.col("status") == "failed") & (F.col("outputs") > 10)).select(*identity).distinct()
    return O.relabel_targets(so, targets.withColumn("rule", F.lit("rule")), ["workflow_name"], identity)


@query(
    "a20_mode_by_stratum",
    """
    WITH c AS (SELECT l_returnflag, l_linestatus, l_linenumber AS v, COUNT(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, l_linestatus, CAST(SUM(n) AS BIGINT) AS runs, arg_min(v, (-n * 100 + v)) AS mode_value, MAX(n) AS mode_runs,
           ROUND(MAX(n) / SUM(n), 6) AS mode_share, string_agg(v || ':' || n, ';' ORDER BY n DESC, v) AS distribution FROM c GROUP BY ALL""",
)
def mode_by_stratum(t):
    return rounded(O.mode_by_stratum(t.lineitem, ["l_returnflag", "l_linestatus"], "l_linenumber"), 6)


@query(
    "a21_attempt_summary",
    """
    WITH p AS (SELECT l_returnflag AS step, l_quantity AS minutes, CASE WHEN l_linestatus = 'O' THEN 'Succeeded' WHEN l_linenumber = 7 THEN 'Skipped' ELSE 'Failed' END AS phase,
                      CASE WHEN l_linestatus = 'O' OR l_linenumber = 7 THEN NULL WHEN l_partkey % 3 = 0 THEN 'OOMKilled' ELSE 'other (exit ' || (l_suppkey % 3) || ')' END AS cause FROM lineitem),
    c AS (SELECT step, string_agg(cause || '=' || n, '; ' ORDER BY cause) AS causes FROM (SELECT step, cause, COUNT(*) AS n FROM p WHERE cause IS NOT NULL GROUP BY ALL) GROUP BY step),
    s AS (SELECT step, list_sort(list(minutes) FILTER (phase = 'Succeeded')) AS d FROM p GROUP BY step)
    SELECT p.step, COUNT(*) AS attempts, COUNT(*) FILTER (phase = 'Failed') AS nonzero_attempts, ROUND(COUNT(*) FILTER (phase = 'Failed') / COUNT(*), 6) AS nonzero_rate,
           COUNT(*) FILTER (phase = 'Succeeded') AS n_successful, MAX(causes) AS causes, ROUND(QUANTILE_CONT(minutes, 0.5) FILTER (phase = 'Succeeded'), 6) AS median_duration_min,
           MAX(p95) AS p95_duration_min
    FROM p JOIN c USING (step) JOIN (SELECT step, d[CAST(floor(len(d) * 0.95) AS BIGINT) + 1] AS p95 FROM s) USING (step) GROUP BY p.step""",
)
def attempt_summary(t):
    ok = F.col("l_linestatus") == "O"
    pods = t.lineitem.select(
        F.col("l_returnflag").alias("step"),
        F.col("l_quantity").alias("minutes"),
        F.when(ok, "Succeeded").when(F.col("l_linenumber") == 7, "Skipped").otherwise("Failed").alias("phase"),
        F.when(F.col("l_partkey") % 3 == 0, "OOM in main").otherwise("").alias("message"),
        (F.col("l_suppkey") % 3).cast("string").alias("exit_code"),
    )
    return rounded(O.attempt_summary(pods), 6)


@query("a22_attempts_by_exit", "SELECT step, session AS exit_label, COUNT(*) AS attempts FROM step_outcomes GROUP BY ALL")
def attempts_by_exit(t):
    return O.attempts_by_exit(t.step_outcomes.withColumnRenamed("session", "exit_label"))


@query(
    "a23_phase_split",
    """SELECT l_returnflag AS step, COUNT(*) AS n_pods, ROUND(AVG(l_linenumber), 6) AS mean_init_s, ROUND(AVG(l_quantity), 6) AS mean_main_s,
              ROUND(SUM(l_linenumber) / (SUM(l_linenumber) + SUM(l_quantity)), 6) AS init_share, ROUND(SUM(l_linenumber * l_discount), 4) AS idle_core_s FROM lineitem GROUP BY 1""",
)
def phase_split(t):
    li = t.lineitem.withColumn("step", F.col("l_returnflag")).withColumn("init", F.col("l_linenumber").cast("double"))
    return rounded(O.phase_split(li, ["step"], "init", "l_quantity", "l_discount"), 6, idle_core_s=4)


@query(
    "a24_participant_flow",
    """
    WITH f AS (SELECT l_orderkey AS subject, l_linenumber AS session, l_tax < 0.08 AS c1, l_discount > 0.01 AS c2, l_returnflag <> 'R' AS c3 FROM lineitem),
    b AS (SELECT 'enrolled' AS box, 'stage' AS kind, * FROM f UNION ALL SELECT 'anat', 'excluded', * FROM f WHERE NOT c1 UNION ALL SELECT 'anat', 'stage', * FROM f WHERE c1
     UNION ALL SELECT 'func', 'excluded', * FROM f WHERE c1 AND NOT c2 UNION ALL SELECT 'func', 'stage', * FROM f WHERE c1 AND c2
     UNION ALL SELECT 'final', 'excluded', * FROM f WHERE c1 AND c2 AND NOT c3 UNION ALL SELECT 'final', 'stage', * FROM f WHERE c1 AND c2 AND c3)
    SELECT box, kind, COUNT(DISTINCT subject) AS subjects, COUNT(DISTINCT (subject, session)) AS sessions, COUNT(*) AS n_rows FROM b GROUP BY box, kind""",
)
def participant_flow(t):
    f = t.lineitem.select(F.col("l_orderkey").alias("subject"), F.col("l_linenumber").alias("session"), "l_tax", "l_discount", "l_returnflag")
    stages = [("anat", F.col("l_tax") < 0.08), ("func", F.col("l_discount") > 0.01), ("final", F.col("l_returnflag") != "R")]
    return O.staged_flow(f, stages, {"subjects": ["subject"], "sessions": ["subject", "session"]})


@query(
    "a32_grain_asymmetry",
    """
    WITH g AS (SELECT 'costs' AS grain, COUNT(*) AS n_rows, COUNT(DISTINCT subject) AS n_subjects FROM costs UNION ALL
               SELECT 'failed_runs', COUNT(*), COUNT(DISTINCT subject) FROM workflow_runs WHERE status = 'Failed' AND message = '5-LOW' UNION ALL
               SELECT 'pods', COUNT(*), COUNT(DISTINCT subject) FROM pod_costs UNION ALL SELECT 'nothing', COUNT(*), COUNT(DISTINCT subject) FROM costs WHERE date < '1900')
    SELECT grain, n_rows, n_subjects, CASE WHEN n_rows = 0 THEN 'empty' WHEN n_subjects < 0.9 * MAX(n_subjects) OVER () THEN 'partial' ELSE 'ok' END AS flag FROM g""",
)
def grain_asymmetry(t):
    failed = t.workflow_runs.filter((F.col("status") == "Failed") & (F.col("message") == "5-LOW"))
    return O.grain_coverage(
        {"costs": t.costs, "failed_runs": failed, "pods": t.pod_costs, "nothing": t.costs.filter(F.col("date") < "1900")}
    )


@query(
    "a38_batch_checks",
    """
    WITH e AS (SELECT c_custkey AS s FROM customer), u AS (SELECT s, s IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') AS f,
               s IN (SELECT user_id FROM events) AS ev, s IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW') AS g FROM e)
    SELECT 'run_level_coverage' AS "check", COUNT(*) AS expected, COUNT(*) FILTER (f) AS found, COUNT(*) FILTER (NOT f AND NOT ev) AS no_evidence,
           COUNT(*) FILTER (NOT f AND ev AND g) AS gated, COUNT(*) FILTER (NOT f AND ev AND NOT g) AS missing, COUNT(*) FILTER (NOT f AND ev AND NOT g) = 0 AS passed FROM u""",
)
def batch_checks(t):
    orders = t.orders.withColumnRenamed("o_custkey", "subject")
    return O.coverage_check(
        "run_level_coverage",
        t.customer.select(F.col("c_custkey").alias("subject")),
        orders.filter(F.col("o_orderstatus") == "O"),
        ["subject"],
        t.events.select(F.col("user_id").alias("subject")),
        orders.filter(F.col("o_orderpriority") == "5-LOW"),
    )


@query(
    "a38_manifests",
    """
    WITH u AS (SELECT c_custkey AS s, c_custkey IN (SELECT subject FROM workflow_runs) AS f FROM customer)
    SELECT 'manifests' AS "check", COUNT(*) AS expected, COUNT(*) FILTER (f) AS found, 0 AS no_evidence, 0 AS gated, COUNT(*) FILTER (NOT f) AS missing, COUNT(*) FILTER (NOT f) = 0 AS passed FROM u""",
)
def batch_manifests(t):
    """Every subject of the batch has a manifest, built from its workflows and their step outcomes."""
    steps = t.step_outcomes.select("workflow_name", "subject", "step", "session", "task", "run", "status", "failure_category")
    runs = t.workflow_runs.select("workflow_name", "subject", F.col("status").alias("workflow_status"))
    manifests = O.build_manifests(steps, runs, ["workflow_name", "subject"], outputs=None)
    return O.coverage_check("manifests", t.customer.select(F.col("c_custkey").alias("subject")), manifests, ["subject"])


@query(
    "a38_expected_steps",
    """
    WITH e AS (SELECT unnest(['A', 'N', 'R', 'X', 'B']) AS n), u AS (SELECT n, n IN (SELECT step FROM step_outcomes) AS f FROM e)
    SELECT 'outcome_steps' AS "check", COUNT(*) AS expected, COUNT(*) FILTER (f) AS found, string_agg(n, ',' ORDER BY n) FILTER (NOT f) AS missing, BOOL_AND(f) AS passed FROM u""",
)
def expected_steps(t):
    return O.expected_names_check("outcome_steps", t.step_outcomes, "step", ["A", "N", "R", "X", "B"])


@query(
    "a38_newest_version",
    """
    WITH w AS (SELECT subject, CASE message WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN '1.0' ELSE '1.1' END AS v, ROW_NUMBER() OVER (PARTITION BY subject ORDER BY finished_at DESC, CAST(workflow_name AS BIGINT) DESC) AS rn FROM workflow_runs)
    SELECT 'run_versions' AS "check", COUNT(*) AS expected, COUNT(*) FILTER (v = '1.1') AS found, COALESCE(string_agg(DISTINCT COALESCE(v, ''), ',' ORDER BY COALESCE(v, '')) FILTER (v IS DISTINCT FROM '1.1'), '') AS other_versions,
           COUNT(*) FILTER (v = '1.1') = COUNT(*) AS passed FROM w WHERE rn = 1""",
)
def newest_version(t):
    version = F.when(F.col("message") == "1-URGENT", "1.0").when(F.col("message") != "5-LOW", "1.1")
    runs = t.workflow_runs.withColumn("version", version).withColumn("number", F.col("workflow_name").cast("long"))
    return O.newest_version_check("run_versions", runs, ["subject"], "finished_at", "version", "1.1", ["number"])


_DELIVERY = """
    WITH o AS (SELECT subject, CASE WHEN session = 7 THEN 'na' ELSE 'ses-' || session END AS ses, step = 'R' AND task % 20 = 0 AS func FROM step_outcomes),
    m AS (SELECT DISTINCT subject, CASE WHEN session = 6 THEN 'long-template' ELSE 'ses-' || session END AS ses FROM step_outcomes WHERE run % 9 > 0),
    n AS (SELECT c_custkey AS subject FROM customer WHERE c_custkey NOT IN (SELECT subject FROM o WHERE func)),
    e AS (SELECT DISTINCT subject, ses FROM o WHERE ses <> 'na' AND ses <> 'long-template'),
    p AS (SELECT n.subject, COUNT(e.ses) AS n_sessions, COUNT(CASE WHEN (n.subject, e.ses) NOT IN (SELECT (subject, ses) FROM m) THEN e.ses END) AS n_gaps FROM n LEFT JOIN e USING (subject) GROUP BY n.subject),
    d AS (SELECT *, subject IN (SELECT subject FROM m WHERE ses = 'long-template') AS has_template FROM p),
    v AS (SELECT *, CASE WHEN n_sessions = 0 THEN 'lost' WHEN n_gaps > 0 THEN 'gaps' WHEN NOT has_template THEN 'no_template' ELSE 'delivered' END AS verdict FROM d)"""


def _delivery(t):
    s = F.col("session")
    named = F.concat(F.lit("ses-"), s.cast("string"))
    outcomes = t.step_outcomes.withColumn("session", F.when(s == 7, "na").otherwise(named))
    markers = t.step_outcomes.filter(F.col("run") % 9 > 0).select("subject", F.when(s == 6, "long-template").otherwise(named).alias("session")).distinct()
    functional = (F.col("step") == "R") & (F.col("task") % 20 == 0)
    return O.anatomy_only_delivery(t.customer.select(F.col("c_custkey").alias("subject")), outcomes, markers, functional)


@query("a38_anatomy_only_subjects", _DELIVERY + " SELECT subject, n_sessions, n_gaps, has_template, verdict FROM v")
def anatomy_only_subjects(t):
    return _delivery(t)


@query(
    "a38_anatomy_only_check",
    _DELIVERY
    + """ SELECT 'anatomy_only_delivery' AS "check", COUNT(*) AS expected, COUNT(*) FILTER (verdict NOT IN ('lost', 'gaps')) AS found, COUNT(*) FILTER (verdict = 'lost') AS lost, COUNT(*) FILTER (verdict = 'gaps') AS with_gaps,
          COUNT(*) FILTER (verdict = 'no_template') AS without_template, COUNT(*) FILTER (verdict = 'no_template') > 0 AS warning, COUNT(*) FILTER (verdict NOT IN ('lost', 'gaps')) = COUNT(*) AS passed FROM v""",
)
def anatomy_only_check(t):
    return O.anatomy_only_check(_delivery(t))


@query(
    "a38_required_fields",
    """SELECT 'workflow_runs' AS "check", COUNT(*) AS n_rows, 'status' AS field, COUNT(*) FILTER (status IS NULL) AS n_empty, COUNT(*) FILTER (status IS NULL) = 0 AS passed FROM workflow_runs
       UNION ALL SELECT 'workflow_runs', COUNT(*), 'failed_step', COUNT(*) FILTER (status <> 'Failed'), COUNT(*) FILTER (status <> 'Failed') = 0 FROM workflow_runs""",
)
def required_fields(t):
    runs = t.workflow_runs.withColumn("failed_step", F.when(F.col("status") == "Failed", F.col("message")))
    return O.required_fields_check("workflow_runs", runs, ["status", "failed_step"])


@query(
    "a38_terminal_phase",
    """SELECT subject, arg_max(status, finished_at || lpad(workflow_name, 12, '0')) AS last_phase, COUNT(*) AS n_workflows,
              BOOL_OR(status = 'Failed') AND arg_max(status, finished_at || lpad(workflow_name, 12, '0')) = 'Succeeded' AS recovered FROM workflow_runs GROUP BY subject""",
)
def terminal_phase(t):
    runs = t.workflow_runs.withColumn("workflow_name", F.lpad("workflow_name", 12, "0"))
    return O.terminal_phase(runs, phase="status", time="finished_at")


@query(
    "a39_redrive_plan",
    """
    WITH w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY subject ORDER BY finished_at DESC, workflow_name DESC) AS rn FROM workflow_runs),
    n AS (SELECT * FROM w WHERE rn = 1 AND status = 'Failed'),
    a AS (SELECT workflow_name, step, session, CASE WHEN session = 1 THEN '' WHEN session = 2 THEN '143' WHEN session = 3 THEN '65' ELSE CAST(session AS VARCHAR) END AS code,
                 CASE WHEN run % 50 = 0 THEN 'Artifact KEY does not exist' WHEN run % 97 = 0 THEN 'license Expired' ELSE '' END AS msg FROM step_outcomes WHERE status = 'failed'),
    c AS (SELECT workflow_name, step, code, COUNT(*) AS n, COUNT(*) FILTER (code <> '143' AND code <> '') AS rep, BOOL_OR(msg LIKE '%KEY%') AS absent, BOOL_OR(msg LIKE 'lic%') AS det FROM a GROUP BY ALL),
    t AS (SELECT workflow_name, CAST(SUM(n) AS BIGINT) AS n_attempts, MAX(rep) AS rep, BOOL_OR(absent) AS absent, BOOL_OR(det) AS det, BOOL_AND(code = '65') AS gate FROM c GROUP BY 1),
    j AS (SELECT n.subject, n.workflow_name, n.status AS phase, COALESCE(n_attempts, 0) AS n_attempts, rep, absent, det, gate, n.message = '5-LOW' AS dl FROM n LEFT JOIN t USING (workflow_name))
    SELECT subject, workflow_name, phase, n_attempts, CASE WHEN n_attempts = 0 THEN 'retry' WHEN det OR rep >= 2 THEN 'skip' WHEN absent OR dl THEN 'retry' WHEN gate THEN 'skip' ELSE 'retry' END AS action,
           CASE WHEN n_attempts = 0 THEN 'no failed pod' WHEN det THEN 'deterministic message' WHEN rep >= 2 THEN 'deterministic repeat' WHEN absent THEN 'absent artifact key' WHEN dl THEN 'hit deadline' WHEN gate THEN 'gate rejected the input' ELSE 'transient' END AS reason FROM j""",
)
def redrive_plan(t):
    runs = t.workflow_runs.select(
        "workflow_name", "subject", F.col("status").alias("phase"), F.col("finished_at").alias("started_at"),
        F.when(F.col("message") == "5-LOW", "Deadline exceeded").alias("workflow_message"),
    )
    s = F.col("session")
    attempts = t.step_outcomes.filter(F.col("status") == "failed").select(
        "workflow_name", "step",
        F.when(s == 1, "").when(s == 2, "143").when(s == 3, "65").otherwise(s.cast("string")).alias("exit_code"),
        F.when(F.col("run") % 50 == 0, "Artifact KEY does not exist").when(F.col("run") % 97 == 0, "license Expired").otherwise("").alias("message"),
    )
    return O.redrive_plan(runs, attempts, {"license expired": "no license"})


@query(
    "a40_completion_inventory",
    """SELECT l_orderkey, BOOL_OR(l_returnflag = 'A') AS registration, BOOL_OR(l_returnflag = 'N' AND l_quantity >= 10) AS func, BOOL_OR(l_returnflag = 'R') AS surface,
              BOOL_OR(l_returnflag = 'A') AND BOOL_OR(l_returnflag = 'N' AND l_quantity >= 10) AND BOOL_OR(l_returnflag = 'R') AS complete FROM lineitem GROUP BY l_orderkey""",
)
def completion_inventory(t):
    path = F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_returnflag"), F.lit("/part"))
    listing = t.lineitem.select("l_orderkey", path.alias("path"), F.col("l_quantity").alias("size"))
    parts = {n: F.col("path").rlike(f"/{c}/") for n, c in (("registration", "A"), ("func", "N"), ("surface", "R"))}
    return O.completion_inventory(listing, ["l_orderkey"], parts, {"func": 10})


def _staged(t):
    """(runs, listing, markers, sessions): line items as runs of the orders as sessions, with the files that steps have left so far."""
    sub, ses = F.concat(F.lit("sub-"), F.col("l_orderkey") % 100), F.concat(F.lit("ses-"), F.col("l_orderkey"))
    run = F.concat(F.lit("task-rest_run-0"), F.col("l_linenumber"))
    rows = t.lineitem.withColumns({"subject": sub, "session": ses, "run": run})
    prefix = F.concat_ws("_", "subject", "session", "run")

    def key(folder: str, ending: str, *between):
        return F.concat(F.lit(f"derivatives/{folder}/"), F.col("subject"), F.lit("/"), F.col("session"), F.lit("/"), *between, prefix, F.lit(ending))

    files = F.array(
        F.when(F.col("l_returnflag") != "A", key("registration", "_desc-bold2t1w_itk.txt", F.lit("bold_to_t1w_"), F.col("run"), F.lit("/"))),
        F.when(F.col("l_linenumber") % 3 == 0, key("func", "_space-MNI152NLin2009cAsym_bold.tar.gz")),
        F.when(F.col("l_discount") > 0.05, key("func_surf", "_desc-grayordcomponents_bold.tar.gz", F.lit("components/"))),
        F.when(F.col("l_tax") > 0.05, key("func_surf", "_space-fsLR32k_bold.dtseries.nii", F.lit("fsLR32k/"))),
        F.when(F.col("l_tax") < 0.02, key("func_surf", "_space-fsLR32k_desc-newmsm_bold.dtseries.nii", F.lit("fsLR32k/"))),
        F.when(F.col("l_quantity") > 45, F.concat(F.lit("derivatives/registration/"), F.col("subject"), F.lit("/"), F.col("session"), F.lit("/t1w_to_mni/"), F.concat_ws("_", "subject", "session", F.lit("desc-t1w2mni_affine.mat")))),
        F.concat(F.lit("derivatives/func/"), F.col("subject"), F.lit("/other_"), prefix, F.lit(".json")),
    )
    listing = rows.select(F.explode(F.filter(files, lambda f: f.isNotNull())).alias("path"))
    kind = F.when(F.col("l_orderkey") % 10 == 3, "anat").otherwise("func-session")
    markers = rows.groupBy("subject", "session", kind.alias("kind")).agg(F.collect_set(F.when(F.col("l_linenumber") % 2 == 0, F.col("run"))).alias("runs"))
    sessions = rows.groupBy("subject", "session").agg((F.max("l_linenumber") > 2).alias("has_t1w"), F.first("l_orderkey").alias("order"))
    return rows.select("subject", "session", "run"), listing, markers, sessions


def _runs_sql(target: str, proof: str) -> str:
    return f"""
    SELECT 'sub-' || (l_orderkey % 100) AS subject, 'ses-' || l_orderkey AS session, 'task-rest_run-0' || l_linenumber AS run, BOOL_OR(l_returnflag <> 'A') AS b2t_exists,
           BOOL_OR((l_linenumber % 2 = 0 AND l_orderkey % 10 <> 3) OR l_linenumber % 3 = 0) AS func_exists, BOOL_OR(l_discount > 0.05) AS components_exist, BOOL_OR({target}) AS surf_target_exists, BOOL_OR(l_discount > 0.05 OR {target}) AS surf_exists
    FROM lineitem GROUP BY ALL"""


@query("a40_run_inventory_fs", _runs_sql("(l_tax > 0.05 OR l_tax < 0.02)", "fs"))
def run_inventory_fs(t):
    """Marker list or legacy object, components or finished surface of either route, in one pass over the listing."""
    runs, listing, markers, _ = _staged(t)
    return IV.run_inventory(runs, listing, markers, "fs")


@query("a40_run_inventory_newmsm", _runs_sql("l_tax < 0.02", "newmsm"))
def run_inventory_newmsm(t):
    """Only surfaces of the newMSM route count."""
    runs, listing, markers, _ = _staged(t)
    return IV.run_inventory(runs, listing, markers, "newmsm")


@query(
    "a40_session_inventory",
    """
    WITH s AS (SELECT l_orderkey AS o, MAX(l_linenumber) > 2 AS t1w, BOOL_OR(l_quantity > 45) AS mni FROM lineitem GROUP BY 1)
    SELECT 'sub-' || (o % 100) AS subject, 'ses-' || o AS session, mni AS t1w_to_mni_exists, t1w AND o % 17 > 0 AS t1w_available, o % 17 = 0 AS excluded, CASE WHEN o % 9 = 0 THEN '' ELSE CAST(o % 9 AS VARCHAR) END AS nss_frames,
           t1w AND o % 17 > 0 AND o % 4 <> 1 AS published, t1w AND o % 17 > 0 AND o % 4 = 1 AS rejected FROM s""",
)
def session_inventory(t):
    """Candidates split into published and rejected ones; excluded sessions stay visible."""
    _, listing, _, sessions = _staged(t)
    order = F.col("order")
    keys = sessions.select("subject", "session", "order")
    lookup = keys.select("subject", "session", F.when(order % 9 == 0, "").otherwise((order % 9).cast("string")).alias("nss_frames"))
    return IV.session_inventory(
        sessions.drop("order"), listing, lookup, keys.filter(order % 4 != 1).select("subject", "session"), keys.filter(order % 17 == 0).select("subject", "session")
    )


@query(
    "a41_audit_rows",
    """SELECT subject, session, COUNT(*) AS n_rows, ROUND(SUM(total_cost_usd), 4) AS usd FROM pod_costs WHERE workflow_name LIKE '1%' AND workflow_name NOT LIKE '12%' GROUP BY ALL""",
)
def audit_rows(t):
    name = F.col("workflow_name")
    mine = t.pod_costs.filter(name.startswith("1") & ~name.startswith("12"))
    return rounded(mine.groupBy("subject", "session").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_cost_usd").alias("usd")), 4)


@query(
    "a42_gpu_duty_cycle",
    """
    WITH s AS (SELECT user_id AS pod, event_type AS step, greatest(0, floor(value) - 8) AS u, CAST(json_extract(props, '$.k') AS BIGINT) AS mem FROM events),
    p AS (SELECT pod, step, COUNT(*) FILTER (u > 0) / COUNT(*) AS duty, AVG(u) FILTER (u > 0) AS busy, MAX(mem) AS peak FROM s GROUP BY ALL)
    SELECT step, COUNT(*) AS n_pods, ROUND(AVG(duty), 6) AS duty_cycle, ROUND(AVG(busy), 6) AS mean_busy_utilisation, MAX(peak) AS peak_memory FROM p GROUP BY step""",
)
def gpu_duty_cycle(t):
    """Samples are read out of log lines (`util=<n> mem=<n>`), as the logs hold them."""
    line = F.format_string("gpu util=%d mem=%d", F.greatest(F.lit(0), F.floor("value") - 8), F.get_json_object("props", "$.k").cast("long"))
    logs = t.events.select(F.col("user_id").alias("pod"), F.col("event_type").alias("step"), line.alias("line"))
    samples = logs.select(
        "pod", "step",
        F.regexp_extract("line", r"util=(\d+)", 1).cast("long").alias("util"),
        F.regexp_extract("line", r"mem=(\d+)", 1).cast("long").alias("mem"),
    )
    return rounded(O.duty_cycle(samples, ["pod"], "step", "util", "mem"), 6)


@query(
    "a47_table_quality",
    """
    WITH g AS (SELECT l_orderkey, COUNT(*) AS n_rows, COUNT(*) FILTER (l_linenumber = 7) AS a, COUNT(*) FILTER (l_discount > 0.09) AS b FROM lineitem GROUP BY 1),
    e AS (SELECT o_orderkey, o_orderkey % 6 AS x FROM orders)
    SELECT l_orderkey, n_rows, c AS "check", n_bad, n_bad = 0 AS passed FROM (SELECT l_orderkey, n_rows, 'unexpected_na' AS c, a AS n_bad FROM g UNION ALL SELECT l_orderkey, n_rows, 'range', b FROM g
        UNION ALL SELECT l_orderkey, n_rows, 'row_count', abs(n_rows - x) FROM g JOIN e ON l_orderkey = o_orderkey)""",
)
def table_quality(t):
    expected = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 6).alias("expected_rows"))
    checks = {"unexpected_na": F.col("l_linenumber") == 7, "range": F.col("l_discount") > 0.09}
    return O.table_quality(t.lineitem, ["l_orderkey"], checks, expected)


@query(
    "a48_log_census",
    """SELECT page_id, CASE WHEN len(v) = 1 THEN v[1] WHEN len(v) > 1 THEN 'mixed' END AS lang, CASE WHEN len(d) = 1 THEN d[1] WHEN len(d) > 1 THEN 'mixed' END AS section FROM
       (SELECT page_id, list_distinct(regexp_extract_all(html, '<html lang="([a-z]+)"', 1)) AS v, list_distinct(regexp_extract_all(html, '<(article|nav|div)[ >]', 1)) AS d FROM pages)""",
)
def log_census(t):
    return O.log_census(t.pages, ["page_id"], "html", {"lang": '<html lang="([a-z]+)"', "section": "<(article|nav|div)[ >]"})


@query(
    "a49_batch_warnings",
    """
    WITH b AS (SELECT workflow_name FROM workflow_runs WHERE status = 'Succeeded'), c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (workflow_name NOT IN (SELECT workflow_name FROM b)) AS f FROM costs),
    p AS (SELECT COUNT(DISTINCT subject) FILTER (session = 'purchase') AS a, COUNT(DISTINCT subject) FILTER (session = 'signup') AS q FROM records)
    SELECT n AS n_rows, f AS rows_cross_batch, a AS n_anatomy, q AS n_qc, f > 0 AS warn_cross_batch, a <> q AS warn_pairing FROM c, p""",
)
def batch_warnings(t):
    batch = t.workflow_runs.filter(F.col("status") == "Succeeded").select("workflow_name").withColumn("_in", F.lit(True))
    cross = t.costs.join(batch, "workflow_name", "left").agg(
        F.count(F.lit(1)).alias("n_rows"), count_if(F.col("_in").isNull()).alias("rows_cross_batch"), F.lit(1).alias("_one")
    )
    of = {s: F.countDistinct(F.when(F.col("session") == s, F.col("subject"))) for s in ("purchase", "signup")}
    pairing = t.records.agg(of["purchase"].alias("n_anatomy"), of["signup"].alias("n_qc"), F.lit(1).alias("_one"))
    return cross.join(pairing, "_one").select(
        "n_rows", "rows_cross_batch", "n_anatomy", "n_qc",
        (F.col("rows_cross_batch") > 0).alias("warn_cross_batch"), (F.col("n_anatomy") != F.col("n_qc")).alias("warn_pairing"),
    )


@query(
    "p22_measure_lookup",
    """SELECT l_orderkey, l_linestatus AS source, l_extendedprice AS value FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 3""",
)
def measure_lookup(t):
    hit = t.lineitem.filter((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 3))
    return hit.select("l_orderkey", F.col("l_linestatus").alias("source"), F.col("l_extendedprice").alias("value"))
