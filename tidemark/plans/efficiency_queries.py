"""Efficiency measures over orders (a session's pods) and events (executed nodes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import micros
from tidemark.operators import efficiency as E
from tidemark.operators.joins import paired_ratios
from tidemark.operators.ordered import row_position
from tidemark.plans.registry import query, rounded


def _logs(t):
    """Logs of eight events each, put together by Spark; a node is set up, executed at the event and finishes later."""
    us = micros("ts")
    ms = F.floor(us / 1000) * 1000
    finish = ms + F.floor(F.col("value") * 1000).cast("long") * 1000

    def stamp(c):
        t_ = F.timestamp_micros(c)
        return F.concat(F.date_format(t_, "yyMMdd-HH:mm:ss"), F.lit(","), F.date_format(t_, "SSS"), F.lit(" nipype.workflow INFO:"))

    kind, who = F.col("event_type"), F.col("user_id").cast("string")
    directory = F.concat(F.lit("/work/fmriprep_25_2_wf/sub_"), who, F.lit("_wf/"), kind, F.lit("_wf/_in_"), who, F.lit("/mapflow/node_"), kind)
    elapsed = F.format_string("%.3f", F.floor(F.col("value") * 1000) / 1000)
    entry = F.array(
        F.struct(ms.alias("at"), F.lit(0).alias("o"), F.col("event_id").alias("id"),
                 F.concat(stamp(ms), F.lit('\n\t [Node] Setting-up "wf.node_'), kind, F.lit('" in "'), directory, F.lit('".\n'), stamp(ms), F.lit('\n\t [Node] Executing "node_'), kind, F.lit('" <x>')).alias("text")),
        F.struct(finish.alias("at"), F.lit(1).alias("o"), F.col("event_id").alias("id"),
                 F.concat(stamp(finish), F.lit('\n\t [Node] Finished "node_'), kind, F.lit('", elapsed time '), elapsed, F.lit("s.")).alias("text")),
    )
    lines = t.events.select(F.floor(F.col("event_id") / 8).alias("log"), F.explode(entry).alias("e"))
    return lines.groupBy("log").agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["text"]), "\n").alias("text"))


@query(
    "f1_executed_nodes",
    """
    SELECT event_id // 8 AS log, 'node_' || event_type AS node, event_type || '_wf.node_' || event_type AS path, COUNT(*) AS n, ROUND(SUM(floor(value * 1000) / 1000), 3) AS elapsed_s FROM events GROUP BY ALL""",
)
def executed_nodes(t):
    nodes = E.executed_nodes(E.log_events(_logs(t), ["log"], "text"), ["log"], {"purchase_wf": "spend"}, {"click_wf.node_click": "press"})
    out = nodes.groupBy("log", "node", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("elapsed_s").alias("elapsed_s"))
    return rounded(out, 3)


@query(
    "f1_crowded_log",
    """
    WITH e AS (SELECT event_id AS i, event_type, CASE event_type WHEN 'purchase' THEN 'spend' WHEN 'click' THEN 'press' ELSE 'unmapped' END AS class, 7 * event_id AS s, 7 * event_id + 3 + 10 * CAST(floor(value * 10) AS BIGINT) AS f, event_id > 0 AS ends FROM events),
    r AS (SELECT DISTINCT a.i FROM e a JOIN e b ON b.i BETWEEN a.i - 2 AND a.i + 2 AND b.class <> a.class AND b.s <= a.f AND (NOT b.ends OR b.f > a.f OR (b.f = a.f AND b.i > a.i)) WHERE a.ends)
    SELECT 'work' AS node, event_type || '_wf.n' AS path, COUNT(*) AS n, ROUND(SUM((f - s) / 10.0), 1) AS elapsed_s, COUNT(r.i) AS n_ambiguous FROM e LEFT JOIN r USING (i) WHERE ends GROUP BY ALL
    UNION ALL SELECT 'ghost', NULL, COUNT(*), ROUND(SUM((f - s) / 10.0), 1), 0 FROM e WHERE i % 50 = 7 HAVING COUNT(*) > 0""",
)
def crowded_log(t):
    """All events in one log: hundreds in flight at any time, one that never ends, and finishes that nothing was begun for."""
    i = F.col("event_id")
    start = 7 * i
    finish = start + 3 + 10 * F.floor(F.col("value") * 10).cast("long")
    path, no_path, no_time = F.concat("event_type", F.lit("_wf.n")), F.lit(None).cast("string"), F.lit(None).cast("double")

    def row(at, o, event, node, where, elapsed):
        return F.struct(at.alias("at"), F.lit(o).alias("o"), F.lit(event).alias("event"), F.lit(node).alias("node"), where.alias("path"), elapsed.alias("elapsed_s"))

    elapsed = (finish - start) / 10
    rows = [
        row(start, 0, "setup", "work", path, no_time), row(start, 1, "execute", "work", no_path, no_time),
        F.when(i > 0, row(finish, 2, "finish", "work", no_path, elapsed)), F.when(i % 50 == 7, row(finish, 3, "finish", "ghost", no_path, elapsed)),
    ]
    events = t.events.select(F.lit("all").alias("log"), "event_id", F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("e"))
    events = events.select("log", "event_id", "e.*").withColumn("chunk", F.floor(F.col("at") / 20_000))
    lines = row_position(events, ["log"], ["at", "o", "event_id"], "line_number", "chunk")
    lines = lines.select("log", "line_number", (F.col("at") * 100_000).alias("stamp_us"), "event", "node", "path", "elapsed_s")
    nodes = E.executed_nodes(lines, ["log"], {"purchase_wf": "spend", "click_wf": "press"})
    out = nodes.groupBy("node", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("elapsed_s").alias("elapsed_s"), F.count_if("ambiguous").alias("n_ambiguous"))
    return rounded(out, 1)


@query(
    "f2_longest_prefix",
    """
    SELECT stage, COUNT(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'first' WHEN l_returnflag = 'A' THEN 'anatomy' WHEN l_returnflag = 'N' THEN 'normal' ELSE 'unmapped' END AS stage FROM lineitem) GROUP BY stage""",
)
def longest_prefix(t):
    paths = t.lineitem.select(F.concat_ws(".", "l_returnflag", F.concat(F.lit("r"), F.col("l_linenumber").cast("string")), F.lit("x")).alias("path"))
    rules = t.spark.createDataFrame([("A", "anatomy"), ("A.r1", "first"), ("N", "normal"), ("N.r1.x.y", "never")], ["prefix", "value"])
    return E.longest_prefix(paths, "path", rules, "stage").groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f3_node_paths",
    """SELECT path, COUNT(*) AS n FROM (SELECT CASE WHEN l_linenumber = 1 THEN 'bold_wf.std.' || l_returnflag ELSE 'anat_wf.' || l_returnflag END AS path FROM lineitem) GROUP BY path""",
)
def node_paths(t):
    order, flag = F.col("l_orderkey").cast("string"), F.col("l_returnflag")
    run = F.concat(F.lit("/work/wd/fmriprep_25_2_wf/sub_"), order, F.lit("_wf/bold_ses_1_task_rest_run_01_wf/std/_in_tuple_a/"), flag)
    anatomy = F.concat(F.lit("/work/wd/fmriprep_25_2_wf/sub_"), order, F.lit("_wf/anat_wf/_hemi_L/mapflow/"), flag, F.lit("/_x0"))
    path = E.normalised_path(F.when(F.col("l_linenumber") == 1, run).otherwise(anatomy)).alias("path")
    return t.lineitem.groupBy(path).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f4_stage_occupancy",
    """
    WITH iv AS (SELECT user_id, event_id, event_type AS stage, epoch_us(ts) AS s, epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 18000000 AS e FROM events),
    w AS (SELECT user_id, SUM(e - s) / 1e6 AS running_s FROM iv GROUP BY user_id),
    pts AS (SELECT DISTINCT user_id, p FROM (SELECT user_id, s AS p FROM iv WHERE e > s UNION ALL SELECT user_id, e FROM iv WHERE e > s)), seg AS (SELECT user_id, p AS a, LEAD(p) OVER (PARTITION BY user_id ORDER BY p) AS b FROM pts),
    act AS (SELECT seg.user_id, a, b, COUNT(*) AS n FROM seg JOIN iv ON iv.user_id = seg.user_id AND s <= a AND e >= b WHERE b IS NOT NULL GROUP BY ALL),
    sh AS (SELECT iv.user_id, iv.stage, SUM((b - a) / n) / 1e6 AS share FROM iv JOIN act ON act.user_id = iv.user_id AND iv.s <= a AND iv.e >= b AND iv.e > iv.s GROUP BY ALL),
    ns AS (SELECT user_id, stage, SUM((e - s) / 1e6) AS node_s FROM iv GROUP BY ALL)
    SELECT user_id, stage, ROUND(COALESCE(share, 0) / running_s, 6) AS share, ROUND(node_s, 3) AS node_s FROM ns LEFT JOIN sh USING (user_id, stage) JOIN w USING (user_id) WHERE user_id IN (SELECT user_id FROM iv WHERE e > s)""",
)
def stage_occupancy(t):
    start = micros("ts")
    nodes = t.events.select(
        "user_id", F.col("event_id").alias("node_id"), F.col("event_type").alias("stage"), start.alias("start_us"),
        (start + F.round(F.col("value") * 100).cast("long") * 18000000).alias("end_us"),
    )
    running = nodes.groupBy("user_id").agg(F.sum((F.col("end_us") - F.col("start_us")) / 1e6).alias("running_s"))
    out = E.stage_occupancy(nodes, ["user_id"], running)
    return rounded(out.select("user_id", "stage", "share", "node_s"), 6, node_s=3)


_DAG = {"1": [], "2": ["1"], "3": ["1"], "4": ["2", "3"], "5": [], "6": ["5", "4"], "7": ["3"]}


@query(
    "f5_critical_path",
    """
    WITH d AS (SELECT l_orderkey, """
    + ", ".join(f"COALESCE(SUM(CASE WHEN l_linenumber = {i} THEN l_quantity END), 0) AS d{i}" for i in range(1, 8))
    + """ FROM lineitem GROUP BY 1), a AS (SELECT *, d1 + d2 AS f2, d1 + d3 AS f3 FROM d), b AS (SELECT *, GREATEST(f2, f3) + d4 AS f4 FROM a), c AS (SELECT *, GREATEST(d5, f4) + d6 AS f6 FROM b)
    SELECT l_orderkey, GREATEST(d1, f2, f3, f4, d5, f6, f3 + d7) AS critical_s FROM c""",
)
def critical_path(t):
    d = t.lineitem.select("l_orderkey", F.col("l_linenumber").cast("string").alias("step"), F.col("l_quantity").alias("seconds"))
    return E.critical_path(d, ["l_orderkey"], _DAG)


@query(
    "a12_session_measures",
    """
    WITH p AS (SELECT l_orderkey, l_returnflag AS step, l_linestatus = 'F' AND l_linenumber > 4 AS prior, l_quantity, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS usd, l_suppkey % 4 >= 1 AS settled, CASE WHEN l_returnflag = 'A' THEN 0.5 ELSE 1.0 END AS sc FROM lineitem),
    g AS (SELECT l_orderkey, COALESCE(SUM(l_quantity * sc) FILTER (NOT prior), 0) AS cores, CASE WHEN COUNT(usd) FILTER (NOT prior) = COUNT(*) FILTER (NOT prior) THEN COALESCE(SUM(usd * sc) FILTER (NOT prior), 0) END AS own,
                 CASE WHEN COUNT(usd) FILTER (prior) = COUNT(*) FILTER (prior) THEN COALESCE(SUM(usd * sc) FILTER (prior), 0) END AS retry, COUNT(DISTINCT CASE WHEN NOT prior THEN step END) AS steps, COUNT(*) FILTER (prior) AS n_prior,
                 BOOL_AND(settled) FILTER (NOT prior) AS settled, COALESCE(SUM(l_quantity) FILTER (NOT prior AND step = 'A'), 0) AS a, COALESCE(SUM(l_quantity) FILTER (NOT prior AND step = 'N'), 0) AS n, COALESCE(SUM(l_quantity) FILTER (NOT prior AND step = 'R'), 0) AS r, COUNT(*) FILTER (NOT prior) AS nf FROM p GROUP BY 1)
    SELECT l_orderkey, ROUND(cores, 4) AS cores, ROUND(retry, 4) AS retry_usd, n_prior AS n_prior_attempts, CAST(0 AS BIGINT) AS n_unknown_steps, settled, ROUND(own + retry, 4) AS usd, steps = 3 AS resources_complete,
           steps = 3 AND own + retry IS NOT NULL AS cost_complete, CASE WHEN nf > 0 THEN ROUND((a + GREATEST(n, r)) / 3600, 6) END AS time_h FROM g""",
)
def session_measures(t):
    n = F.col("l_linenumber")
    pods = t.lineitem.select(
        "l_orderkey", F.col("l_returnflag").alias("step"), ((F.col("l_linestatus") == "F") & (n > 4)).alias("prior"),
        F.col("l_quantity").alias("cores"), F.col("l_quantity").alias("running_s"), F.when(n != 7, F.col("l_extendedprice")).alias("usd"),
        (F.col("l_suppkey") % 4 >= 1).alias("settled"), F.lit(2).alias("k"),
    )
    out = E.session_measures(
        pods, ["l_orderkey"], {"A": "anatomy", "N": "functional", "R": "functional"}, {"A": [], "N": ["A"], "R": ["A"]}, ["cores"], "usd",
        divided_stage="anatomy",
    )
    return rounded(out, 4, time_h=6)


@query(
    "f6_ratio_spread",
    """
    WITH a AS (SELECT l_orderkey, SUM(l_quantity) AS q, SUM(l_extendedprice) AS x FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), b AS (SELECT l_orderkey, SUM(l_quantity) AS q, SUM(l_extendedprice) AS x FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
    r AS (SELECT 'q' AS measure, a.q / b.q AS v FROM a JOIN b USING (l_orderkey) UNION ALL SELECT 'price', a.x / b.x FROM a JOIN b USING (l_orderkey))
    SELECT measure, COUNT(v) AS n, ROUND(QUANTILE_CONT(v, 0.5), 8) AS median, ROUND(QUANTILE_CONT(v, 0.25), 8) AS q25, ROUND(QUANTILE_CONT(v, 0.75), 8) AS q75, ROUND(QUANTILE_CONT(v, 0.05), 8) AS p05, ROUND(QUANTILE_CONT(v, 0.95), 8) AS p95 FROM r GROUP BY measure""",
)
def ratio_spread(t):
    a, b = (
        t.lineitem.filter(F.col("l_linestatus") == s).groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("price"))
        for s in "FO"
    )
    return rounded(E.ratio_spread(paired_ratios(a, b, ["l_orderkey"], ["q", "price"]), ["q", "price"]), 8)
