"""Scope, as-of, series and presence joins over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.functions.columns import count_if, day, micros
from tidemark.operators import joins as J
from tidemark.operators import series as S
from tidemark.operators.latest import accepted_latest, enrich_latest, hybrid_read, latest, scan_scope_join, superseded_plan
from tidemark.operators.ordered import DAY_US, HOUR_US, next_value, previous_value, time_chunk
from tidemark.plans.registry import query, rounded


@query(
    "w1_latest_per_unit",
    """
    SELECT subject, session, event_id, dt, metric FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY subject, session ORDER BY completed_us DESC, event_id DESC) AS rn
        FROM records) WHERE rn = 1""",
)
def latest_per_unit(t):
    out = latest(t.records, ["subject", "session"], "completed_us", ["event_id"])
    return out.select("subject", "session", "event_id", "dt", "metric")


@query(
    "w2_workflow_of_record",
    """
    SELECT subject, workflow_name, status, total_duration_s FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY subject ORDER BY finished_at DESC, workflow_name DESC) AS rn
        FROM workflow_runs) WHERE rn = 1""",
)
def workflow_of_record(t):
    out = latest(t.workflow_runs, ["subject"], "finished_at", ["workflow_name"])
    return out.select("subject", "workflow_name", "status", "total_duration_s")


@query(
    "j1_scan_scope_join",
    """
    WITH a AS (SELECT * FROM records WHERE session = 'purchase'), b AS (SELECT * FROM records WHERE session = 'signup'),
    scans AS (SELECT subject FROM a WHERE dt BETWEEN '2024-01-10' AND '2024-01-12'
              UNION SELECT subject FROM b WHERE dt BETWEEN '2024-01-10' AND '2024-01-12'),
    la AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY subject ORDER BY completed_us DESC, event_id DESC) AS rn FROM a),
    lb AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY subject ORDER BY completed_us DESC, event_id DESC) AS rn FROM b)
    SELECT s.subject, la.metric AS a_metric, la.dt AS a_dt, lb.metric AS b_metric, lb.dt AS b_dt
    FROM scans s LEFT JOIN la ON la.subject = s.subject AND la.rn = 1 LEFT JOIN lb ON lb.subject = s.subject AND lb.rn = 1""",
)
def scope_join(t):
    a, b = (t.records.filter(F.col("session") == s) for s in ("purchase", "signup"))
    window = F.col("dt").between("2024-01-10", "2024-01-12")
    return scan_scope_join(
        a, b, ["subject"], window, ["metric", "dt"], ["metric", "dt"], "completed_us", ["event_id"], "a_", "b_"
    )


@query(
    "j2_latest_enrichment",
    """
    WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY subject ORDER BY completed_us DESC, event_id DESC) AS rn
               FROM records WHERE session = 'error')
    SELECT c_custkey AS subject, c_acctbal, r.metric AS reg_metric, r.dt AS reg_dt
    FROM customer LEFT JOIN r ON r.subject = c_custkey AND r.rn = 1""",
)
def latest_enrichment(t):
    base = t.customer.select(F.col("c_custkey").alias("subject"), "c_acctbal")
    reg = t.records.filter(F.col("session") == "error")
    return enrich_latest(base, reg, ["subject"], "completed_us", ["event_id"], "reg_", ["metric", "dt"])


@query(
    "j5_subject_summary",
    """
    WITH c AS (SELECT subject, SUM(total_cost_usd) AS cost FROM costs GROUP BY subject)
    SELECT w.subject, w.status, ROUND(c.cost, 4) AS total_cost_usd, COUNT(DISTINCT f.session) AS n_bold_runs,
           ROUND(AVG(f.metric), 9) AS avg_metric, r.c_acctbal, r.c_mktsegment
    FROM (SELECT DISTINCT subject, status FROM workflow_runs) w
    LEFT JOIN records f ON w.subject = f.subject
    LEFT JOIN customer r ON w.subject = r.c_custkey
    LEFT JOIN c ON w.subject = c.subject
    GROUP BY w.subject, w.status, c.cost, r.c_acctbal, r.c_mktsegment""",
)
def subject_summary(t):
    workflows = t.workflow_runs.select("subject", "status")
    anatomy = t.customer.withColumnRenamed("c_custkey", "subject")
    bold = t.records.groupBy("subject").agg(
        F.countDistinct("session").alias("n_bold_runs"), F.round(F.avg("metric"), 9).alias("avg_metric")
    )
    cost = t.costs.groupBy("subject").agg(F.round(F.sum("total_cost_usd"), 4).alias("total_cost_usd"))
    out = J.subject_summary(workflows, [(anatomy, ["c_acctbal", "c_mktsegment"])], [bold, cost])
    return out.fillna(0, ["n_bold_runs"])


_NODES = """
    WITH e AS (SELECT *, epoch_us(ts) AS us FROM events),
    nodes AS (SELECT user_id AS host, event_type AS instance, us AS n_start,
                     us + CAST(value * 3600000000 AS BIGINT) // 2 AS n_end FROM e WHERE event_type IN ('signup', 'purchase') AND value > 12),
    pods AS (SELECT event_id AS pod, user_id AS host, us AS p_start, us + 600000000 AS p_end FROM e WHERE event_type = 'click')"""


def _nodes_and_pods(t):
    e = t.events.withColumn("us", micros("ts"))
    nodes = e.filter(F.col("event_type").isin("signup", "purchase") & (F.col("value") > 12)).select(
        F.col("user_id").alias("host"),
        F.col("event_type").alias("instance"),
        F.col("us").alias("n_start"),
        (F.col("us") + F.floor((F.col("value") * 3600000000).cast("long") / 2)).alias("n_end"),
    )
    pods = e.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("pod"),
        F.col("user_id").alias("host"),
        F.col("us").alias("p_start"),
        (F.col("us") + 600000000).alias("p_end"),
    )
    return nodes, pods


@query(
    "j7_assign_run_by_window",
    _NODES
    + """,
    g AS (SELECT pod, COUNT(n.host) AS n_candidates,
                 COUNT(*) FILTER (p_start >= n_start - 120000000 AND p_start <= n_end + 120000000) AS n_hits,
                 MAX(n_start) FILTER (p_start >= n_start - 120000000 AND p_start <= n_end + 120000000) AS hit,
                 MAX(n_start) FILTER (n_start <= p_start) AS before
          FROM pods p LEFT JOIN nodes n USING (host) GROUP BY pod)
    SELECT pod, n_candidates, n_hits, CASE WHEN n_hits = 1 THEN hit WHEN n_hits = 0 THEN before END AS run FROM g""",
)
def assign_run(t):
    nodes, pods = _nodes_and_pods(t)
    runs = nodes.withColumn("run", F.col("n_start"))
    out = S.assign_by_window(pods, runs, ["host"], ["pod"], "p_start", "run", "n_start", "n_end")
    return out.select("pod", "n_candidates", "n_hits", "run")


@query(
    "j8_asof_earlier",
    """
    WITH e AS (SELECT *, epoch_us(ts) AS us, strftime(ts, '%Y-%m-%d') AS d FROM events)
    SELECT b.event_id, MAX(p.us) AS asof_time, arg_max(p.event_id, p.us) AS asof_event_id
    FROM e b LEFT JOIN e p ON p.user_id = b.user_id AND p.d = b.d AND p.us < b.us AND p.event_type = 'signup'
    WHERE b.event_type = 'purchase' GROUP BY b.event_id""",
)
def asof(t):
    e = t.events.select("event_id", "user_id", day("ts").alias("d"), micros("ts").alias("us"), "event_type")
    bold = e.filter(F.col("event_type") == "purchase").drop("event_type")
    pairs = e.filter(F.col("event_type") == "signup").drop("event_type")
    out = S.asof_earlier(bold, pairs, ["user_id", "d"], "us", "us", ["event_id"], ["event_id"])
    return out.select("event_id", "asof_time", "asof_event_id")


_LINE = """
    WITH l AS (SELECT event_id, user_id, epoch_us(ts) AS us, strftime(ts, '%Y-%m-%d') AS d,
                      CASE event_type WHEN 'click' THEN 'AP' WHEN 'view' THEN 'PA' WHEN 'signup' THEN 'combined' END AS dir
               FROM events),
    p AS (SELECT *, CASE WHEN dir IN ('AP', 'PA') THEN dir END AS dd,
                 ROW_NUMBER() OVER (PARTITION BY user_id, d ORDER BY us, event_id) AS pos FROM l),
    q AS (SELECT *, LAG(dd) OVER w AS prev, LEAD(dd) OVER w AS nxt FROM p WINDOW w AS (PARTITION BY user_id, d ORDER BY pos)),
    r AS (SELECT *, MAX(CASE WHEN dd IS NOT NULL AND (prev IS NULL OR prev = dd) THEN pos END)
                    OVER (PARTITION BY user_id, d ORDER BY pos) AS start FROM q),
    s AS (SELECT *, CASE WHEN dir = 'combined' THEN 'single' WHEN dd IS NULL THEN NULL WHEN (pos - start) % 2 = 1 THEN 'pair_second'
                         WHEN nxt <> dd THEN 'pair_first' ELSE 'unpaired' END AS role FROM r)"""


def _timeline(t):
    kind = F.col("event_type")
    line = t.events.select(
        "event_id",
        "user_id",
        day("ts").alias("d"),
        micros("ts").alias("us"),
        F.when(kind == "click", "AP").when(kind == "view", "PA").when(kind == "signup", "combined").alias("dir"),
    )
    return line.withColumn("chunk", time_chunk("us", HOUR_US))


@query(
    "w8_pair_adjacent",
    _LINE
    + """ SELECT event_id, role, CASE role WHEN 'pair_second' THEN pos - 1 WHEN 'pair_first' THEN pos WHEN 'single' THEN pos END AS pair_at
          FROM s WHERE dir IS NOT NULL""",
)
def pair_adjacent(t):
    out = S.pair_adjacent(_timeline(t), ["user_id", "d"], ["us", "event_id"], "dir", "chunk")
    return out.filter(F.col("role").isNotNull()).select("event_id", "role", "pair_at")


@query(
    "j10_pair_verdicts",
    _LINE
    + """,
    pairs AS (SELECT user_id, d, pos AS pair_at, us FROM s WHERE role = 'single'
              UNION ALL SELECT user_id, d, pos - 1, us FROM s WHERE role = 'pair_second'),
    bold AS (SELECT s.event_id, s.user_id, s.d, s.us, e.value FROM s JOIN events e USING (event_id) WHERE s.dir IS NULL),
    a AS (SELECT b.event_id, b.user_id, b.d, b.value, arg_max(p.pair_at, p.us) AS pair_at
          FROM bold b LEFT JOIN pairs p ON p.user_id = b.user_id AND p.d = b.d AND p.us < b.us GROUP BY ALL),
    v AS (SELECT *, CAST(floor(value) AS BIGINT) % 3 AS missing, value > 8 AS passes FROM a),
    st AS (SELECT *, CASE WHEN missing = 2 THEN 'no_fm_flags'
                     WHEN (missing = 0 AND pair_at IS NULL) OR (missing = 1 AND pair_at IS NOT NULL) THEN 'fm_attachment_mismatch'
                     ELSE 'agrees' END AS st FROM v)
    SELECT user_id, d, pair_at, COUNT(*) AS n_attached, COUNT(*) FILTER (st = 'agrees') AS n_counted,
           CASE WHEN COUNT(*) FILTER (st = 'agrees') = 0 THEN 'no_qc_verdict'
                WHEN BOOL_AND(passes) FILTER (st = 'agrees') THEN 'usable'
                WHEN NOT BOOL_OR(passes) FILTER (st = 'agrees') THEN 'fm_failed_qc' ELSE 'conflicting_fm_verdicts' END AS verdict
    FROM st WHERE pair_at IS NOT NULL GROUP BY user_id, d, pair_at""",
)
def pair_verdicts(t):
    roles = S.pair_adjacent(_timeline(t), ["user_id", "d"], ["us", "event_id"], "dir", "chunk")
    pairs = roles.filter(F.col("role").isin("single", "pair_second")).select("user_id", "d", "us", "pair_at")
    bold = t.events.filter(~F.col("event_type").isin("click", "view", "signup")).select(
        "event_id", "user_id", day("ts").alias("d"), micros("ts").alias("us"), "value"
    )
    att = S.asof_earlier(bold, pairs, ["user_id", "d"], "us", "us", ["pair_at"])
    missing = F.floor("value") % 3
    status = S.attachment_status(
        F.lit(True), F.when(missing != 2, missing), F.col("asof_pair_at").isNotNull()
    )
    att = att.withColumn("agrees", status == "agrees").withColumn("passes", F.col("value") > 8)
    att = att.filter(F.col("asof_pair_at").isNotNull()).withColumnRenamed("asof_pair_at", "pair_at")
    return S.pair_verdicts(att, ["user_id", "d", "pair_at"], "passes", "agrees")


@query(
    "j9_match_series",
    """
    WITH li AS (SELECT *, epoch_us(l_shipdate) AS us, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id FROM lineitem),
    series AS (SELECT l_orderkey AS session, id AS series_id, CASE l_returnflag WHEN 'A' THEN 'T1w' WHEN 'N' THEN 'T2w' ELSE 'rest' END AS tab,
                      l_linestatus = 'F' AS norm, CASE WHEN l_quantity > 2 THEN l_partkey % 20 END AS uid, us FROM li),
    runs AS (SELECT l_orderkey AS session, CASE l_returnflag WHEN 'A' THEN 'T1w' WHEN 'N' THEN 'T2w' ELSE 'rest' END AS tab,
                    l_linenumber AS run_index, l_partkey % 20 AS uid, us + (l_suppkey % 3) * 700000 AS run_us
             FROM li WHERE l_discount > 0.04),
    known AS (SELECT DISTINCT l_orderkey AS session, CASE l_returnflag WHEN 'A' THEN 'T1w' WHEN 'N' THEN 'T2w' ELSE 'rest' END AS tab
              FROM li WHERE l_tax < 0.06),
    h AS (SELECT session, tab, uid, COUNT(*) AS hits, MAX(run_index) AS run_index, MAX(run_us) AS run_us FROM runs GROUP BY ALL),
    o AS (SELECT s.*, hits, run_index, ROUND((us - run_us) / 1000000, 3) AS off,
                 CASE WHEN k.session IS NULL THEN 'no_qc_row' WHEN s.uid IS NULL THEN 'no_uid' WHEN hits IS NULL THEN 'unmatched'
                      WHEN hits > 1 THEN 'ambiguous' WHEN abs(ROUND((us - run_us) / 1000000, 3)) > 1 THEN 'timestamp_mismatch'
                      ELSE 'matched' END AS st
          FROM series s LEFT JOIN known k USING (session, tab) LEFT JOIN h USING (session, tab, uid)),
    c AS (SELECT *, CASE WHEN st IN ('matched', 'timestamp_mismatch') THEN COUNT(*) FILTER (st IN ('matched', 'timestamp_mismatch'))
                         OVER (PARTITION BY session, tab, run_index) END AS claims FROM o),
    d AS (SELECT *, CASE WHEN claims > 1 THEN 'ambiguous' ELSE st END AS st2 FROM c),
    f AS (SELECT *, CASE WHEN st2 = 'unmatched' AND tab IN ('T1w', 'T2w') AND EXISTS (
                 SELECT 1 FROM d m WHERE m.session = d.session AND m.tab = d.tab AND m.norm <> d.norm AND m.st2 = 'matched'
                   AND abs(m.us - d.us) <= 432000000000) THEN 'twin_matched' ELSE st2 END AS status FROM d)
    SELECT session, tab, status, COUNT(*) AS n, COUNT(CASE WHEN status IN ('matched', 'timestamp_mismatch') THEN run_index END) AS n_runs,
           ROUND(SUM(CASE WHEN status IN ('matched', 'timestamp_mismatch') THEN off END), 3) AS seconds_off
    FROM f GROUP BY session, tab, status""",
)
def match_series(t):
    kind = F.when(F.col("l_returnflag") == "A", "T1w").when(F.col("l_returnflag") == "N", "T2w").otherwise("rest")
    li = t.lineitem.select(
        F.col("l_orderkey").alias("session"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("series_id"),
        kind.alias("table"),
        kind.alias("kind"),
        (F.col("l_linestatus") == "F").alias("norm"),
        (F.col("l_partkey") % 20).alias("uid"),
        micros("l_shipdate").alias("acquired_us"),
        "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey",
    )
    series = li.select(
        "session", "series_id", "table", "kind", "norm", "acquired_us", F.when(F.col("l_quantity") > 2, F.col("uid")).alias("uid")
    )
    runs = li.filter(F.col("l_discount") > 0.04).select(
        "session", "table", F.col("l_linenumber").alias("run_index"), "uid",
        (F.col("acquired_us") + (F.col("l_suppkey") % 3) * 700000).alias("acquired_us"),
    )
    out = S.match_series(series, runs, li.filter(F.col("l_tax") < 0.06), twin_s=5 * 86400.0)
    return rounded(
        out.groupBy("session", F.col("table").alias("tab"), "status").agg(
            F.count(F.lit(1)).alias("n"), F.count("run_index").alias("n_runs"), F.sum("seconds_off").alias("seconds_off")
        ),
        3,
    )


@query(
    "j11_accepted_latest",
    """
    SELECT subject, session, event_id, metric FROM (
        SELECT r.*, ROW_NUMBER() OVER (PARTITION BY subject, session ORDER BY completed_us DESC, event_id DESC) AS rn FROM records r
        WHERE subject IN (SELECT doc_id FROM labels WHERE quality = 1)) WHERE rn = 1""",
)
def accepted(t):
    units = t.labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("subject"))
    scoped = t.records.join(units.distinct(), "subject", "left_semi")
    out = accepted_latest(scoped, scoped.select("subject", "session"), ["subject", "session"], "completed_us", ["event_id"])
    return out.select("subject", "session", "event_id", "metric")


@query(
    "j13_producing_workflows",
    """SELECT workflow_name, status FROM workflow_runs WHERE workflow_name IN (SELECT workflow_name FROM pod_costs WHERE step = 'R')""",
)
def producing_workflows(t):
    producing = t.pod_costs.filter(F.col("step") == "R").select("workflow_name")
    return t.workflow_runs.join(producing, "workflow_name", "left_semi").select("workflow_name", "status")


@query(
    "j14_batch_scope",
    """
    WITH b AS (SELECT workflow_name FROM workflow_runs WHERE status = 'Succeeded')
    SELECT COUNT(*) FILTER (i) AS rows_in_batch, COUNT(*) FILTER (NOT i) AS rows_foreign,
           COUNT(DISTINCT CASE WHEN NOT i THEN workflow_name END) AS workflows_foreign,
           ROUND(COALESCE(SUM(total_cost_usd) FILTER (NOT i), 0), 4) AS usd_foreign
    FROM (SELECT *, workflow_name IN (SELECT workflow_name FROM b) AS i FROM pod_costs)""",
)
def batch_scope(t):
    batch = t.workflow_runs.filter(F.col("status") == "Succeeded")
    return rounded(J.foreign_summary(t.pod_costs, batch), 4)


@query(
    "j17_paired_ratios",
    """
    WITH a AS (SELECT l_orderkey, SUM(l_quantity) AS q, SUM(l_extendedprice) AS x FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
    b AS (SELECT l_orderkey, SUM(l_quantity) AS q, SUM(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END) AS x
          FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
    SELECT l_orderkey, ROUND(CASE WHEN b.q > 0 THEN a.q / b.q END, 6) AS q, ROUND(CASE WHEN b.x > 0 THEN a.x / b.x END, 6) AS price
    FROM a JOIN b USING (l_orderkey)""",
)
def paired_ratios(t):
    price = F.col("l_extendedprice")
    a = t.lineitem.filter(F.col("l_linestatus") == "F").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("q"), F.sum(price).alias("x")
    )
    b = t.lineitem.filter(F.col("l_linestatus") == "O").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("q"), F.sum(F.when(F.col("l_returnflag") == "A", price).otherwise(0.0)).alias("x")
    )
    return rounded(J.paired_ratios(a, b, ["l_orderkey"], {"q": ("q", "q"), "price": ("x", "x")}), 6)


@query(
    "j18_pair_calibration",
    """
    WITH m AS (SELECT l_orderkey AS o_orderkey, SUM(l_extendedprice) AS x FROM lineitem GROUP BY 1),
    d AS (SELECT abs(x - o_totalprice) AS d FROM m JOIN orders USING (o_orderkey))
    SELECT COUNT(*) AS n_pairs, ROUND(MAX(d), 4) AS max_abs_difference, COUNT(*) FILTER (d > 100000.005) AS n_beyond,
           ROUND(QUANTILE_CONT(d, 0.5), 4) AS median_abs_difference FROM d""",
)
def pair_calibration(t):
    measured = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("x"))
    return rounded(J.calibrate_pair(measured, t.orders, ["o_orderkey"], "x", "o_totalprice", 100000.005), 4)


@query(
    "j21_presence",
    """
    SELECT COALESCE(d.doc_id, p.page_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'missing_in_a' WHEN p.page_id IS NULL THEN 'missing_in_b' ELSE 'both' END AS presence
    FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT page_id FROM pages) p ON d.doc_id = p.page_id""",
)
def presence(t):
    """Documents and pages by number: two whole tables that differ by themselves."""
    return J.presence(t.documents, t.pages.select(F.col("page_id").alias("doc_id")), ["doc_id"])


_ELIGIBLE = """
    WITH f AS (SELECT c_custkey AS subject, c_acctbal, c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS has_qc,
                      c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS has_anatomy FROM customer),
    r AS (SELECT *, CASE WHEN NOT has_anatomy THEN 'no_anatomy' WHEN NOT has_qc THEN 'no_qc' WHEN c_acctbal < 1000 THEN 'low_balance' END AS reason FROM f)"""


def _eligibility(t):
    base = t.customer.select(F.col("c_custkey").alias("subject"), "c_acctbal", "c_nationkey", "c_mktsegment")
    qc = t.events.filter(F.col("event_type") == "purchase").select(F.col("user_id").alias("subject"))
    anatomy = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("subject"))
    flags = J.session_flags(base, {"has_qc": qc, "has_anatomy": anatomy}, ["subject"])
    reason = J.first_failing(
        [(~F.col("has_anatomy"), "no_anatomy"), (~F.col("has_qc"), "no_qc"), (F.col("c_acctbal") < 1000, "low_balance")]
    )
    return flags.withColumn("reason", reason)


@query("j22_session_flags", _ELIGIBLE + " SELECT subject, has_qc, has_anatomy, reason FROM r")
def session_flags(t):
    return _eligibility(t).select("subject", "has_qc", "has_anatomy", "reason")


@query(
    "q4_eligibility_frame",
    _ELIGIBLE + " SELECT COALESCE(reason, 'eligible') AS reason, COUNT(*) AS n_subjects, ROUND(AVG(c_acctbal), 4) AS mean_balance FROM r GROUP BY 1",
)
def eligibility_frame(t):
    out = _eligibility(t).groupBy(F.coalesce("reason", F.lit("eligible")).alias("reason"))
    return rounded(out.agg(F.count(F.lit(1)).alias("n_subjects"), F.avg("c_acctbal").alias("mean_balance")), 4)


@query(
    "a31_superseded_plan",
    """
    WITH r AS (SELECT subject, session, k, CASE WHEN k = 7 THEN NULL ELSE completed_us // 86400000000 END AS done,
                      CASE WHEN metric > 5 THEN 'pass' ELSE 'fail' END AS verdict, dt || '-' || (event_id % 5) AS path FROM records),
    o AS (SELECT *, COUNT(*) OVER (PARTITION BY path) AS in_object, MAX(done) OVER (PARTITION BY subject, session) AS newest FROM r),
    g AS (SELECT subject, session, COUNT(*) AS n_records, COUNT(*) FILTER (done IS NULL) AS n_undated, COUNT(*) FILTER (done = newest) AS n_newest,
                 COUNT(*) FILTER (done < newest) AS n_superseded, BOOL_OR(verdict = 'pass' AND done < newest) AS p, BOOL_OR(verdict = 'fail' AND done = newest) AS f,
                 MAX(in_object) FILTER (done < newest) AS shared FROM o GROUP BY ALL HAVING COUNT(*) > 1)
    SELECT subject, session, n_records, n_undated, n_newest, n_superseded,
           CASE WHEN n_undated > 0 THEN 'record_without_time' WHEN n_newest > 1 THEN 'ambiguous_final' WHEN p AND f THEN 'pass_superseded_by_fail'
                WHEN shared > 1 THEN 'shared_object' END AS hold FROM g""",
)
def superseded(t):
    r = t.records.select(
        "subject", "session",
        F.when(F.col("k") != 7, F.floor(F.col("completed_us") / DAY_US)).alias("at"),
        F.when(F.col("metric") > 5, "pass").otherwise("fail").alias("verdict"),
        F.concat_ws("-", "dt", (F.col("event_id") % 5).cast("string")).alias("path"),
    )
    return superseded_plan(r, ["subject", "session"], "at", "verdict", "path")


@query(
    "s3_hybrid_read",
    """
    SELECT event_id, dt, metric FROM records WHERE dt = '2024-01-20'
    UNION ALL SELECT event_id, dt, metric FROM records WHERE dt < '2024-01-20'""",
)
def hybrid(t):
    return hybrid_read(t.records, t.records, "2024-01-20", ["event_id", "dt", "metric"])


@query("u1_union_distinct", "SELECT o_custkey AS subject FROM orders UNION SELECT user_id FROM events")
def union_distinct(t):
    return t.orders.select(F.col("o_custkey").alias("subject")).union(t.events.select("user_id")).distinct()


@query(
    "u2_union_all_by_name",
    """SELECT source, COUNT(*) AS n, ROUND(SUM(amount), 4) AS amount FROM (
        SELECT 'orders' AS source, o_totalprice AS amount FROM orders UNION ALL SELECT 'lines', l_extendedprice FROM lineitem) GROUP BY source""",
)
def union_all(t):
    a = t.orders.select(F.lit("orders").alias("source"), F.col("o_totalprice").alias("amount"))
    b = t.lineitem.select(F.col("l_extendedprice").alias("amount"), F.lit("lines").alias("source"))
    out = a.unionByName(b).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    return rounded(out, 4)


@query("u3_set_difference", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def set_difference(t):
    return t.orders.select("o_orderkey").subtract(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")))


@query("u4_set_intersection", "SELECT user_id FROM events INTERSECT SELECT doc_id FROM labels WHERE quality = 1")
def set_intersection(t):
    return t.events.select("user_id").intersect(t.labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("user_id")))


@query(
    "w9_window_overlap",
    _NODES
    + """,
    o AS (SELECT host, n_start, n_end, LAG(n_end) OVER (PARTITION BY host ORDER BY n_start, n_end, instance) AS prev_end FROM nodes)
    SELECT host, COUNT(*) AS n_instances, BOOL_OR(COALESCE(n_start < prev_end, FALSE)) AS overlap FROM o GROUP BY host""",
)
def window_overlap(t):
    from tidemark.operators.intervals import overlapping_hosts

    nodes, _ = _nodes_and_pods(t)
    return overlapping_hosts(nodes, ["host"], "n_start", "n_end", ["instance"])


@query(
    "j6_containment_join",
    _NODES
    + """,
    o AS (SELECT *, LAG(n_end) OVER (PARTITION BY host ORDER BY n_start, n_end, instance) AS prev_end FROM nodes),
    h AS (SELECT host, COUNT(*) AS n, BOOL_OR(COALESCE(n_start < prev_end, FALSE)) AS overlap FROM o GROUP BY host),
    g AS (SELECT p.pod, p.host, COUNT(*) FILTER (n_start <= p_start AND p_end <= n_end) AS n_containing,
                 MAX(instance) FILTER (n_start <= p_start AND p_end <= n_end) AS inside, MAX(instance) AS only_one
          FROM pods p LEFT JOIN nodes USING (host) GROUP BY ALL),
    j AS (SELECT g.*, h.n, overlap FROM g LEFT JOIN h USING (host))
    SELECT pod, CASE WHEN n IS NULL THEN 'NO_ASSET' WHEN n = 1 THEN 'MATCHED' WHEN overlap OR n_containing <> 1 THEN 'AMBIGUOUS' ELSE 'MATCHED' END AS reason,
           CASE WHEN n = 1 THEN only_one WHEN overlap OR n_containing <> 1 THEN NULL ELSE inside END AS instance FROM j""",
)
def containment_join(t):
    from tidemark.operators.intervals import contained_in_one

    nodes, pods = _nodes_and_pods(t)
    return contained_in_one(
        pods, nodes, ["host"], ["pod"], ("p_start", "p_end"), ("n_start", "n_end"), "instance", tie_break=["instance"]
    ).select("pod", "reason", "instance")


@query(
    "p19_route_rows",
    """
    SELECT target, COUNT(*) AS n FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'audit-store' WHEN o_orderstatus = 'P' THEN NULL ELSE 'main' END AS target FROM orders)
    GROUP BY target""",
)
def route_rows(t):
    name = F.concat(
        F.when(F.col("o_orderstatus") == "F", "audit-one-").when(F.col("o_orderstatus") == "P", "audit-two-").otherwise("batch-"),
        F.col("o_orderkey").cast("string"),
    )
    routed = J.route_rows(t.orders.select(name.alias("workflow_name")), "workflow_name", {"one": "audit-store"}, "main")
    return routed.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p21_step_vocabulary",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'anatomy' WHEN 'N' THEN 'normal' ELSE 'registration' END AS canonical, COUNT(*) AS n FROM lineitem GROUP BY 1""",
)
def step_vocabulary(t):
    vocabulary = {"A": "anatomy", "N": "normal", "R": "registration"}
    out = J.lookup_steps(t.lineitem.select("l_returnflag"), vocabulary, "l_returnflag", "canonical")
    return out.groupBy("canonical").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a27_difference_classes",
    """
    WITH r AS (SELECT l_returnflag AS measure, l_discount AS distance, CASE WHEN l_suppkey % 3 = 0 THEN 'cpu' ELSE 'cuda' END AS ha,
                      CASE WHEN l_partkey % 2 = 0 THEN 'cpu' WHEN l_partkey % 5 = 0 THEN 'tpu' ELSE 'cuda' END AS hb FROM lineitem),
    fl AS (SELECT measure, CASE WHEN ha < hb THEN ha || '|' || hb ELSE hb || '|' || ha END AS pair, MAX(distance) * 0.5 AS largest
           FROM r WHERE NOT (measure = 'A' AND ha <> hb) AND NOT (measure = 'N' AND ha = hb) GROUP BY ALL),
    sm AS (SELECT measure, MIN(largest) AS same FROM fl WHERE split_part(pair, '|', 1) = split_part(pair, '|', 2) GROUP BY measure),
    j AS (SELECT r.*, fl.largest, sm.same FROM r LEFT JOIN fl ON fl.measure = r.measure AND fl.pair = CASE WHEN ha < hb THEN ha || '|' || hb ELSE hb || '|' || ha END
          LEFT JOIN sm ON sm.measure = r.measure)
    SELECT measure, verdict, COUNT(*) AS n FROM (SELECT *, CASE WHEN ha = hb AND largest IS NULL THEN 'unexplained' WHEN ha = hb AND distance <= largest THEN 'within_noise'
           WHEN ha = hb THEN 'defect' WHEN distance <= same THEN 'within_noise' WHEN largest IS NULL THEN 'unexplained' WHEN distance <= largest THEN 'hardware' ELSE 'defect' END AS verdict FROM j)
    GROUP BY measure, verdict""",
)
def difference_classes(t):
    part = F.col("l_partkey")
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("measure"),
        F.col("l_discount").alias("distance"),
        F.when(F.col("l_suppkey") % 3 == 0, "cpu").otherwise("cuda").alias("hardware_a"),
        F.when(part % 2 == 0, "cpu").when(part % 5 == 0, "tpu").otherwise("cuda").alias("hardware_b"),
    )
    same = F.col("hardware_a") == F.col("hardware_b")
    seen = rows.filter(~((F.col("measure") == "A") & ~same) & ~((F.col("measure") == "N") & same))
    floor = seen.groupBy(
        "measure", F.array_join(F.array_sort(F.array("hardware_a", "hardware_b")), "|").alias("pair")
    ).agg((F.max("distance") * 0.5).alias("largest"))
    return J.classified_differences(rows, floor).groupBy("measure", "verdict").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a26_family_differences",
    """
    WITH a AS (SELECT l_orderkey, l_linenumber, AVG(l_quantity) AS q, AVG(l_tax) AS t, AVG(l_discount) AS d FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL),
    b AS (SELECT l_orderkey, l_linenumber, AVG(l_quantity) AS q, AVG(l_tax) AS t, AVG(CASE WHEN l_quantity > 5 THEN l_discount END) AS d FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL),
    j AS (SELECT l_linenumber, MAX(abs(a.q - b.q)) AS dq, MAX(abs(a.q)) AS mq, MAX(abs(a.t - b.t)) AS dt, MAX(abs(a.t)) AS mt, MAX(abs(a.d - b.d)) AS dd, MAX(abs(a.d)) AS md,
                 BOOL_OR((a.d IS NULL) <> (b.d IS NULL)) AS nd FROM a JOIN b USING (l_orderkey, l_linenumber) GROUP BY l_linenumber),
    c AS (SELECT l_linenumber, 'motion' AS family, 'q' AS c, FALSE AS n, dq / CASE WHEN mq > 0 THEN mq ELSE 1 END AS x FROM j
          UNION ALL SELECT l_linenumber, 'motion', 't', FALSE, dt / CASE WHEN mt > 0 THEN mt ELSE 1 END FROM j
          UNION ALL SELECT l_linenumber, 'signal', 'd', nd, CASE WHEN nd THEN 1 ELSE dd / CASE WHEN md > 0 THEN md ELSE 1 END END FROM j)
    SELECT l_linenumber, family, ROUND(MAX(x), 6) AS max_rel_diff, BOOL_OR(n) AS nan_mismatch FROM c GROUP BY l_linenumber, family""",
)
def family_differences(t):
    keys = ["l_orderkey", "l_linenumber"]
    base = [F.avg("l_quantity").alias("q"), F.avg("l_tax").alias("t")]
    a = t.lineitem.filter(F.col("l_linestatus") == "F").groupBy(*keys).agg(*base, F.avg("l_discount").alias("d"))
    b = t.lineitem.filter(F.col("l_linestatus") == "O").groupBy(*keys).agg(
        *base, F.avg(F.when(F.col("l_quantity") > 5, F.col("l_discount"))).alias("d")
    )
    out = J.family_differences(a, b, keys, ["l_linenumber"], {"q": "motion", "t": "motion", "d": "signal"})
    return rounded(out.drop("worst_column"), 6)


@query(
    "p12_path_classes",
    """
    WITH p AS (SELECT l_linenumber AS n, CASE l_linenumber WHEN 1 THEN 'anat/s_rec-norm_T1w.json' WHEN 2 THEN 'anat/s_T2w.json' WHEN 3 THEN 'func/s_task-rest_run-01_bold.json'
        WHEN 4 THEN 'fmap/s_acq-func_dir-AP_run-1_epi.json' WHEN 5 THEN 'fmap/s_acq-func_run-2_epi.json' WHEN 6 THEN 'dwi/s_dwi.json' ELSE 'func/s_sbref.json' END AS path FROM lineitem)
    SELECT path, CASE n WHEN 1 THEN 'T1w' WHEN 2 THEN 'T2w' WHEN 3 THEN 'bold' WHEN 4 THEN 'fmap' WHEN 5 THEN 'fmap' END AS kind, CASE n WHEN 3 THEN 'rest' END AS task,
           CASE n WHEN 4 THEN 'AP' WHEN 5 THEN 'combined' END AS direction, n = 1 AS norm, COUNT(*) AS n_rows FROM p GROUP BY ALL""",
)
def path_classes(t):
    n = F.col("l_linenumber")
    path = F.element_at(
        F.array(
            *[
                F.lit(p)
                for p in (
                    "anat/s_rec-norm_T1w.json", "anat/s_T2w.json", "func/s_task-rest_run-01_bold.json",
                    "fmap/s_acq-func_dir-AP_run-1_epi.json", "fmap/s_acq-func_run-2_epi.json", "dwi/s_dwi.json", "func/s_sbref.json",
                )
            ]
        ),
        n,
    )
    out = t.lineitem.select(path.alias("path"))
    fields = P.path_class("path")
    return out.select("path", *[c.alias(k) for k, c in fields.items()]).groupBy("path", *fields).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "p13_tolerant_datetime",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE epoch_us(o_orderdate) + (o_orderkey % 60) * 1000000 + CASE WHEN o_orderkey % 3 = 0 THEN 250000 ELSE 0 END END AS acquired_us FROM orders""",
)
def tolerant_datetime(t):
    k = F.col("o_orderkey") % 3
    second = F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0")
    date = F.when(k == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    time = (
        F.when(k == 0, F.concat(F.lit("0000"), second, F.lit(".25")))
        .when(k == 1, F.concat(F.lit("00:00:"), second))
        .otherwise("noon")
    )
    return t.orders.select("o_orderkey", micros(P.tolerant_datetime(date, time)).alias("acquired_us"))


@query(
    "j20_nested_unnest_join",
    """
    WITH targets AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_quantity > 45)
    SELECT l.l_orderkey, l.l_returnflag, COUNT(*) AS n FROM lineitem l JOIN targets USING (l_orderkey, l_returnflag) WHERE l_linestatus = 'F' GROUP BY ALL""",
)
def nested_unnest_join(t):
    """Manifests hold a nested list of steps; the list is exploded and joined to the targets."""
    from tidemark.operators.outcomes import explode_steps

    # pre-aggregated per distinct step, so a nested list holds at most one entry per (step, status)
    steps = t.lineitem.groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    manifests = steps.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_returnflag").alias("step"), F.col("l_linestatus").alias("status"), "n")).alias("steps")
    )
    targets = t.lineitem.filter(F.col("l_quantity") > 45).select("l_orderkey", F.col("l_returnflag").alias("step")).distinct()
    hit = explode_steps(manifests, "steps").filter(F.col("status") == "F").join(targets, ["l_orderkey", "step"])
    return hit.groupBy("l_orderkey", F.col("step").alias("l_returnflag")).agg(F.sum("n").alias("n"))
