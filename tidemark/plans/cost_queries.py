"""Cost reports over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import micros
from tidemark.operators import allocations as AL
from tidemark.operators import audit_report as AR
from tidemark.operators import costs as C
from tidemark.operators import reconstruction as RC
from tidemark.operators.ordered import DAY_US
from tidemark.plans.records_queries import scratch
from tidemark.plans.registry import query, rounded
from tidemark.plans.standins import allocation_sets
from tidemark.sources.wide_runs import export_csv


@query(
    "a1_subject_costs",
    """
    SELECT subject, COUNT(*) AS n_records, COUNT(DISTINCT workflow_name) AS n_workflows,
           ROUND(SUM(total_cost_usd), 4) AS total_cost_usd, ROUND(SUM(cpu_cost_usd), 4) AS cpu_cost_usd,
           ROUND(SUM(memory_cost_usd), 4) AS memory_cost_usd, ROUND(SUM(gpu_cost_usd), 4) AS gpu_cost_usd,
           ROUND(SUM(total_adjustment_usd), 4) AS total_adjustment_usd,
           MAX(scrape_age_days) AS max_scrape_age_days, MIN(date) AS first_date, MAX(date) AS last_date
    FROM costs GROUP BY subject""",
)
def subject_costs(t):
    return rounded(C.subject_costs(t.costs), 4)


@query(
    "a2_step_costs",
    """
    SELECT step, phase, COUNT(*) AS n_pods, COUNT(DISTINCT subject) AS n_subjects,
           ROUND(SUM(total_cost_usd), 4) AS total_cost_usd, ROUND(AVG(total_cost_usd), 4) AS mean_cost_usd,
           MAX(total_cost_usd) AS max_cost_usd,
           ROUND(SUM(cpu_cost_usd), 4) AS cpu_cost_usd, ROUND(SUM(memory_cost_usd), 4) AS memory_cost_usd,
           ROUND(SUM(gpu_cost_usd), 4) AS gpu_cost_usd, ROUND(SUM(pv_cost_usd), 4) AS pv_cost_usd,
           ROUND(AVG(runtime_minutes), 4) AS mean_runtime_minutes,
           ROUND(AVG(cpu_efficiency), 4) AS mean_cpu_efficiency, ROUND(AVG(ram_efficiency), 4) AS mean_ram_efficiency,
           ROUND(SUM(total_cost_usd) * 100.0 / SUM(SUM(total_cost_usd)) OVER (), 4) AS pct_of_total,
           ROUND(QUANTILE_CONT(total_cost_usd, 0.5), 4) AS median_cost_usd,
           ROUND(QUANTILE_CONT(total_cost_usd, 0.95), 4) AS p95_cost_usd
    FROM pod_costs GROUP BY step, phase""",
)
def step_costs(t):
    return rounded(C.step_costs(t.pod_costs), 4)


@query(
    "p1_cost_scope",
    """
    SELECT workflow_name, subject, date, total_cost_usd FROM costs
    WHERE date >= '1997-01-01' AND date <= '1998-12-31'
      AND subject IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def scoped_costs(t):
    subjects = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    scoped = C.cost_scope(t.costs, subjects, "1997-01-01", "1998-12-31")
    return scoped.select("workflow_name", "subject", "date", "total_cost_usd")


_SAVINGS = """
    SELECT {group} COUNT(*) AS n_pods, ROUND(SUM(total_cost_usd), 4) AS actual_cost_usd,
           ROUND(SUM(CASE WHEN m IS NOT NULL THEN total_cost_usd END), 4) AS priced_cost_usd,
           ROUND(SUM((cpu_cost_usd + memory_cost_usd + gpu_cost_usd) * m + pv_cost_usd + network_cost_usd), 2)
               AS ondemand_cost_usd,
           ROUND(AVG(m), 6) AS mean_multiplier,
           ROUND(SUM((cpu_cost_usd + memory_cost_usd + gpu_cost_usd) * m + pv_cost_usd + network_cost_usd)
               - SUM(CASE WHEN m IS NOT NULL THEN total_cost_usd END), 2) AS savings_usd,
           ROUND(COALESCE(SUM(CASE WHEN m IS NOT NULL THEN total_cost_usd END), 0) / NULLIF(SUM(total_cost_usd), 0), 6)
               AS coverage_frac
    FROM (SELECT *, CASE WHEN node_effective_usd_per_hour > 0 AND node_ondemand_usd_per_hour > 0
                         THEN node_ondemand_usd_per_hour / node_effective_usd_per_hour END AS m FROM pod_costs) {by}"""
_SAVINGS_DIGITS = {"ondemand_cost_usd": 2, "savings_usd": 2, "actual_cost_usd": 4, "priced_cost_usd": 4}


@query("a3_list_price_savings", _SAVINGS.format(group="", by=""))
def savings(t):
    return rounded(C.list_price_savings(t.pod_costs), 6, **_SAVINGS_DIGITS)


@query("a3_list_price_savings_by_step", _SAVINGS.format(group="step,", by="GROUP BY step"))
def savings_by_step(t):
    return rounded(C.list_price_savings(t.pod_costs, "step"), 6, **_SAVINGS_DIGITS)


@query(
    "j4_run_costs",
    """
    WITH pod AS (SELECT workflow_name, step, subject, session, SUM(total_cost_usd) AS total, SUM(cpu_cost_usd) AS cpu,
                        SUM(memory_cost_usd) AS mem, SUM(gpu_cost_usd) AS gpu, MAX(date) AS date,
                        MAX(scrape_age_days) AS scrape_age_days
                 FROM pod_costs GROUP BY ALL),
    runs AS (SELECT workflow_name, CASE step WHEN 'N' THEN 'A' ELSE step END AS step, subject, session, task, run
             FROM step_outcomes WHERE step <> 'R'),
    n AS (SELECT workflow_name, step, subject, session, COUNT(*) AS n_runs_in_pod FROM runs GROUP BY ALL)
    SELECT workflow_name, step, subject, session, task, run, n_runs_in_pod, ROUND(total / n_runs_in_pod, 6) AS total_cost_usd,
           ROUND(cpu / n_runs_in_pod, 6) AS cpu_cost_usd, ROUND(mem / n_runs_in_pod, 6) AS memory_cost_usd,
           ROUND(gpu / n_runs_in_pod, 6) AS gpu_cost_usd, date, scrape_age_days
    FROM runs JOIN n USING (workflow_name, step, subject, session)
              JOIN pod USING (workflow_name, step, subject, session)""",
)
def run_costs(t):
    return rounded(
        C.run_costs(t.pod_costs, t.step_outcomes, rename_steps={"N": "A"}, drop_steps=["R"], absent=None), 6
    )


@query(
    "j3_subject_run_report",
    """
    WITH c AS (SELECT workflow_name, SUM(total_cost_usd) AS cost FROM pod_costs GROUP BY workflow_name),
    w AS (SELECT subject, status, total_duration_s, cost,
                 ROW_NUMBER() OVER (PARTITION BY subject ORDER BY finished_at DESC, workflow_name DESC) AS rn
          FROM workflow_runs LEFT JOIN c USING (workflow_name)),
    f AS (SELECT o_custkey AS subject, o_orderkey AS run, c_acctbal AS mean_fd
          FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT f.subject, run, mean_fd, status, total_duration_s, ROUND(cost, 4) AS total_cost_usd
    FROM f LEFT JOIN w ON w.subject = f.subject AND rn = 1""",
)
def subject_run_report(t):
    runs = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("subject"), F.col("o_orderkey").alias("run"), F.col("c_acctbal").alias("mean_fd")
    )
    out = C.subject_run_report(runs, t.workflow_runs, t.pod_costs, workflow_time="finished_at")
    return rounded(out, 4)


@query(
    "a9_batch_cost_summary",
    """
    SELECT COUNT(*) AS n_subjects, ROUND(SUM(c), 4) AS total_usd, ROUND(AVG(c), 4) AS mean_usd,
           ROUND(MIN(c), 4) AS min_usd, ROUND(MAX(c), 4) AS max_usd, ROUND(QUANTILE_CONT(c, 0.5), 4) AS median_usd
    FROM (SELECT subject, SUM(total_cost_usd) AS c FROM costs GROUP BY subject)""",
)
def batch_cost_summary(t):
    return rounded(C.batch_cost_summary(t.costs), 4)


@query(
    "a45_settled_cost_block",
    """
    SELECT COUNT(*) AS n_subjects, ROUND(SUM(c), 4) AS total_usd, ROUND(AVG(c), 4) AS mean_usd,
           ROUND(MIN(c), 4) AS min_usd, ROUND(MAX(c), 4) AS max_usd, ROUND(QUANTILE_CONT(c, 0.5), 4) AS median_usd,
           MIN(a) AS min_scrape_age_days, MIN(a) >= 3 AS settled
    FROM (SELECT subject, SUM(total_cost_usd) AS c, MIN(scrape_age_days) AS a FROM costs
          WHERE date BETWEEN '1997-01-01' AND '1997-12-31' GROUP BY subject)""",
)
def settled_cost_block(t):
    return rounded(C.settled_cost_block(C.cost_scope(t.costs, date_from="1997-01-01", date_to="1997-12-31")), 4)


@query(
    "t2_top_spend",
    """
    SELECT pipeline, subject, ROUND(SUM(total_cost_usd), 4) AS total_usd, ROUND(SUM(cpu_cost_usd), 4) AS cpu_usd,
           ROUND(SUM(memory_cost_usd), 4) AS memory_usd, ROUND(SUM(gpu_cost_usd), 4) AS gpu_usd,
           COUNT(DISTINCT date) AS days_active
    FROM costs GROUP BY pipeline, subject ORDER BY total_usd DESC, pipeline, subject LIMIT 20""",
)
def top_spend(t):
    return C.top_spend(t.costs)


_PRICED = """
    WITH r AS (SELECT *, runtime_minutes / 60.0 AS h, cpu_core_hours * 8.0 AS ram_gb_hours,
                      CASE WHEN phase = 'F' THEN cpu_core_hours / 4 ELSE 0.0 END AS gpu_hours FROM pod_costs),
    s AS (SELECT s_suppkey AS node_instance_type, s_nationkey % 5 * 1.0 + 1 AS vcpu,
                 s_nationkey * 20.0 + 30 AS mem_gib, s_nationkey % 3 AS gpus FROM supplier WHERE s_acctbal > 0),
    p AS (SELECT r.*, vcpu, mem_gib, gpus,
                 CASE WHEN h <= 0 THEN NULL WHEN vcpu IS NULL THEN 'unknown-instance-type'
                      WHEN gpu_hours > 0 AND gpus = 0 THEN 'gpu-pod-on-cpu-node'
                      WHEN cpu_core_hours / h > vcpu * 1.02 OR ram_gb_hours / h > mem_gib * 1.02
                           THEN 'pod-larger-than-node'
                      WHEN NOT COALESCE(node_ondemand_usd_per_hour, 0.0) > 0 THEN 'no-on-demand-rate' END AS problem
          FROM r LEFT JOIN s USING (node_instance_type)),
    q AS (SELECT *, CASE WHEN h <= 0 THEN 0.0 WHEN problem IS NULL THEN
                         GREATEST(cpu_core_hours / vcpu, ram_gb_hours / mem_gib,
                                  CASE WHEN gpus > 0 THEN gpu_hours / gpus ELSE 0.0 END) END AS node_h FROM p)"""


def _priced_rows(t):
    rows = t.pod_costs.withColumn("ram_gb_hours", F.col("cpu_core_hours") * 8.0).withColumn(
        "gpu_hours", F.when(F.col("phase") == "F", F.col("cpu_core_hours") / 4).otherwise(0.0)
    )
    specs = t.supplier.filter(F.col("s_acctbal") > 0).select(
        F.col("s_suppkey").alias("node_instance_type"),
        (F.col("s_nationkey") % 5 * 1.0 + 1).alias("vcpu"),
        (F.col("s_nationkey") * 20.0 + 30).alias("mem_gib"),
        (F.col("s_nationkey") % 3).alias("gpus"),
    )
    return C.price_rows(rows, specs)


@query(
    "a11_row_pricing",
    _PRICED
    + """
    SELECT COALESCE(problem, 'priced') AS problem, COUNT(*) AS n_rows, ROUND(SUM(node_h), 4) AS node_h,
           ROUND(SUM(node_h * node_ondemand_usd_per_hour + pv_cost_usd + network_cost_usd), 3) AS ondemand_usd
    FROM q GROUP BY 1""",
)
def row_pricing(t):
    out = (
        _priced_rows(t)
        .groupBy(F.coalesce("problem", F.lit("priced")).alias("problem"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("node_h").alias("node_h"),
            F.sum("ondemand_usd").alias("ondemand_usd"),
        )
    )
    return rounded(out, 4, ondemand_usd=3)


@query(
    "a10_pod_aggregation",
    _PRICED
    + """
    SELECT workflow_name, step, ROUND(SUM(cpu_core_hours), 6) AS cpu_core_hours,
           ROUND(SUM(runtime_minutes), 6) AS runtime_minutes, ROUND(SUM(total_cost_usd), 4) AS total_cost_usd,
           CASE WHEN COUNT(node_h) = COUNT(*) THEN ROUND(SUM(node_h), 6) END AS node_h,
           CASE WHEN COUNT(node_h) = COUNT(*)
                THEN ROUND(SUM(node_h * node_ondemand_usd_per_hour + pv_cost_usd + network_cost_usd), 6) END AS ondemand_usd,
           COUNT(problem) = 0 AS priced,
           arg_min(problem, date || pod) FILTER (problem IS NOT NULL) AS problem,
           BOOL_AND(scrape_age_days >= 3) AS settled, COUNT(*) AS n_rows,
           string_agg(DISTINCT phase, ',' ORDER BY phase) AS phases
    FROM q GROUP BY workflow_name, step""",
)
def pod_aggregation(t):
    out = C.aggregate_pod_costs(
        _priced_rows(t), ["workflow_name", "step"], order=["date", "pod"], listed={"phase": "phases"}
    )
    return rounded(out, 6, total_cost_usd=4)


@query(
    "a13_session_cost_report",
    """
    WITH p AS (SELECT *, CASE WHEN step <> 'R' THEN session END AS own_session FROM pod_costs),
    s AS (SELECT workflow_name, own_session, COUNT(*) AS n_runs FROM p WHERE own_session IS NOT NULL GROUP BY ALL),
    w AS (SELECT workflow_name, SUM(CASE WHEN own_session IS NULL THEN total_cost_usd END) AS shared_usd,
                 BOOL_AND(scrape_age_days >= 1) AS ok, BOOL_AND(scrape_age_days >= 3) AS settled
          FROM p GROUP BY workflow_name),
    o AS (SELECT workflow_name, own_session, SUM(total_cost_usd) AS own_usd FROM p WHERE own_session IS NOT NULL GROUP BY ALL),
    k AS (SELECT workflow_name, COUNT(*) AS k FROM s GROUP BY workflow_name)
    SELECT workflow_name, own_session, n_runs, k, settled, ROUND(own_usd, 4) AS own_usd, ROUND(shared_usd, 4) AS shared_usd,
           CASE WHEN settled THEN ROUND(COALESCE(own_usd, 0) + COALESCE(shared_usd, 0) / k, 4) END AS session_usd,
           CASE WHEN settled THEN ROUND((COALESCE(own_usd, 0) + COALESCE(shared_usd, 0) / k) / n_runs, 4) END AS usd_per_run
    FROM s JOIN w USING (workflow_name) JOIN k USING (workflow_name) LEFT JOIN o USING (workflow_name, own_session)""",
)
def session_cost_report(t):
    pods = t.pod_costs.withColumn("own_session", F.when(F.col("step") != "R", F.col("session")))
    sessions = (
        pods.filter(F.col("own_session").isNotNull())
        .groupBy("workflow_name", "own_session")
        .agg(F.count(F.lit(1)).alias("n_runs"))
    )
    return rounded(C.session_cost_report(pods, "own_session", sessions=sessions), 4)


def _audit_sql(age: int) -> str:
    """The report in SQL; `age` is added to the ages of the scrapes."""
    usd = f"CASE WHEN (SELECT MIN(scrape_age_days) + {age} >= 3 FROM pod_costs) THEN {{}} END".format
    step_usd = usd("CASE WHEN COUNT(on_demand) = COUNT(*) THEN SUM(on_demand) END")
    names = [f"{m}_{s}" for m in ("operated", "on_demand") for s in ("full", "1k", "1k_per_run")]
    shares = ", ".join(
        f"COALESCE(o.{m}, 0) + COALESCE(h.{m}, 0) AS {m}_full, COALESCE(o.{m}, 0) + COALESCE(h.{m}, 0) / k AS {m}_1k" for m in ("operated", "on_demand")
    )
    gate = "CASE WHEN COALESCE(o.no_{m}, FALSE) OR COALESCE(h.no_{m}, FALSE) THEN NULL ELSE 1 END AS ok_{m}"
    spent = ", ".join(f"SUM({m}) AS {m}, COUNT({m}) < COUNT(*) AS no_{m}" for m in ("operated", "on_demand"))

    def measure(name: str) -> str:
        m = "operated" if name.startswith("operated") else "on_demand"
        return f"{m}_1k * ok_{m} / NULLIF(n_runs, 0)" if name.endswith("per_run") else f"{name} * ok_{m}"

    long = " UNION ALL ".join(f"SELECT '{n}' AS item, {measure(n)} AS x FROM shares" for n in names)
    return (
        _PRICED
        + f""",
    z AS (SELECT *, l_pod AS pod2, node_h * node_ondemand_usd_per_hour + pv_cost_usd + network_cost_usd AS ondemand_usd,
                 CASE WHEN session % 2 = 0 THEN CAST(session AS VARCHAR) ELSE '' END AS ses, CASE step WHEN 'R' THEN 'globus-transfer' ELSE step END AS stp,
                 CASE WHEN node_effective_usd_per_hour > 0 AND node_ondemand_usd_per_hour IS NOT NULL THEN TRUE ELSE FALSE END AS rated
          FROM (SELECT *, workflow_name || '/' || session || '/' || step AS l_pod FROM q)),
    pods AS (SELECT workflow_name, pod2, MIN(stp) AS step, MIN(subject) AS subject, MIN(ses) AS session, BOOL_OR(gpu_hours > 0) AS gpu, SUM(runtime_minutes) AS minutes,
                    SUM(total_cost_usd) AS operated, CASE WHEN COUNT(ondemand_usd) = COUNT(*) THEN SUM(ondemand_usd) END AS on_demand, MIN(problem) AS problem, COUNT(*) AS n,
                    COUNT(node_effective_usd_per_hour) < COUNT(*) AS carried, SUM(total_cost_usd) FILTER (rated) AS cov,
                    SUM((cpu_cost_usd + memory_cost_usd + gpu_cost_usd) * (node_ondemand_usd_per_hour / node_effective_usd_per_hour) + pv_cost_usd + network_cost_usd) FILTER (rated) AS lst
             FROM z GROUP BY ALL),
    spent AS (SELECT subject, session, {spent} FROM pods WHERE step <> 'globus-transfer' GROUP BY ALL),
    given AS (SELECT subject, unnest(['2', '4', '8']) AS session, n_runs FROM (SELECT o_custkey AS subject, COUNT(*) AS n_runs FROM orders WHERE o_custkey % 3 > 0 AND o_custkey IN (SELECT subject FROM spent) GROUP BY o_custkey)),
    units AS (SELECT * FROM given UNION ALL SELECT subject, session, 0 FROM spent WHERE session <> '' AND subject NOT IN (SELECT subject FROM given)),
    shares AS (SELECT u.subject, u.session, n_runs, {shares}, {gate.format(m="operated")}, {gate.format(m="on_demand")}
               FROM (SELECT *, COUNT(*) OVER (PARTITION BY subject) AS k FROM units) u LEFT JOIN (SELECT * FROM spent WHERE session <> '') o USING (subject, session)
               LEFT JOIN (SELECT * FROM spent WHERE session = '') h ON h.subject = u.subject),
    long AS ({long}),
    flat AS (
        SELECT 'scope' AS section, '' AS item, unnest(['n_workflows', 'n_pod_rows', 'settled']) AS measure, unnest([COUNT(DISTINCT workflow_name), SUM(n), {usd("1")[:-3]} ELSE 0 END]) AS value FROM pods
        UNION ALL SELECT 'coverage', '', unnest(['pods', 'priced_at_list', 'unpriced', 'carried_instance_no_effective_rate']), unnest([COUNT(*), COUNT(on_demand), COUNT(*) - COUNT(on_demand), COUNT(*) FILTER (carried)]) FROM pods
        UNION ALL SELECT 'coverage', COALESCE(problem, 'unknown'), 'unpriced', COUNT(*) FROM pods WHERE on_demand IS NULL GROUP BY problem
        UNION ALL SELECT 'spot_savings', '', unnest(['operated_usd_covered', 'on_demand_usd_covered', 'multiple', 'coverage_frac']),
                         unnest([{usd("SUM(cov)")}, {usd("SUM(lst)")}, {usd("SUM(lst) / SUM(cov)")}, {usd("SUM(cov) / SUM(operated)")}]) FROM pods
        UNION ALL SELECT 'ingress', '', unnest(['operated_usd', 'runtime_min_total']), unnest([{usd("SUM(operated) FILTER (step = 'globus-transfer')")}, SUM(minutes) FILTER (step = 'globus-transfer')]) FROM pods
        UNION ALL SELECT 'total', '', unnest(['operated_usd', 'on_demand_usd_priced']), unnest([{usd("SUM(operated)")}, {usd("SUM(on_demand)")}]) FROM pods
        UNION ALL SELECT 'per_step', step, unnest(['n_pods', 'gpu', 'ingress', 'runtime_min_total', 'operated_usd', 'on_demand_usd', 'runtime_min_p50', 'runtime_min_p95']),
                         unnest([COUNT(*), CAST(BOOL_OR(gpu) AS INTEGER), CAST(step = 'globus-transfer' AS INTEGER), SUM(minutes), {usd("SUM(operated)")}, {step_usd}, QUANTILE_CONT(minutes, 0.5), QUANTILE_CONT(minutes, 0.95)]) FROM pods GROUP BY step
        UNION ALL SELECT 'per_session', '', 'n_sessions', COUNT(*) FROM shares
        UNION ALL SELECT 'per_session', item, unnest(['median', 'p5', 'p95', 'n']), unnest([{usd("QUANTILE_CONT(x, 0.5)")}, {usd("QUANTILE_CONT(x, 0.05)")}, {usd("QUANTILE_CONT(x, 0.95)")}, COUNT(x)]) FROM long GROUP BY item
        UNION ALL SELECT 'workflow_wall_clock_h', '', unnest(['n', 'p50', 'p95', 'max']),
                         unnest([COUNT(total_duration_s), QUANTILE_CONT(total_duration_s / 3600.0, 0.5), QUANTILE_CONT(total_duration_s / 3600.0, 0.95), MAX(total_duration_s / 3600.0)]) FROM workflow_runs)
    SELECT section, item, measure, ROUND(CAST(value AS DOUBLE), 4) AS value FROM flat"""
    )


def _audit(t, age: int):
    """Pods of line items: one per workflow, session and step, so some have several cost rows; odd sessions are shared work."""
    even = F.col("session") % 2 == 0
    rows = _priced_rows(t).withColumns({
        "pod": F.concat_ws("/", "workflow_name", "session", "step"),
        "session": F.when(even, F.col("session").cast("string")).otherwise(""),
        "step": F.when(F.col("step") == "R", "globus-transfer").otherwise(F.col("step")),
        "node_instance_id": F.col("node_instance_type"),
        "scrape_age_days": F.col("scrape_age_days") + age,
    })
    names = F.explode(F.array(*map(F.lit, "248"))).alias("session")
    sessions = t.orders.filter(F.col("o_custkey") % 3 > 0).groupBy(F.col("o_custkey").alias("subject")).agg(F.count(F.lit(1)).alias("n_runs")).select("subject", names, "n_runs")
    return rounded(AR.audit_report(rows, sessions, t.workflow_runs), 4)


@query("a13_audit_report", _audit_sql(3))
def settled_audit(t):
    return _audit(t, 3)


@query("a13_audit_report_refused", _audit_sql(0))
def refused_audit(t):
    """Some rows are not settled: performance is reported, no dollar figure is."""
    return _audit(t, 0)


_RECONSTRUCTION = """
    WITH base AS (SELECT *, 'w' || (l_orderkey % 3000) AS workflow_name, epoch_us(l_shipdate) + l_linenumber * 10800000000 AS start_us FROM lineitem),
    pods AS (SELECT workflow_name, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || start_us AS pod, start_us,
                    CASE WHEN l_returnflag <> 'R' OR l_linenumber < 7 THEN start_us + CAST(l_quantity AS BIGINT) * 3600000000 END AS end_us,
                    CASE WHEN l_linenumber % 2 = 0 THEN 'p' || l_partkey END AS subject, CASE WHEN l_suppkey % 10 > 0 THEN 'type' || (l_suppkey % 7) END AS kind,
                    l_quantity * 3600 * (1 + l_discount) AS rd_cpu, l_extendedprice AS rd_mem, CASE WHEN l_linenumber = 1 THEN l_quantity * 60 ELSE 0 END AS rd_gpu FROM base),
    billed AS (SELECT workflow_name, start_us // 86400000000 * 86400000000 AS day_us, CASE WHEN l_suppkey % 10 > 0 THEN 'type' || (l_suppkey % 5) ELSE '' END AS kind,
                      l_quantity * (1 + l_tax) AS cpu_h, l_extendedprice / 36000 * (1 + l_tax) AS mem_h, CASE WHEN l_linenumber = 1 THEN l_quantity / 60 * (1 + l_tax) ELSE 0 END AS gpu_h,
                      l_quantity * (1 + l_tax) * (0.03 + l_suppkey * 0.0001) AS cpu_usd, l_extendedprice * 0.0001 AS mem_usd, CASE WHEN l_linenumber = 1 THEN l_quantity * 0.02 ELSE 0 END AS gpu_usd
               FROM base WHERE l_linestatus = 'F'),
    ended AS (SELECT *, COALESCE(end_us, start_us // 86400000000 * 86400000000 + 86400000000) AS until FROM pods),
    cut AS (SELECT *, unnest(range(start_us // 86400000000, GREATEST(start_us // 86400000000, (until - 1) // 86400000000) + 1)) * 86400000000 AS day_us FROM ended),
    days AS (SELECT *, CASE WHEN until > start_us THEN (LEAST(until, day_us + 86400000000) - GREATEST(start_us, day_us)) / (until - start_us) ELSE 1.0 END AS fraction,
                    (LEAST(until, day_us + 86400000000) - GREATEST(start_us, day_us)) / 60000000 AS minutes FROM cut),
    asked AS (SELECT day_us, workflow_name, SUM(rd_cpu * fraction) AS s_cpu, SUM(rd_mem * fraction) AS s_mem, SUM(rd_gpu * fraction) AS s_gpu FROM days GROUP BY ALL),
    paid AS (SELECT day_us, workflow_name, SUM(cpu_h) AS h_cpu, SUM(mem_h) AS h_mem, SUM(gpu_h) AS h_gpu FROM billed GROUP BY ALL),
    ratio AS (SELECT COALESCE(NULLIF(QUANTILE_CONT(h_cpu / (s_cpu / 3600), 0.5) FILTER (s_cpu > 3600 AND h_cpu > 1), 0), 1.0) AS cpu,
                     COALESCE(NULLIF(QUANTILE_CONT(h_mem / (s_mem / 3600), 0.5) FILTER (s_mem > 3600 AND h_mem > 1), 0), 0.0958) AS mem,
                     COALESCE(NULLIF(QUANTILE_CONT(h_gpu / (s_gpu / 3600), 0.5) FILTER (s_gpu > 60 AND h_gpu > 0.1), 0), 1.0) AS gpu FROM asked JOIN paid USING (day_us, workflow_name)),
    rates AS (SELECT kind, COALESCE(SUM(cpu_usd) / NULLIF(SUM(cpu_h), 0), 0) AS cpu, COALESCE(SUM(mem_usd) / NULLIF(SUM(mem_h), 0), 0) AS mem, COALESCE(SUM(gpu_usd) / NULLIF(SUM(gpu_h), 0), 0) AS gpu FROM billed GROUP BY kind),
    pooled AS (SELECT COALESCE(SUM(cpu_usd) / NULLIF(SUM(cpu_h), 0), 0) AS cpu, COALESCE(SUM(mem_usd) / NULLIF(SUM(mem_h), 0), 0) AS mem, COALESCE(SUM(gpu_usd) / NULLIF(SUM(gpu_h), 0), 0) AS gpu FROM billed)"""


def _clean_days(t):
    """(pods by day, billed rows): line items as pods whose requests are known, half of them billed."""
    number, quantity = F.col("l_linenumber"), F.col("l_quantity")
    base = t.lineitem.withColumn("workflow_name", F.concat(F.lit("w"), F.col("l_orderkey") % 3000))
    base = base.withColumn("start_us", micros("l_shipdate") + number * 10_800_000_000)

    def kind(n: int):
        return F.when(F.col("l_suppkey") % 10 > 0, F.concat(F.lit("type"), F.col("l_suppkey") % n)).alias("kind")

    first = number == 1
    pods = base.select(
        "workflow_name", F.concat_ws("-", "l_orderkey", number, "l_partkey", "l_suppkey", "start_us").alias("pod"), "start_us",
        F.when((F.col("l_returnflag") != "R") | (number < 7), F.col("start_us") + quantity.cast("long") * 3_600_000_000).alias("end_us"),
        F.when(number % 2 == 0, F.concat(F.lit("p"), "l_partkey")).alias("subject"), kind(7),
        (quantity * 3600 * (1 + F.col("l_discount"))).alias("rd_cpu"), F.col("l_extendedprice").alias("rd_mem"), F.when(first, quantity * 60).otherwise(0.0).alias("rd_gpu"),
    )
    more = 1 + F.col("l_tax")
    billed = base.filter("l_linestatus = 'F'").select(
        "workflow_name", (F.floor(F.col("start_us") / DAY_US) * DAY_US).alias("day_us"), kind(5),
        (quantity * more).alias("cpu_core_hours"), (F.col("l_extendedprice") / 36000 * more).alias("ram_gb_hours"), F.when(first, quantity / 60 * more).otherwise(0.0).alias("gpu_hours"),
        (quantity * more * (0.03 + F.col("l_suppkey") * 0.0001)).alias("cpu_cost_usd"), (F.col("l_extendedprice") * 0.0001).alias("memory_cost_usd"),
        F.when(first, quantity * 0.02).otherwise(0.0).alias("gpu_cost_usd"),
    )
    return RC.pod_days(pods, "start_us", "end_us"), billed


@query(
    "a14_rate_calibration",
    _RECONSTRUCTION
    + """
    SELECT 'ratio' AS what, NULL AS kind, ROUND(cpu, 8) AS cpu, ROUND(mem, 8) AS mem, ROUND(gpu, 8) AS gpu FROM ratio
    UNION ALL SELECT 'rate', kind, ROUND(cpu, 8), ROUND(mem, 8), ROUND(gpu, 8) FROM rates UNION ALL SELECT 'pooled', NULL, ROUND(cpu, 8), ROUND(mem, 8), ROUND(gpu, 8) FROM pooled""",
)
def rate_calibration(t):
    """Hours per requested hour, dollars per hour and instance type, and the pooled fallback, for three components."""
    days, billed = _clean_days(t)
    sums = RC.type_sums(billed, "kind")
    nobody = F.lit(None).cast("string").alias("kind")
    ratios = RC.unit_ratios(days, billed, ["day_us", "workflow_name"]).select(F.lit("ratio").alias("what"), nobody, "cpu", "mem", "gpu")
    rates = RC.type_rates(sums, "kind").select(F.lit("rate").alias("what"), "kind", "cpu", "mem", "gpu")
    pooled = RC.pooled_rates(sums).select(F.lit("pooled").alias("what"), nobody, "cpu", "mem", "gpu")
    return rounded(ratios.unionByName(rates).unionByName(pooled), 8)


@query(
    "a15_cost_reconstruction",
    _RECONSTRUCTION
    + """,
    runs AS (SELECT 'w' || (o_orderkey % 3000) AS workflow_name, o_orderkey AS run, 'c' || o_custkey AS subject, epoch_us(o_orderdate) AS s, CASE WHEN o_orderstatus <> 'P' THEN epoch_us(o_orderdate) + 5 * 86400000000 END AS e FROM orders),
    seen AS (SELECT DISTINCT workflow_name, pod, start_us AS at_us FROM pods),
    hits AS (SELECT pod, COUNT(*) FILTER (at_us >= s - 120000000 AND (e IS NULL OR at_us <= e + 120000000)) AS n_hits, MAX(run) FILTER (at_us >= s - 120000000 AND (e IS NULL OR at_us <= e + 120000000)) AS hit,
                    arg_max(run, s * 1000000::HUGEINT + run) FILTER (s <= at_us) AS earlier FROM seen JOIN runs USING (workflow_name) GROUP BY pod),
    placed AS (SELECT pod, CASE WHEN n_hits = 1 THEN hit WHEN n_hits = 0 THEN earlier END AS run FROM hits),
    priced AS (SELECT d.*, COALESCE(runs.subject, d.subject, '') AS who, rd_cpu / 3600 * ratio.cpu * fraction AS h_cpu, rd_mem / 3600 * ratio.mem * fraction AS h_mem, rd_gpu / 3600 * ratio.gpu * fraction AS h_gpu,
                      COALESCE(rates.cpu, pooled.cpu) AS p_cpu, COALESCE(rates.mem, pooled.mem) AS p_mem, COALESCE(rates.gpu, pooled.gpu) AS p_gpu
               FROM days d LEFT JOIN placed USING (pod) LEFT JOIN runs ON runs.run = placed.run LEFT JOIN rates ON rates.kind = COALESCE(d.kind, '') CROSS JOIN ratio CROSS JOIN pooled),
    scraped AS (SELECT epoch_us(o_orderdate) AS day_us, 'w' || (o_orderkey % 3000) AS workflow_name, SUM(o_totalprice) AS usd FROM orders GROUP BY ALL)
    SELECT day_us, workflow_name, who AS subject, COUNT(*) AS pods, ROUND(SUM(minutes), 4) AS pod_minutes, ROUND(SUM(h_cpu), 4) AS cpu_core_hours, ROUND(SUM(h_mem), 4) AS ram_gb_hours, ROUND(SUM(h_gpu), 4) AS gpu_hours,
           ROUND(SUM(h_cpu * p_cpu), 6) AS cpu_cost_usd, ROUND(SUM(h_mem * p_mem), 6) AS memory_cost_usd, ROUND(SUM(h_gpu * p_gpu), 6) AS gpu_cost_usd, COUNT(*) FILTER (kind IS NULL) AS pods_without_instance_type,
           ROUND(SUM(h_cpu * p_cpu) + SUM(h_mem * p_mem) + SUM(h_gpu * p_gpu), 6) AS total_cost_usd, ROUND(MAX(usd), 4) AS scraped_total_cost_usd
    FROM priced LEFT JOIN scraped USING (day_us, workflow_name) GROUP BY day_us, workflow_name, who""",
)
def cost_reconstruction(t):
    """Orders as the runs of reused workflow names: some pods are in one run's window, some in several, some in none."""
    days, billed = _clean_days(t)
    name = F.concat(F.lit("w"), F.col("o_orderkey") % 3000).alias("workflow_name")
    start = micros("o_orderdate")
    runs = t.orders.select(
        name, F.col("o_orderkey").alias("run"), F.concat(F.lit("c"), "o_custkey").alias("subject"), start.alias("start_us"),
        F.when(F.col("o_orderstatus") != "P", start + 5 * DAY_US).alias("end_us"),
    )
    scraped = t.orders.select(start.alias("day_us"), name, "o_totalprice").groupBy("day_us", "workflow_name").agg(F.sum("o_totalprice").alias("usd"))
    ratios = RC.unit_ratios(days, billed, ["day_us", "workflow_name"])
    out = RC.reconstruct_costs(days, runs, ratios, RC.type_sums(billed, "kind"), "kind", scraped)
    dollars = {c: 6 for c in ("cpu_cost_usd", "memory_cost_usd", "gpu_cost_usd", "total_cost_usd")}
    return rounded(out, 4, **dollars)


@query(
    "a16_hourly_to_day",
    """
    WITH h AS (SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS workflow_name,
                      epoch_us(date_trunc('hour', ts)) AS hour, NULLIF(user_id, 0) AS subject, value AS v FROM events)
    SELECT date, workflow_name,
           arg_min(subject, (hour * 1000000::HUGEINT + subject)) FILTER (subject IS NOT NULL) AS subject,
           ROUND(SUM(v * 0.5), 4) AS cpu_cost_usd, ROUND(SUM(v * 0.25), 4) AS memory_cost_usd,
           ROUND(SUM(v * 0.2), 4) AS gpu_cost_usd, COUNT(DISTINCT hour) AS n_hours, 0.0 AS total_adjustment_usd,
           ROUND(SUM(v * 0.5) + SUM(v * 0.25) + SUM(v * 0.2), 4) AS total_cost_usd
    FROM h GROUP BY date, workflow_name""",
)
def hourly_to_day(t):
    hours = t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("event_type").alias("workflow_name"),
        micros(F.date_trunc("hour", F.col("ts"))).alias("hour"),
        F.when(F.col("user_id") != 0, F.col("user_id")).alias("subject"),
        (F.col("value") * 0.5).alias("cpu_cost_usd"),
        (F.col("value") * 0.25).alias("memory_cost_usd"),
        (F.col("value") * 0.2).alias("gpu_cost_usd"),
    )
    return rounded(C.hourly_to_day(hours, ["date", "workflow_name"]), 4)


@query(
    "a16_missing_hours",
    """
    SELECT epoch_us(h) AS hour FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00', INTERVAL 1 HOUR)) AS h)
    WHERE h NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error')""",
)
def missing_hours(t):
    seen = t.events.filter(F.col("event_type") == "error").select(
        micros(F.date_trunc("hour", F.col("ts"))).alias("hour")
    )
    return C.missing_hours(t.spark, seen, "hour", 1704067200000000, 1706745600000000)


@query(
    "a34_drift_table",
    """
    WITH g AS (SELECT date, SUM(CASE WHEN scrape_age_days = 0 THEN total_cost_usd END) AS c0,
                      SUM(CASE WHEN scrape_age_days = 1 THEN total_cost_usd END) AS c1,
                      SUM(CASE WHEN scrape_age_days = 2 THEN total_cost_usd END) AS c2,
                      SUM(CASE WHEN scrape_age_days = 3 THEN total_cost_usd END) AS c3 FROM costs GROUP BY date)
    SELECT date, ROUND(c0, 4) AS cost_age_0, ROUND(c1, 4) AS cost_age_1, ROUND(c2, 4) AS cost_age_2,
           ROUND(c3, 4) AS cost_age_3, ROUND(CASE WHEN c3 > 0 THEN (c1 / c3 - 1) * 100 END, 4) AS overstatement_pct
    FROM g""",
)
def drift_table(t):
    return rounded(C.drift_by_age(t.costs), 4)


@query(
    "a34_median_overstatement",
    """
    WITH g AS (SELECT date, SUM(CASE WHEN scrape_age_days = 1 THEN total_cost_usd END) AS c1,
                      SUM(CASE WHEN scrape_age_days = 3 THEN total_cost_usd END) AS c3 FROM costs GROUP BY date)
    SELECT ROUND(quantile_cont((c1 / c3 - 1) * 100, 0.5) FILTER (c3 > 0 AND c1 IS NOT NULL), 4) AS median_overstatement_pct FROM g""",
)
def median_overstatement(t):
    return rounded(C.median_overstatement(C.drift_by_age(t.costs)), 4)


@query(
    "a35_partial_read_guard",
    """
    WITH n AS (SELECT COUNT(DISTINCT workflow_name) AS n_new FROM costs),
    s AS (SELECT COUNT(DISTINCT workflow_name) AS n_stored FROM pod_costs)
    SELECT n_new, n_stored, n_new < n_stored * 0.5 AS refuse FROM n, s""",
)
def partial_read_guard(t):
    return C.partial_read_guard(t.costs, t.pod_costs, "workflow_name")


@query(
    "j19_carry_proven_attributes",
    """
    WITH n AS (SELECT l_orderkey, l_linenumber, MAX(CASE WHEN l_quantity > 10 THEN l_suppkey END) AS instance,
                      MAX(l_tax) AS rate FROM lineitem GROUP BY ALL),
    s AS (SELECT l_orderkey, l_linenumber, MAX(CASE WHEN l_discount > 0.03 THEN l_suppkey END) AS instance
          FROM lineitem GROUP BY ALL HAVING MAX(CASE WHEN l_discount > 0.03 THEN l_suppkey END) IS NOT NULL)
    SELECT l_orderkey, l_linenumber,
           CASE WHEN s.instance IS NULL OR n.instance = s.instance THEN n.instance ELSE s.instance END AS instance,
           CASE WHEN n.instance IS NOT NULL AND (s.instance IS NULL OR n.instance = s.instance) THEN n.rate END AS rate
    FROM n LEFT JOIN s USING (l_orderkey, l_linenumber)""",
)
def carry_proven(t):
    keys = ["l_orderkey", "l_linenumber"]
    new = t.lineitem.groupBy(*keys).agg(
        F.max(F.when(F.col("l_quantity") > 10, F.col("l_suppkey"))).alias("instance"), F.max("l_tax").alias("rate")
    )
    stored = t.lineitem.groupBy(*keys).agg(
        F.max(F.when(F.col("l_discount") > 0.03, F.col("l_suppkey"))).alias("instance")
    )
    return C.carry_proven(new, stored, keys, ["instance"], "rate")


@query(
    "j15_unbilled_activity",
    """
    WITH a AS (SELECT workflow_name, SUM(runtime_minutes) AS cpu_hours, SUM(cpu_core_hours) AS gpu_hours
               FROM pod_costs GROUP BY workflow_name)
    SELECT workflow_name, ROUND(cpu_hours, 4) AS cpu_hours, ROUND(gpu_hours, 4) AS gpu_hours FROM a
    WHERE cpu_hours + gpu_hours > 20
      AND workflow_name NOT IN (SELECT workflow_name FROM costs WHERE pipeline <> '1-URGENT')""",
)
def unbilled_activity(t):
    active = t.pod_costs.select(
        "workflow_name", F.col("runtime_minutes").alias("cpu_hours"), F.col("cpu_core_hours").alias("gpu_hours")
    )
    billed = t.costs.filter(F.col("pipeline") != "1-URGENT")
    return rounded(C.unbilled_activity(active, billed, ["workflow_name"], 20.0), 4)


@query(
    "j15_capture_by_day",
    """
    WITH a AS (SELECT date, SUM(runtime_minutes) AS o, SUM(CASE WHEN step <> 'R' THEN runtime_minutes END) AS b
               FROM pod_costs GROUP BY date)
    SELECT date, ROUND(o, 4) AS observed_hours, ROUND(COALESCE(b, 0.0), 4) AS billed_hours,
           ROUND(CASE WHEN o > 0 THEN COALESCE(b, 0.0) / o ELSE 1.0 END, 6) AS capture,
           CASE WHEN o > 0 THEN COALESCE(b, 0.0) / o ELSE 1.0 END < 0.5 AS shortfall FROM a""",
)
def capture_by_day(t):
    usage = t.pod_costs.select("date", "step", F.col("runtime_minutes").alias("cpu_hours"))
    return rounded(C.capture_by_day(usage, usage.filter(F.col("step") != "R"), minimum=0.5), 6)


@query(
    "j16_orphan_pod_costs",
    """
    SELECT date, workflow_name, COUNT(*) AS n_pods, ROUND(SUM(total_cost_usd), 4) AS usd FROM pod_costs p
    WHERE NOT EXISTS (SELECT 1 FROM costs c WHERE c.workflow_name = p.workflow_name AND c.date = p.date)
    GROUP BY date, workflow_name""",
)
def orphan_pod_costs(t):
    return rounded(C.orphan_workflows(t.pod_costs, t.costs), 4)


@query(
    "a33_cost_coverage",
    """
    WITH d AS (SELECT strftime(unnest(generate_series(DATE '1997-01-01', DATE '1997-12-31', INTERVAL 1 DAY)), '%Y-%m-%d') AS date),
    c AS (SELECT date, COUNT(*) AS n, COUNT(*) FILTER (scrape_age_days < 3) AS p FROM costs GROUP BY date)
    SELECT date, COALESCE(n, 0) AS n_rows, COALESCE(p, 0) AS n_provisional, COALESCE(n, 0) = 0 AS missing
    FROM d LEFT JOIN c USING (date)""",
)
def cost_coverage(t):
    return C.cost_coverage(t.costs, "1997-01-01", "1997-12-31")


_CLAIMS = """
    WITH claims AS (SELECT workflow_name, date, subject, 0.75 AS share FROM costs WHERE pipeline < '4'
              UNION ALL SELECT workflow_name, date, subject + 1000000, 0.25 FROM costs WHERE pipeline < '2'
              UNION ALL SELECT workflow_name, date, subject, 0.25 FROM costs WHERE pipeline >= '2' AND pipeline < '4')"""


def _claims(t):
    c = t.costs.select("workflow_name", "date", "subject", "pipeline")
    keys = ["workflow_name", "date", "subject", "share"]
    early = c.filter(F.col("pipeline") < "2")
    late = c.filter((F.col("pipeline") >= "2") & (F.col("pipeline") < "4"))
    return (
        c.filter(F.col("pipeline") < "4").withColumn("share", F.lit(0.75)).select(*keys)
        .unionByName(early.withColumn("subject", F.col("subject") + 1000000).withColumn("share", F.lit(0.25)).select(*keys))
        .unionByName(late.withColumn("share", F.lit(0.25)).select(*keys))
    )


@query(
    "j12_shared_cost_claims",
    _CLAIMS
    + """
    SELECT c.workflow_name, c.date, k.subject, ROUND(c.total_cost_usd * share, 6) AS total_cost_usd,
           ROUND(c.cpu_cost_usd * share, 6) AS cpu_cost_usd
    FROM costs c JOIN claims k USING (workflow_name, date)""",
)
def shared_cost_claims(t):
    out = C.scope_to_claims(t.costs, _claims(t))
    return rounded(out.select("workflow_name", "date", "subject", "total_cost_usd", "cpu_cost_usd"), 6)


@query(
    "j12_unclaimed_costs",
    _CLAIMS
    + """
    SELECT COUNT(*) AS rows_dropped, ROUND(COALESCE(SUM(total_cost_usd), 0), 4) AS usd_dropped FROM costs c
    WHERE NOT EXISTS (SELECT 1 FROM claims k WHERE k.workflow_name = c.workflow_name AND k.date = c.date)""",
)
def unclaimed_costs(t):
    return rounded(C.unclaimed_costs(t.costs, _claims(t)), 4)


@query(
    "a43_subtract_foreign_pods",
    """
    WITH w AS (SELECT workflow_name, date AS first_date, strftime(CAST(date AS DATE) + 600, '%Y-%m-%d') AS last_date
               FROM costs),
    day AS (SELECT workflow_name, date, SUM(total_cost_usd) AS total, SUM(cpu_cost_usd) AS cpu FROM pod_costs GROUP BY ALL),
    f AS (SELECT p.workflow_name, p.date, SUM(p.total_cost_usd) AS total, SUM(p.cpu_cost_usd) AS cpu, COUNT(*) AS n
          FROM pod_costs p WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.workflow_name = p.workflow_name
                                             AND p.date BETWEEN first_date AND last_date) GROUP BY ALL)
    SELECT workflow_name, date, ROUND(day.total - COALESCE(f.total, 0), 4) AS total_cost_usd,
           ROUND(day.cpu - COALESCE(f.cpu, 0), 4) AS cpu_cost_usd, COALESCE(n, 0) AS pods_removed
    FROM day LEFT JOIN f USING (workflow_name, date)""",
)
def subtract_foreign_pods(t):
    pods = t.pod_costs
    windows = t.costs.select(
        "workflow_name",
        F.col("date").alias("first_date"),
        F.date_format(F.date_add(F.to_date("date"), 600), "yyyy-MM-dd").alias("last_date"),
    )
    per_day = pods.groupBy("workflow_name", "date").agg(*[F.sum(c).alias(c) for c in C.MONEY])
    out = C.subtract_foreign(per_day, pods, windows, 4)
    return out.select("workflow_name", "date", "total_cost_usd", "cpu_cost_usd", "pods_removed")


@query(
    "a46_reused_hosts",
    """
    WITH r AS (SELECT l_partkey, TRUE AS hit FROM lineitem WHERE l_linenumber = 1 GROUP BY l_partkey HAVING COUNT(DISTINCT l_suppkey) > 1)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN hit IS NULL THEN l_tax END AS l_tax,
           hit IS NOT NULL AS host_reused, l_quantity
    FROM lineitem l LEFT JOIN r USING (l_partkey)""",
)
def reused_hosts(t):
    pods = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", "l_quantity")
    nodes = t.lineitem.filter(F.col("l_linenumber") == 1)
    return C.null_reused_rates(pods, nodes, "l_partkey", "l_suppkey", ["l_tax"])


@query(
    "a37_effective_node_rate",
    """
    WITH n AS (SELECT l_suppkey, l_linestatus, SUM(l_extendedprice) AS total_cost,
                      SUM(CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE l_quantity END) AS minutes,
                      MAX(CASE WHEN l_suppkey % 3 = 0 THEN 'reserved' ELSE '' END) AS lab,
                      MAX(CASE WHEN l_suppkey % 3 = 1 THEN l_suppkey % 2 END) AS pre
               FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, l_linestatus, CASE WHEN minutes > 0 THEN ROUND(total_cost / (minutes / 60.0), 4) END AS effective_usd_per_hour,
           CASE WHEN lab <> '' THEN lab WHEN pre IS NULL THEN '' WHEN pre > 0 THEN 'spot' ELSE 'on-demand' END AS capacity_type
    FROM n""",
)
def effective_node_rate(t):
    supp = F.col("l_suppkey")
    nodes = t.lineitem.groupBy("l_suppkey", "l_linestatus").agg(
        F.sum("l_extendedprice").alias("total_cost"),
        F.sum(F.when(supp % 10 == 0, 0.0).otherwise(F.col("l_quantity"))).alias("minutes"),
        F.max(F.when(supp % 3 == 0, "reserved").otherwise("")).alias("capacity_label"),
        F.max(F.when(supp % 3 == 1, supp % 2)).alias("preemptible"),
    )
    return rounded(C.effective_rates(nodes, ["l_suppkey", "l_linestatus"]), 4)


def _allocation_sets(t):
    """One JSON object per order date whose members are that day's workflows (built by Spark from the tables)."""
    member = F.struct(
        F.struct(
            F.create_map(F.lit("subjectid"), F.col("o_custkey").cast("string")).alias("labels")
        ).alias("properties"),
        F.col("o_totalprice").alias("totalCost"),
        (F.col("o_totalprice") * 0.5).alias("cpuCost"),
        (F.col("o_totalprice") * 0.25).alias("ramCost"),
        (F.col("o_totalprice") * 0.125).alias("cpuCostAdjustment"),
    )
    label = F.concat(F.when(F.col("o_orderstatus") == "P", "__").otherwise("wf-"), F.col("o_orderkey").cast("string"))
    return t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.to_json(F.create_map(label, member)).alias("body")
    )


_ALLOCATION_SQL = """
    WITH a AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, 'wf-' || o_orderkey AS workflow_name,
                      CAST(o_custkey AS VARCHAR) AS subject, ROUND(o_totalprice, 6) AS total_cost_usd,
                      ROUND(o_totalprice * 0.5, 6) AS cpu_cost_usd, ROUND(o_totalprice * 0.25, 6) AS memory_cost_usd,
                      0.0 AS gpu_cost_usd, ROUND(o_totalprice * 0.125, 6) AS total_adjustment_usd
               FROM orders WHERE o_orderstatus <> 'P')"""


@query("a36_allocation_parse", _ALLOCATION_SQL + " SELECT * FROM a")
def allocation_parse(t):
    return C.explode_allocations(_allocation_sets(t), "body", adjustments=["cpuCostAdjustment"])


def _pod_responses(t):
    """One response per ship date: a set of all pods of that day, of which some have no workflow, are reserved or not recorded."""
    n, supp, order = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_orderkey")
    pod = F.concat_ws("-", order, n, "l_partkey", supp)
    workflow = F.when(n == 6, F.lit(None)).when(order % 50 == 0, F.concat(F.lit("confounds-rerun-"), order)).otherwise(F.concat(F.lit("wf-"), order))
    kind = F.when(n == 3, "tx").when(n == 4, F.lit(None)).otherwise(F.concat(F.lit("t"), supp % 2))
    labels = F.struct(
        workflow.alias("workflows_argoproj_io_workflow"), F.col("l_returnflag").alias("cloudpipe_io_step"), F.col("l_linestatus").alias("cloudpipe_io_phase"),
        F.concat(F.lit("h"), supp).alias("kubernetes_io_hostname"), kind.alias("node_kubernetes_io_instance_type"), n.cast("string").alias("session"),
    )
    price = F.col("l_extendedprice")

    def iso(c):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    start = F.col("l_shipdate").cast("timestamp")
    value = F.struct(
        F.struct(pod.alias("pod"), labels.alias("labels")).alias("properties"), iso(start).alias("start"),
        iso(F.timestamp_micros(micros(start) + F.col("l_quantity").cast("long") * 3_600_000_000)).alias("end"), (F.col("l_quantity") * 60).alias("minutes"),
        price.alias("totalCost"), (price * 0.5).alias("cpuCost"), (price * 0.25).alias("ramCost"), F.when(n == 1, price * 0.2).alias("gpuCost"),
        (price * -0.01).alias("cpuCostAdjustment"), F.when(n != 2, price * 0.02).alias("pvCostAdjustment"), F.col("l_quantity").alias("cpuCoreHours"),
        (F.col("l_quantity") * 3 * 1024**3).alias("ramByteHours"), F.when(n != 7, F.col("l_discount")).alias("cpuEfficiency"), F.col("l_tax").alias("ramEfficiency"),
        (F.col("l_quantity") * 1e9).alias("ramByteRequestAverage"),
    )
    member = F.concat(F.when((n == 5) & (F.col("l_returnflag") == "R"), "__unallocated__").otherwise(""), pod)
    used = [f"l_{c}" for c in ("orderkey", "partkey", "suppkey", "linenumber", "quantity", "extendedprice", "discount", "tax", "returnflag", "linestatus", "shipdate")]
    # narrow rows are shuffled and sorted; texts are made and joined after that, one date at a time
    rows = t.lineitem.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), *used).repartition("date").sortWithinPartitions("date")
    texts = rows.select("date", member.alias("member"), F.to_json(F.create_map(member, value)).alias("text"))
    return texts.mapInArrow(allocation_sets, "date string, body string")


def _instances(t):
    """One or two instances per host name: apart in time, overlapping, or not known at all."""
    s, k = F.col("s_suppkey"), F.col("k")
    rows = t.supplier.filter(s % 11 != 5).select("s_suppkey", F.explode(F.sequence(F.lit(1), F.when(s % 3 == 0, 1).otherwise(2))).alias("k"))
    first, later = F.lit("1995-01-01").cast("timestamp"), F.lit("1998-01-01").cast("timestamp")
    until = F.when((k == 1) & (s % 3 == 1), later).otherwise(F.lit("2003-01-01").cast("timestamp"))
    return rows.select(
        F.concat(F.lit("h"), s).alias("node"), F.concat_ws("-", F.lit("i"), s, k).alias("instance_id"), F.concat(F.lit("t"), (s + k + 1) % 2).alias("instance_type"),
        F.when(s % 7 == 0, "t9").otherwise("").alias("labelled_type"), micros(F.when(k == 1, first).otherwise(later)).alias("start_us"), micros(until).alias("end_us"),
        F.when(k == 1, "spot").otherwise("on-demand").alias("capacity_type"), (s * 0.01 + k).alias("effective_usd_per_hour"), (s * 0.02 + k).alias("ondemand_usd_per_hour"),
    )


def _proven_pods(t):
    n = F.col("l_linenumber")
    stored = t.lineitem.filter(n.isin(2, 3)).select(
        F.concat(F.lit("wf-"), "l_orderkey").alias("workflow_name"), F.concat_ws("-", "l_orderkey", n, "l_partkey", "l_suppkey").alias("pod"),
        F.concat(F.lit("i-"), "l_suppkey", F.lit("-1")).alias("node_instance_id"), F.lit("stored").alias("node_instance_type"), F.lit("spot").alias("node_capacity_type"),
        F.lit(9.5).alias("node_ondemand_usd_per_hour"),
    )
    return AL.with_node_columns(AL.pod_allocations(_pod_responses(t), "body"), _instances(t), stored)


_PODS_SQL = """
    WITH base AS (SELECT *, strftime(l_shipdate, '%Y-%m-%d') AS date, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS pod, 'wf-' || l_orderkey AS workflow_name, 'h' || l_suppkey AS node,
                         CASE l_linenumber WHEN 3 THEN 'tx' WHEN 4 THEN '' ELSE 't' || (l_suppkey % 2) END AS kind, epoch_us(l_shipdate) AS s, epoch_us(l_shipdate) + CAST(l_quantity AS BIGINT) * 3600000000 AS e FROM lineitem),
    pods AS (SELECT * FROM base WHERE l_linenumber <> 6 AND l_orderkey % 50 <> 0 AND NOT (l_linenumber = 5 AND l_returnflag = 'R')),
    inst AS (SELECT 'h' || s_suppkey AS node, 'i-' || s_suppkey || '-' || k AS id, 't' || ((s_suppkey + k + 1) % 2) AS kind, CASE WHEN s_suppkey % 7 = 0 THEN 't9' ELSE '' END AS lab,
                    CASE k WHEN 1 THEN epoch_us(TIMESTAMP '1995-01-01') ELSE epoch_us(TIMESTAMP '1998-01-01') END AS s, CASE WHEN k = 1 AND s_suppkey % 3 = 1 THEN epoch_us(TIMESTAMP '1998-01-01') ELSE epoch_us(TIMESTAMP '2003-01-01') END AS e,
                    CASE k WHEN 1 THEN 'spot' ELSE 'on-demand' END AS capacity, s_suppkey * 0.01 + k AS eff, s_suppkey * 0.02 + k AS od
             FROM supplier, range(1, 3) r(k) WHERE s_suppkey % 11 <> 5 AND (k = 1 OR s_suppkey % 3 > 0)),
    hosts AS (SELECT a.node, COUNT(DISTINCT a.id) AS n, BOOL_OR(a.id < b.id AND b.s < a.e) AS clash FROM inst a JOIN inst b USING (node) GROUP BY a.node),
    cand AS (SELECT p.*, h.n, h.clash, list(i.id) FILTER (h.n = 1 OR (p.s >= i.s AND p.e <= i.e)) AS ids FROM pods p LEFT JOIN hosts h USING (node) LEFT JOIN inst i USING (node) GROUP BY ALL),
    pick AS (SELECT * EXCLUDE (ids, n, clash), CASE WHEN n IS NULL THEN 'NO_ASSET' WHEN n > 1 AND (clash OR len(ids) IS DISTINCT FROM 1) THEN 'AMBIGUOUS' ELSE 'FOUND' END AS how, ids[1] AS id FROM cand),
    proof AS (SELECT pick.*, i.kind AS ikind, i.capacity, i.eff, i.od,
                     CASE WHEN how <> 'FOUND' THEN how WHEN i.lab <> '' AND i.lab <> i.kind THEN 'INCONSISTENT_ASSET' WHEN pick.kind <> '' AND i.kind <> '' AND pick.kind <> i.kind THEN 'TYPE_MISMATCH' ELSE 'MATCHED' END AS why
              FROM pick LEFT JOIN inst i ON i.id = pick.id AND how = 'FOUND'),
    prior AS (SELECT workflow_name, pod, 'i-' || l_suppkey || '-1' AS pid, 'stored' AS pkind, 'spot' AS pcap, 9.5 AS prate FROM base WHERE l_linenumber IN (2, 3)),
    told AS (SELECT proof.*, pid, pkind, pcap, prate, why = 'MATCHED' AND (pid IS NULL OR pid = id) AS own, pid IS NOT NULL AS had FROM proof LEFT JOIN (SELECT DISTINCT * FROM prior) USING (workflow_name, pod)),
    fin AS (SELECT *, CASE WHEN own THEN id WHEN had THEN pid ELSE '' END AS node_instance_id, CASE WHEN own THEN COALESCE(NULLIF(kind, ''), ikind) WHEN had THEN pkind ELSE kind END AS node_instance_type,
                   CASE WHEN own THEN capacity WHEN had THEN pcap ELSE '' END AS node_capacity_type, CASE WHEN own THEN eff END AS node_effective_usd_per_hour, CASE WHEN own THEN od WHEN had THEN prate END AS node_ondemand_usd_per_hour,
                   CASE WHEN own OR NOT had THEN why ELSE 'CARRIED' END AS match_reason FROM told)"""


@query(
    "a36_pod_allocations",
    _PODS_SQL
    + """
    SELECT date, pod, workflow_name, l_returnflag AS step, l_linestatus AS phase, '' AS subject, CAST(l_linenumber AS VARCHAR) AS session, node, ROUND(l_extendedprice, 6) AS total_cost_usd, ROUND(l_extendedprice * 0.5, 6) AS cpu_cost_usd,
           ROUND(l_extendedprice * 0.25, 6) AS memory_cost_usd, ROUND(CASE WHEN l_linenumber = 1 THEN l_extendedprice * 0.2 ELSE 0 END, 6) AS gpu_cost_usd, 0.0 AS pv_cost_usd, 0.0 AS network_cost_usd,
           ROUND(l_extendedprice * -0.01 + CASE WHEN l_linenumber <> 2 THEN l_extendedprice * 0.02 ELSE 0 END, 4) AS total_adjustment_usd, l_quantity * 60 AS runtime_minutes, l_quantity AS cpu_core_hours, 0.0 AS gpu_hours,
           CASE WHEN l_linenumber = 7 THEN 0 ELSE l_discount END AS cpu_efficiency, l_tax AS ram_efficiency, l_quantity * 3 AS ram_gb_hours,
           node_instance_id, node_instance_type, node_capacity_type, ROUND(node_effective_usd_per_hour, 6) AS node_effective_usd_per_hour, ROUND(node_ondemand_usd_per_hour, 6) AS node_ondemand_usd_per_hour, match_reason FROM fin""",
)
def pod_allocations(t):
    """Every pod of every set with its node proven by its window, or carried over from the stored rows of some pods."""
    return rounded(_proven_pods(t).drop("start_us", "end_us"), 6, total_adjustment_usd=4)


@query(
    "a36_match_report",
    _PODS_SQL + " SELECT match_reason, COUNT(*) AS n_pods, ROUND(SUM(l_extendedprice), 4) AS usd, ROUND(SUM(CASE WHEN node_ondemand_usd_per_hour IS NULL THEN l_extendedprice ELSE 0 END), 4) AS unpriced_usd FROM fin GROUP BY match_reason",
)
def match_report(t):
    return rounded(AL.match_report(_proven_pods(t)), 4)


@query(
    "a44_allocation_harvest",
    """
    WITH m AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, l_extendedprice AS usd, l_quantity AS q, CASE WHEN l_linenumber <> 7 THEN l_discount END AS ce, l_tax AS re FROM lineitem)
    SELECT date, COUNT(*) AS n_members, ROUND(SUM(usd), 4) AS total_usd, ROUND(MIN(usd), 4) AS min_usd, ROUND(MAX(usd), 4) AS max_usd, ROUND(AVG(usd), 8) AS mean_usd, ROUND(SUM(usd * 0.5), 4) AS cpu_usd,
           ROUND(SUM(ce * q) / NULLIF(SUM(CASE WHEN ce IS NOT NULL THEN q END), 0), 12) AS cpu_efficiency, ROUND(SUM(q), 4) AS ram_request_gb, ROUND(SUM(re * q) / SUM(q), 12) AS ram_efficiency FROM m GROUP BY date""",
)
def allocation_harvest(t):
    """Scalar fields of every member written as CSV and read back, then cost and efficiency per day."""
    fields = ["start", "end", "minutes", "cpuCoreHours", "cpuCost", "cpuEfficiency", "ramByteHours", "ramByteRequestAverage", "ramCost", "ramEfficiency", "gpuCost", "totalCost"]
    rows = AL.harvest(_pod_responses(t), "body", "pod", fields)
    path = export_csv({"pods": rows}, scratch(t, "a44"))["pods"]
    back = t.spark.read.schema(rows.schema).csv(path, header=True)
    return rounded(AL.harvest_summary(back, ["date"]), 4, cpu_efficiency=12, ram_efficiency=12, mean_usd=8)


@query(
    "r5_settled_versions",
    """
    SELECT date, subject, workflow_name, scrape_age_days, total_cost_usd FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY date, subject ORDER BY scrape_age_days DESC, workflow_name DESC) AS rn
        FROM costs) WHERE rn = 1""",
)
def settled_versions(t):
    out = C.settled_versions(t.costs, ["date", "subject"], tie=["workflow_name"])
    return out.select("date", "subject", "workflow_name", "scrape_age_days", "total_cost_usd")


@query(
    "p15_excluded_workflows",
    """
    SELECT date, COUNT(*) AS n_kept FROM costs WHERE NOT (workflow_name LIKE '1%' OR workflow_name LIKE '99%')
    GROUP BY date""",
)
def excluded_workflows(t):
    kept = t.costs.filter(~C.excluded_workflow("workflow_name", ["1", "99"]))
    return kept.groupBy("date").agg(F.count(F.lit(1)).alias("n_kept"))
