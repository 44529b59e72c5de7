"""Cost reports: scope, rollups, distributions, list-price counterfactual, fan-out-safe attribution."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of, col, count_if, finite, first_day, last_day
from tidemark.operators.latest import latest
from tidemark.operators.quantiles import exact_quantiles, packed_key, with_quantiles
from tidemark.session import cut_lineage

#: Columns `list_price_savings` may be broken out by.
SAVINGS_GROUPS = ("step", "phase", "subject", "node_instance_type", "date")
#: Cost figures stop moving at this age of the scrape.
SETTLED_AGE_DAYS = 3


def cost_scope(
    df: DataFrame,
    subjects: Iterable | DataFrame | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    extra: Sequence[Column] = (),
    subject: str = "subject",
    date: str = "date",
    partition: str = "dt",
) -> DataFrame:
    """Subject list and inclusive date window. The window is applied to the partition column as well, where the
    table has one, so that only the named partitions are listed and read."""
    for cond in extra:
        df = df.filter(cond)
    days = [c for c in dict.fromkeys((date, partition)) if c in df.columns]
    for c in days:
        if date_from:
            df = df.filter(F.col(c) >= date_from)
        if date_to:
            df = df.filter(F.col(c) <= date_to)
    if subjects is None:
        return df
    if isinstance(subjects, DataFrame):
        return df.join(subjects.select(F.col(subjects.columns[0]).alias(subject)), subject, "left_semi")
    wanted = list(subjects)
    if not wanted:
        return df
    listed = df.sparkSession.createDataFrame([(s,) for s in wanted], df.select(subject).schema)
    return df.join(listed, subject, "left_semi")


def subject_costs(costs: DataFrame) -> DataFrame:
    """One row per subject over its workflow-day records."""
    return costs.groupBy("subject").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.countDistinct("workflow_name").alias("n_workflows"),
        *[
            F.sum(c).alias(c)
            for c in ("total_cost_usd", "cpu_cost_usd", "memory_cost_usd", "gpu_cost_usd", "total_adjustment_usd")
        ],
        F.max("scrape_age_days").alias("max_scrape_age_days"),
        first_day("date").alias("first_date"),
        last_day("date").alias("last_date"),
    )


def share_of_total(grouped: DataFrame, value: str, out: str, scale: float = 100.0) -> DataFrame:
    """Share of the grand total. The total is a scalar subquery, so the report keeps its partitions."""
    total = grouped.agg(F.sum(value)).scalar()
    return grouped.withColumn(out, F.col(value) * F.lit(scale) / total)


def step_costs(pods: DataFrame, keys: Sequence[str] = ("step", "phase")) -> DataFrame:
    """Where the money goes: one row per component with size, spread and request efficiency.

    Subjects are counted on their own narrow rows: counted beside the sums, every subject of every component would carry all the
    sums through a shuffle. The sums are kept for the grand total, so they are taken once."""
    keys = list(keys)
    component = packed_key(keys)
    subjects = pods.select(component.alias("_of"), "subject").distinct().groupBy("_of").agg(F.count("subject").alias("n_subjects"))
    grouped = pods.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pods"),
        F.sum("total_cost_usd").alias("total_cost_usd"),
        F.avg("total_cost_usd").alias("mean_cost_usd"),
        F.max("total_cost_usd").alias("max_cost_usd"),
        *[F.sum(c).alias(c) for c in ("cpu_cost_usd", "memory_cost_usd", "gpu_cost_usd", "pv_cost_usd")],
        F.avg("runtime_minutes").alias("mean_runtime_minutes"),
        F.avg("cpu_efficiency").alias("mean_cpu_efficiency"),
        F.avg("ram_efficiency").alias("mean_ram_efficiency"),
    )
    grouped = grouped.withColumn("_of", component).join(subjects, "_of").drop("_of")
    own = [*keys, "n_pods", "n_subjects"]
    grouped = cut_lineage(grouped.select(*own, *[c for c in grouped.columns if c not in own]))
    grouped = share_of_total(grouped, "total_cost_usd", "pct_of_total")
    return with_quantiles(
        grouped, pods, keys, "total_cost_usd", {"median_cost_usd": 0.5, "p95_cost_usd": 0.95}
    )


def list_price_savings(pods: DataFrame, group_by: str | None = None) -> DataFrame:
    """Actual cost against the same pods at list price.

    Compute is scaled by list over effective rate; volume and network pass through. A pod without both rates cannot
    be scaled and stays out of the counterfactual; `coverage_frac` says how much of the cost could be scaled, and is
    0.0 (never NULL) when none could, while the dollar columns are then NULL."""
    if group_by is not None and group_by not in SAVINGS_GROUPS:
        raise ValueError(f"group_by must be one of {sorted(SAVINGS_GROUPS)}, got {group_by!r}")
    effective, listed = F.col("node_effective_usd_per_hour"), F.col("node_ondemand_usd_per_hour")
    factor = F.when((effective > 0) & (listed > 0), listed / effective)
    compute = F.col("cpu_cost_usd") + F.col("memory_cost_usd") + F.col("gpu_cost_usd")
    at_list = compute * F.col("_factor") + F.col("pv_cost_usd") + F.col("network_cost_usd")
    priced = F.when(F.col("_factor").isNotNull(), F.col("total_cost_usd"))
    return (
        pods.withColumn("_factor", factor)
        .groupBy(*([group_by] if group_by else []))
        .agg(
            F.count(F.lit(1)).alias("n_pods"),
            F.sum("total_cost_usd").alias("actual_cost_usd"),
            F.sum(priced).alias("priced_cost_usd"),
            F.sum(at_list).alias("ondemand_cost_usd"),
            F.avg("_factor").alias("mean_multiplier"),
        )
        .withColumn("savings_usd", F.col("ondemand_cost_usd") - F.col("priced_cost_usd"))
        .withColumn(
            "coverage_frac",
            F.coalesce(F.col("priced_cost_usd"), F.lit(0.0))
            / F.when(F.col("actual_cost_usd") != 0, F.col("actual_cost_usd")),
        )
    )


MONEY = ("total_cost_usd", "cpu_cost_usd", "memory_cost_usd", "gpu_cost_usd")


def run_costs(
    pods: DataFrame,
    outcomes: DataFrame,
    keys: Sequence[str] = ("workflow_name", "step", "subject", "session"),
    run_keys: Sequence[str] = ("task", "run"),
    rename_steps: Mapping[str, str] | None = None,
    drop_steps: Sequence[str] = (),
    absent: str | None = "na",
) -> DataFrame:
    """Even split of pod cost over the runs the pod handled.

    Pods of one key are summed first (a retry adds cost, not rows), outcomes are renamed to the pods' step names, and
    a derivative that came from the same pod is dropped so that its dollars are not counted twice."""
    keys = list(keys)
    pod_cost = pods.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in MONEY],
        last_day("date").alias("date"),
        F.max("scrape_age_days").alias("scrape_age_days"),
    )
    runs = outcomes
    if absent is not None:
        for k in run_keys:
            runs = runs.filter(F.col(k) != absent)
    if drop_steps:
        runs = runs.filter(~F.col("step").isin(list(drop_steps)))
    if rename_steps:
        step = F.col("step")
        for old, new in rename_steps.items():
            step = F.when(F.col("step") == old, new).otherwise(step)
        runs = runs.withColumn("step", step)
    runs = runs.select(*keys, *run_keys)
    per_pod = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_runs_in_pod"))
    share = per_pod.join(pod_cost, keys).select(
        *keys,
        "n_runs_in_pod",
        *[(F.col(c) / F.col("n_runs_in_pod")).alias(c) for c in MONEY],
        "date",
        "scrape_age_days",
    )
    return runs.join(share, keys)


def subject_run_report(
    runs: DataFrame,
    workflows: DataFrame,
    costs: DataFrame,
    anatomy: DataFrame | None = None,
    workflow_time: str = "completed_at",
    tie_break: Sequence[str] = ("workflow_name",),
    anatomy_keys: Sequence[str] = ("subject", "session"),
) -> DataFrame:
    """Run rows with the subject's workflow of record and that workflow's summed cost: exactly one row per run.

    Costs are summed to workflow grain and workflows reduced to the newest per subject before anything is joined, so
    neither reprocessing nor a workflow billed on two days multiplies rows."""
    per_workflow = costs.groupBy("workflow_name").agg(F.sum("total_cost_usd").alias("total_cost_usd"))
    of_record = latest(workflows, ["subject"], workflow_time, tie_break).select(
        "subject", "workflow_name", "status", "total_duration_s"
    )
    of_record = of_record.join(per_workflow, "workflow_name", "left").drop("workflow_name")
    out = runs
    if anatomy is not None:
        out = out.join(anatomy, list(anatomy_keys), "left")
    return out.join(of_record, "subject", "left")


def batch_cost_summary(costs: DataFrame) -> DataFrame:
    """Per-subject sums, then one row over the subjects: total, mean, median, smallest, largest."""
    per_subject = costs.groupBy("subject").agg(F.sum("total_cost_usd").alias("cost"))
    summary = per_subject.agg(
        F.count(F.lit(1)).alias("n_subjects"),
        F.sum("cost").alias("total_usd"),
        F.avg("cost").alias("mean_usd"),
        F.min("cost").alias("min_usd"),
        F.max("cost").alias("max_usd"),
    )
    return with_quantiles(summary, per_subject, [], "cost", {"median_usd": 0.5})


def settled_cost_block(costs: DataFrame) -> DataFrame:
    """Batch summary with the youngest scrape: below the settling age the figure is provisional."""
    ages = costs.agg(F.min("scrape_age_days").alias("min_scrape_age_days"))
    age = ages.select("min_scrape_age_days").scalar()
    return batch_cost_summary(costs).withColumn("min_scrape_age_days", age).withColumn(
        "settled", F.col("min_scrape_age_days") >= SETTLED_AGE_DAYS
    )


def top_spend(costs: DataFrame, keys: Sequence[str] = ("pipeline", "subject"), n: int = 20) -> DataFrame:
    """The n most expensive groups with the days they were active."""
    return (
        costs.groupBy(*keys)
        .agg(
            *[F.round(F.sum(c), 4).alias(c.replace("_cost", "")) for c in MONEY],
            F.countDistinct("date").alias("days_active"),
        )
        .orderBy(F.desc("total_usd"), *keys)
        .limit(n)
    )


def aggregate_pod_costs(
    rows: DataFrame,
    keys: Sequence[str] = ("workflow_name", "pod"),
    plain: Sequence[str] = ("cpu_core_hours", "runtime_minutes", "total_cost_usd"),
    strict: Sequence[str] = ("node_h", "ondemand_usd"),
    problem: str = "problem",
    order: Sequence[str] = ("date",),
    settled: Column | None = None,
    listed: Mapping[str, str] | None = None,
) -> DataFrame:
    """Cost rows of one pod to one row. A single unpriced row makes the pod's strict sums NULL: no partial pods."""
    settled = F.col("scrape_age_days") >= SETTLED_AGE_DAYS if settled is None else settled
    complete = {c: F.count(finite(c)) == F.count(F.lit(1)) for c in strict}
    return rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in plain],
        *[F.when(complete[c], F.sum(c)).alias(c) for c in strict],
        (F.count(problem) == 0).alias("priced"),
        F.min_by(problem, F.when(F.col(problem).isNotNull(), F.struct(*order))).alias("problem"),
        F.bool_and(settled).alias("settled"),
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.array_join(F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c)))), ",").alias(name)
            for c, name in (listed or {}).items()
        ],
    )


def price_rows(
    rows: DataFrame,
    specs: DataFrame,
    pool_problem: Column | None = None,
    slices: Column | None = None,
    slices_unknown: Column | None = None,
    fit_tolerance: float = 1.02,
) -> DataFrame:
    """Node-hours of each cost row: the largest of its core, memory and card share of the instance.

    `specs` has (node_instance_type, vcpu, mem_gib, gpus). The first failing check becomes `problem`, and the row's
    node-hours are then NULL: node type missing, type unknown, GPU work on a node without cards, pool rule, larger than
    the node, unknown card slicing, no list price."""
    hours = F.col("runtime_minutes") / 60.0
    gpu = F.coalesce(F.col("gpu_hours"), F.lit(0.0)) > 0
    slices = F.lit(1) if slices is None else slices
    joined = rows.join(specs, "node_instance_type", "left")
    cores, ram = F.col("cpu_core_hours") / hours, F.col("ram_gb_hours") / hours
    too_big = (cores > F.col("vcpu") * fit_tolerance) | (ram > F.col("mem_gib") * fit_tolerance)
    name = F.col("node_instance_type")
    problem = F.when(hours <= 0, F.lit(None).cast("string"))
    problem = problem.when(name.isNull() | (name.cast("string") == ""), "no-instance-type")
    problem = problem.when(F.col("vcpu").isNull(), "unknown-instance-type")
    problem = problem.when(gpu & (F.coalesce("gpus", F.lit(0)) == 0), "gpu-pod-on-cpu-node")
    if pool_problem is not None:
        problem = problem.when(~gpu & pool_problem, "family-not-in-pool")
    problem = problem.when(too_big, "pod-larger-than-node")
    if slices_unknown is not None:
        problem = problem.when(gpu & slices_unknown, "gpu-slices-unknown")
    rate = F.col("node_ondemand_usd_per_hour")
    problem = problem.when(~(F.coalesce(rate, F.lit(0.0)) > 0), "no-on-demand-rate")
    card = F.when(gpu, F.col("gpu_hours") / slices).otherwise(0.0)
    node_h = F.greatest(
        F.col("cpu_core_hours") / F.col("vcpu"),
        F.col("ram_gb_hours") / F.col("mem_gib"),
        F.when(F.col("gpus") > 0, card / F.col("gpus")).otherwise(0.0),
    )
    return (
        joined.withColumn("problem", problem)
        .withColumn("node_h", F.when(hours <= 0, 0.0).when(F.col("problem").isNull(), node_h))
        .withColumn("card_h", F.when(F.col("problem").isNull(), card).when(~gpu, 0.0))
        .withColumn("ondemand_usd", F.col("node_h") * rate + F.col("pv_cost_usd") + F.col("network_cost_usd"))
    )


def session_cost_report(
    pods: DataFrame,
    session_of: str = "session",
    workflow: str = "workflow_name",
    sessions: DataFrame | None = None,
) -> DataFrame:
    """Settled cost per session: what the session's own pods cost plus 1/k of what its workflow shared.

    `sessions` has (workflow, session, n_runs). The cost columns are NULL unless every cost row of the workflow is
    settled: a provisional figure is refused, not reported."""
    own = (
        pods.filter(F.col(session_of).isNotNull())
        .groupBy(workflow, session_of)
        .agg(F.sum("total_cost_usd").alias("own_usd"))
    )
    per_workflow = pods.groupBy(workflow).agg(
        F.sum(F.when(F.col(session_of).isNull(), F.col("total_cost_usd"))).alias("shared_usd"),
        F.bool_and(F.col("scrape_age_days") >= SETTLED_AGE_DAYS).alias("settled"),
    )
    k = sessions.groupBy(workflow).agg(F.count(F.lit(1)).alias("k"))
    joined = (
        sessions.join(per_workflow.join(k, workflow), workflow, "left")
        .join(own, [workflow, session_of], "left")
        .withColumn("settled", F.coalesce("settled", F.lit(False)))
    )
    total = F.coalesce("own_usd", F.lit(0.0)) + F.coalesce("shared_usd", F.lit(0.0)) / F.col("k")
    out = joined.withColumn("session_usd", F.when(F.col("settled"), total))
    return out.withColumn("usd_per_run", F.when(F.col("n_runs") > 0, F.col("session_usd") / F.col("n_runs")))


def hourly_to_day(hours: DataFrame, keys: Sequence[str] = ("workflow_name",), hour: str = "hour") -> DataFrame:
    """Hourly allocations to one row per workflow: component sums, first named subject, total rebuilt from the
    components (adjustments are not final by the hour and are zeroed)."""
    named = F.when(F.col("subject").isNotNull() & (F.col("subject").cast("string") != ""), F.col("subject"))
    return (
        hours.groupBy(*keys)
        .agg(
            F.min_by(named, F.when(named.isNotNull(), F.struct(hour, "subject"))).alias("subject"),
            *[F.sum(c).alias(c) for c in MONEY[1:]],
            F.countDistinct(hour).alias("n_hours"),
        )
        .withColumn("total_adjustment_usd", F.lit(0.0))
        .withColumn("total_cost_usd", F.col("cpu_cost_usd") + F.col("memory_cost_usd") + F.col("gpu_cost_usd"))
    )


def missing_hours(spark, seen: DataFrame, hour: str, first_us: int, last_us: int, step_us: int = 3_600_000_000):
    """Hours of the window nobody billed: the full sequence minus the hours seen."""
    wanted = spark.range(first_us // step_us, last_us // step_us).select((F.col("id") * step_us).alias(hour))
    return wanted.join(seen.select(hour).distinct(), hour, "left_anti")


def drift_by_age(costs: DataFrame, keys: Sequence[str] = ("date",), ages: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """Cost by report date and scrape age with the day-1 overstatement against the settled figure."""
    wide = costs.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("scrape_age_days") == a, F.col("total_cost_usd"))).alias(f"cost_age_{a}")
            for a in ages
        ]
    )
    settled = F.col(f"cost_age_{max(ages)}")
    first = F.col("cost_age_1")
    return wide.withColumn("overstatement_pct", F.when(settled > 0, (first / settled - 1) * 100))


def median_overstatement(drift: DataFrame, column: str = "overstatement_pct") -> DataFrame:
    """One row: the median overstatement over the report dates that have one."""
    return exact_quantiles(drift, [], column, {"median_overstatement_pct": 0.5})


def settled_versions(costs: DataFrame, keys: Sequence[str], age: str = "scrape_age_days", tie=("completed_at",)):
    """The oldest scrape of each cost row wins: its figure has settled furthest."""
    return latest(costs, keys, age, tie)


def subtract_foreign(costs: DataFrame, pods: DataFrame, windows: DataFrame, digits: int = 6) -> DataFrame:
    """Take out of each workflow-day cost the pods no producing run of that workflow name explains.

    `windows` has (workflow_name, first_date, last_date): a pod goes when no window of its workflow covers its date."""
    covered = (F.col("p.workflow_name") == F.col("w.workflow_name")) & F.col("p.date").between(
        F.col("w.first_date"), F.col("w.last_date")
    )
    foreign = (
        pods.alias("p")
        .join(windows.alias("w"), covered, "left_anti")
        .groupBy("workflow_name", "date")
        .agg(*[F.sum(c).alias(f"_{c}") for c in MONEY], F.count(F.lit(1)).alias("pods_removed"))
    )
    joined = costs.join(foreign, ["workflow_name", "date"], "left")
    kept = [c for c in costs.columns if c not in MONEY]
    return joined.select(
        *kept,
        *[F.round(F.col(c) - F.coalesce(f"_{c}", F.lit(0.0)), digits).alias(c) for c in MONEY],
        F.coalesce("pods_removed", F.lit(0)).alias("pods_removed"),
    )


def null_reused_rates(
    pods: DataFrame, nodes: DataFrame, host: str = "node", instance: str = "instance", columns: Sequence[str] = ()
) -> DataFrame:
    """Rates of pods on a host name that more than one instance used cannot be trusted: set them to NULL."""
    reused = nodes.groupBy(host).agg(F.countDistinct(instance).alias("_n")).filter(F.col("_n") > 1).select(host)
    flagged = pods.join(reused.withColumn("_reused", F.lit(True)), host, "left")
    for c in columns:
        flagged = flagged.withColumn(c, F.when(F.col("_reused").isNull(), F.col(c)))
    return flagged.withColumn("host_reused", F.coalesce("_reused", F.lit(False))).drop("_reused")


def explode_allocations(
    responses: DataFrame, body: str, label: str = "workflow_name", adjustments: Sequence[str] = ()
) -> DataFrame:
    """Nested allocation sets (a JSON object per report, one member per label) to cost rows.

    Unlabelled members (`__…__`) are skipped; sums are rounded to six digits as stored."""
    members = "MAP<STRING, STRUCT<{}>>".format(
        ", ".join(
            ["properties: STRUCT<labels: MAP<STRING, STRING>>"]
            + [f"{c}: DOUBLE" for c in ("totalCost", "cpuCost", "ramCost", "gpuCost", *adjustments)]
        )
    )
    rows = responses.withColumn("_set", F.from_json(col(body), members))
    rows = rows.select(*[c for c in responses.columns if c != body], F.explode("_set").alias(label, "_a"))
    rows = rows.filter((F.col(label) != "") & ~F.col(label).startswith("__"))
    adjustment = F.lit(0.0)
    for c in adjustments:
        adjustment = adjustment + F.coalesce(F.col(f"_a.{c}"), F.lit(0.0))
    money = {"total_cost_usd": "totalCost", "cpu_cost_usd": "cpuCost", "memory_cost_usd": "ramCost", "gpu_cost_usd": "gpuCost"}
    return rows.select(
        *[c for c in rows.columns if c != "_a"],
        F.coalesce(F.col("_a.properties.labels")["subjectid"], F.lit("")).alias("subject"),
        *[F.round(F.coalesce(F.col(f"_a.{src}"), F.lit(0.0)), 6).alias(c) for c, src in money.items()],
        F.round(adjustment, 6).alias("total_adjustment_usd"),
    )


def effective_rates(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Node rate per hour it was up: NULL without recorded minutes. Capacity label first, then the preemptible flag."""
    minutes = F.coalesce("minutes", F.lit(0.0))
    capacity = (
        F.when(F.coalesce("capacity_label", F.lit("")) != "", F.col("capacity_label"))
        .when(F.col("preemptible").isNull(), "")
        .when(F.col("preemptible") > 0, "spot")
        .otherwise("on-demand")
    )
    return nodes.select(
        *keys,
        F.when(minutes > 0, F.round(F.coalesce("total_cost", F.lit(0.0)) / (minutes / 60.0), 6)).alias(
            "effective_usd_per_hour"
        ),
        capacity.alias("capacity_type"),
    )


def partial_read_guard(new: DataFrame, stored: DataFrame, key: str, floor: float = 0.5) -> DataFrame:
    """One row: distinct keys read now and stored, and whether the read is too short to replace the stored rows."""
    counted = new.select(F.col(key), F.lit("new").alias("_side")).unionByName(
        stored.select(F.col(key), F.lit("stored").alias("_side"))
    )
    return counted.agg(
        F.countDistinct(F.when(F.col("_side") == "new", F.col(key))).alias("n_new"),
        F.countDistinct(F.when(F.col("_side") == "stored", F.col(key))).alias("n_stored"),
    ).withColumn("refuse", F.col("n_new") < F.col("n_stored") * F.lit(floor))


def carry_proven(new: DataFrame, stored: DataFrame, keys: Sequence[str], identity: Sequence[str], rate: str) -> DataFrame:
    """Re-read rows keep what an earlier read proved.

    Same or no stored instance: the new row's identity and rate. Otherwise the stored identity with a NULL rate, since a
    rate from another read must not be paired with these dollars. `identity[0]` is the proof (NULL or '' = unproven)."""
    keys, proof = list(keys), identity[0]
    proven = stored.filter(F.coalesce(F.col(proof).cast("string"), F.lit("")) != "")
    proven = proven.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in identity])
    joined = new.join(proven, keys, "left")
    has_new = F.coalesce(F.col(proof).cast("string"), F.lit("")) != ""
    keep = F.col(f"_s_{proof}").isNull() | (has_new & (F.col(proof) == F.col(f"_s_{proof}")))
    out = joined.withColumn("_keep", keep)
    cols = [c for c in new.columns if c not in (*identity, rate)]
    return out.select(
        *cols,
        *[F.when(F.col("_keep"), F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c) for c in identity],
        F.when(F.col("_keep") & has_new, F.col(rate)).alias(rate),
    )


def unbilled_activity(active: DataFrame, billed: DataFrame, keys: Sequence[str], minimum: float) -> DataFrame:
    """Workflows that used more than `minimum` core- or card-hours and have no cost row."""
    used = active.groupBy(*keys).agg(F.sum("cpu_hours").alias("cpu_hours"), F.sum("gpu_hours").alias("gpu_hours"))
    used = used.filter(F.col("cpu_hours") + F.col("gpu_hours") > minimum)
    return used.join(billed.select(*keys), list(keys), "left_anti")


def capture_by_day(active: DataFrame, billed: DataFrame, day: str = "date", minimum: float = 0.9) -> DataFrame:
    """Billed over observed core-hours per day; below `minimum` the day is a shortfall."""
    seen = active.groupBy(day).agg(F.sum("cpu_hours").alias("observed_hours"))
    paid = billed.groupBy(day).agg(F.sum("cpu_hours").alias("billed_hours"))
    capture = F.when(F.col("observed_hours") > 0, F.col("billed_hours") / F.col("observed_hours")).otherwise(1.0)
    return (
        seen.join(paid, day, "left")
        .fillna(0.0, ["billed_hours"])
        .withColumn("capture", capture)
        .withColumn("shortfall", F.col("capture") < minimum)
    )


def orphan_workflows(pods: DataFrame, costs: DataFrame, keys: Sequence[str] = ("date", "workflow_name")) -> DataFrame:
    """Workflow-days with pod rows and no live cost row."""
    return pods.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pods"), F.sum("total_cost_usd").alias("usd")).join(
        costs.select(*keys), list(keys), "left_anti"
    )


def cost_coverage(costs: DataFrame, first: str, last: str, date: str = "date", settled_age: int = SETTLED_AGE_DAYS):
    """One row per day of the window: cost rows, rows still provisional, and whether the day is missing."""
    span = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    days = costs.sparkSession.range(1).select(F.explode(span).alias("_d")).select(F.date_format("_d", "yyyy-MM-dd").alias(date))
    per_day = costs.groupBy(date).agg(
        F.count(F.lit(1)).alias("n_rows"), count_if(F.col("scrape_age_days") < settled_age).alias("n_provisional")
    )
    return (
        days.join(per_day, date, "left")
        .fillna(0, ["n_rows", "n_provisional"])
        .withColumn("missing", F.col("n_rows") == 0)
    )


def scope_to_claims(
    costs: DataFrame, claims: DataFrame, keys: Sequence[str] = ("workflow_name", "date"), money: Sequence[str] = MONEY
) -> DataFrame:
    """Bill each stored row to the subjects that claim it, dollars times share. The stored subject is not trusted: a
    workflow name two subjects reused on one day is one row that belongs to both."""
    money = [c for c in money if c in costs.columns]
    joined = costs.drop("subject").join(claims.select(*keys, "subject", F.col("share").alias("_share")), list(keys))
    kept = [c for c in joined.columns if c not in (*money, "_share")]
    return joined.select(*kept, *[(F.col(c) * F.col("_share")).alias(c) for c in money])


def unclaimed_costs(costs: DataFrame, claims: DataFrame, keys: Sequence[str] = ("workflow_name", "date")) -> DataFrame:
    """One row: cost rows nobody claims and their dollars."""
    return costs.join(claims.select(*keys), list(keys), "left_anti").agg(
        F.count(F.lit(1)).alias("rows_dropped"), F.coalesce(F.sum("total_cost_usd"), F.lit(0.0)).alias("usd_dropped")
    )


def excluded_workflow(name: str | Column, prefixes: Sequence[str]) -> Column:
    """True for workflows whose cost is not recorded here, by name prefix."""
    return any_of(col(name).startswith(p) for p in prefixes)
