"""Cost and performance report of an audited batch: steps, coverage, list-price side, sessions, totals, as long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_if, finite
from tidemark.operators.costs import SETTLED_AGE_DAYS
from tidemark.operators.quantiles import with_quantiles
from tidemark.session import cut_lineage, written_once

# ---- fixed values: steps that bring data in -----------------------------------------------------------------------
INGRESS_STEPS = ("https-transfer", "verify-staged-input", "delete-globus-input", "globus-transfer")
# ---- end of fixed values ------------------------------------------------------------------------------------------

UNLABELLED = "<unlabelled>"


def _cells(df: DataFrame, section: str | Column, item: str | Column, measures: Mapping[str, Column]) -> DataFrame:
    """(section, item, measure, value): one row per measure of each row of `df`."""
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), c.cast("double").alias("value")) for m, c in measures.items()])
    section, item = (F.lit(x) if isinstance(x, str) else x for x in (section, item))
    return df.select(section.alias("section"), item.cast("string").alias("item"), F.inline(cells))


def audit_pods(rows: DataFrame, ingress: Sequence[str] = INGRESS_STEPS, settled_age: int = SETTLED_AGE_DAYS) -> DataFrame:
    """Priced cost rows to one row per (workflow_name, pod). The dollar sums are NULL as soon as one row of the pod has no figure.

    `rows` come from :func:`tidemark.operators.costs.price_rows`. What the rows with both rates cost, and would have cost at list
    price, is carried along, so the rows are read once."""
    effective, listed = F.col("node_effective_usd_per_hour"), F.col("node_ondemand_usd_per_hour")
    both = listed.isNotNull() & (effective > 0)
    compute = F.col("cpu_cost_usd") + F.col("memory_cost_usd") + F.col("gpu_cost_usd")
    at_list = compute * (listed / effective) + F.col("pv_cost_usd") + F.col("network_cost_usd")
    every = F.count(F.lit(1))
    named = F.coalesce(F.col("node_instance_id").cast("string"), F.lit("")) != ""
    step = F.coalesce(F.min("step"), F.lit(""))
    return rows.groupBy("workflow_name", "pod").agg(
        F.when(step == "", UNLABELLED).otherwise(step).alias("step"),
        F.coalesce(step.isin(*ingress), F.lit(False)).alias("ingress"),
        F.min("subject").alias("subject"),
        F.coalesce(F.min(F.col("session").cast("string")), F.lit("")).alias("session"),
        F.bool_or(F.coalesce(F.col("gpu_hours"), F.lit(0.0)) > 0).alias("gpu"),
        F.sum("runtime_minutes").alias("runtime_minutes"),
        F.when(F.count(finite("total_cost_usd")) == every, F.sum("total_cost_usd")).alias("operated"),
        F.when(F.count(finite("ondemand_usd")) == every, F.sum("ondemand_usd")).alias("on_demand"),
        F.min("problem").alias("problem"),
        (F.bool_and(named) & ~F.bool_and(effective.isNotNull())).alias("carried"),
        every.alias("rows"),
        F.sum("total_cost_usd").alias("all_usd"),
        F.sum(F.when(both, F.col("total_cost_usd"))).alias("covered_usd"),
        F.sum(F.when(both, at_list)).alias("covered_list_usd"),
        F.bool_and(F.coalesce(F.col("scrape_age_days") >= settled_age, F.lit(False))).alias("settled"),
    )


def session_shares(pods: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Per (subject, session) what it cost, as `operated_*` and `on_demand_*`: with all that its subject shared (`full`), with 1/k of
    it (`1k`), and that per run. k is the number of the subject's sessions.

    `sessions` (subject, session, n_runs) names them; a subject it does not name has those its pods name. A sum that lacks
    a figure is NULL. Sums are taken before the joins, so what a subject shares is never multiplied."""
    every = F.count(F.lit(1))
    money = ("operated", "on_demand")
    spent = pods.filter(~F.col("ingress") & F.col("subject").isNotNull()).groupBy("subject", "session").agg(
        *[F.when(F.count(m) == every, F.sum(m)).alias(m) for m in money], *[(F.count(m) < every).alias(f"no_{m}") for m in money]
    )
    spent = written_once(spent)
    seen = spent.filter("session <> ''").select("subject", "session", F.lit(0).cast("long").alias("n_runs"))
    if sessions is None:
        units = seen
    else:
        given = sessions.select("subject", F.col("session").cast("string").alias("session"), F.col("n_runs").cast("long").alias("n_runs"))
        given = given.join(spent.select("subject").distinct(), "subject", "left_semi")
        units = given.unionByName(seen.join(given.select("subject").distinct(), "subject", "left_anti"))
    k = units.groupBy("subject").agg(F.count(F.lit(1)).alias("k"))
    columns = [c for m in money for c in (m, f"no_{m}")]
    own = spent.filter("session <> ''").select("subject", "session", *[F.col(c).alias(f"own_{c}") for c in columns])
    shared = spent.filter("session = ''").select("subject", *[F.col(c).alias(f"shared_{c}") for c in columns])
    out = units.join(k, "subject").join(own, ["subject", "session"], "left").join(shared, "subject", "left")
    for m in money:
        lacking = F.coalesce(f"own_no_{m}", F.lit(False)) | F.coalesce(f"shared_no_{m}", F.lit(False))
        mine, common = (F.coalesce(f"{p}_{m}", F.lit(0.0)) for p in ("own", "shared"))
        share = F.when(~lacking, mine + common / F.col("k"))
        out = out.withColumns({f"{m}_full": F.when(~lacking, mine + common), f"{m}_1k": share, f"{m}_1k_per_run": F.when(F.col("n_runs") > 0, share / F.col("n_runs"))})
    return out.drop(*[f"{p}_{c}" for p in ("own", "shared") for c in columns])


def audit_report(
    rows: DataFrame,
    sessions: DataFrame | None = None,
    workflows: DataFrame | None = None,
    ingress: Sequence[str] = INGRESS_STEPS,
    settled_age: int = SETTLED_AGE_DAYS,
) -> DataFrame:
    """(section, item, measure, value): the whole report of a batch's priced cost rows.

    Sections: `scope`; `per_step` (runtimes with p50 and p95, dollars); `workflow_wall_clock_h` of `workflows` (total_duration_s);
    `coverage` with the reasons of unpriced pods; `spot_savings` over the rows with both rates; `ingress`; `per_session` (median,
    p5, p95 and n of each share); `total`. Performance is always reported. Every dollar figure of the report is NULL unless
    all cost rows are settled: a report is refused as a whole, not cell by cell."""
    pods = cut_lineage(audit_pods(rows, ingress, settled_age))
    settled = pods.agg(F.coalesce(F.bool_and("settled"), F.lit(False)).alias("s")).scalar()

    def usd(c: Column) -> Column:
        return F.when(settled, c)

    # the distinct count apart, or all sums would be shuffled by workflow
    workflow_names = pods.agg(F.countDistinct("workflow_name").alias("n")).scalar()
    one = cut_lineage(pods.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("pods"),
        F.count("on_demand").alias("priced"), count_if(F.col("carried")).alias("carried"),
        *[F.sum(c).alias(c) for c in ("covered_usd", "covered_list_usd", "all_usd", "operated", "on_demand")],
        F.sum(F.when(F.col("ingress"), F.col("operated"))).alias("in_usd"), F.sum(F.when(F.col("ingress"), F.col("runtime_minutes"))).alias("in_min"),
    ))
    c = F.col
    parts = [
        _cells(one, "scope", "", {"n_workflows": workflow_names, "n_pod_rows": c("n_rows"), "settled": settled.cast("int")}),
        _cells(one, "coverage", "", {"pods": c("pods"), "priced_at_list": c("priced"), "unpriced": c("pods") - c("priced"), "carried_instance_no_effective_rate": c("carried")}),
        _cells(one, "spot_savings", "", {
            "operated_usd_covered": usd(c("covered_usd")), "on_demand_usd_covered": usd(c("covered_list_usd")),
            "multiple": usd(c("covered_list_usd") / F.nullif(c("covered_usd"), F.lit(0.0))),
            "coverage_frac": usd(F.coalesce("covered_usd", F.lit(0.0)) / F.nullif(c("all_usd"), F.lit(0.0))),
        }),
        _cells(one, "ingress", "", {"operated_usd": usd(c("in_usd")), "runtime_min_total": c("in_min")}),
        _cells(one, "total", "", {"operated_usd": usd(c("operated")), "on_demand_usd_priced": usd(c("on_demand"))}),
    ]
    reasons = pods.filter("on_demand IS NULL").groupBy(F.coalesce("problem", F.lit("unknown")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    parts.append(_cells(reasons, "coverage", c("reason"), {"unpriced": c("n")}))
    steps = pods.groupBy("step").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or("gpu").alias("gpu"), F.bool_or("ingress").alias("ingress"), F.sum("runtime_minutes").alias("minutes"),
        F.sum("operated").alias("operated"), F.when(F.count("on_demand") == F.count(F.lit(1)), F.sum("on_demand")).alias("on_demand"),
    )
    parts.append(_cells(steps, "per_step", c("step"), {
        "n_pods": c("n"), "gpu": c("gpu").cast("int"), "ingress": c("ingress").cast("int"), "runtime_min_total": c("minutes"),
        "operated_usd": usd(c("operated")), "on_demand_usd": usd(c("on_demand")),
    }))

    # all distributions in one pass: (section, item) is the key of the narrowing
    shares = written_once(session_shares(pods, sessions))
    names = [f"{m}_{s}" for m in ("operated", "on_demand") for s in ("full", "1k", "1k_per_run")]
    parts.append(_cells(shares.agg(F.count(F.lit(1)).alias("n")), "per_session", "", {"n_sessions": c("n")}))
    values = _cells(shares, "per_session", "", {n: c(n) for n in names}).select("section", F.col("measure").alias("item"), "value")
    values = values.unionByName(pods.select(F.lit("per_step").alias("section"), F.col("step").alias("item"), F.col("runtime_minutes").cast("double").alias("value")))
    if workflows is not None:
        hours = (F.col("total_duration_s") / 3600.0).cast("double")
        values = values.unionByName(workflows.select(F.lit("workflow_wall_clock_h").alias("section"), F.lit("").alias("item"), hours.alias("value")))
    keys = ["section", "item"]
    values = written_once(values)  # read by each pass of the quantiles
    spread = values.groupBy(*keys).agg(F.count("value").alias("n"), F.max("value").alias("top"))
    spread = with_quantiles(spread, values, keys, "value", {"p5": 0.05, "p50": 0.5, "p95": 0.95})
    wanted = {
        "per_step": {"runtime_min_p50": c("p50"), "runtime_min_p95": c("p95")},
        "workflow_wall_clock_h": {"n": c("n"), "p50": c("p50"), "p95": c("p95"), "max": c("top")},
        "per_session": {"median": usd(c("p50")), "p5": usd(c("p5")), "p95": usd(c("p95")), "n": c("n")},
    }
    spread = cut_lineage(spread)
    parts += [_cells(spread.filter(c("section") == section), section, c("item"), measures) for section, measures in wanted.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
