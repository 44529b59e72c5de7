"""Costs of days that billing missed, from what pods asked for: calibration on clean days, then reconstruction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.operators.intervals import day_share
from tidemark.operators.ordered import DAY_US
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.series import assign_by_window
from tidemark.session import measured, written_once


@dataclass(frozen=True)
class Component:
    """A priced component: pod column of requested unit-seconds, billed hours and dollars, the least seconds and hours of a
    workflow whose ratio is no noise, and the ratio where no workflow is that large."""

    name: str
    seconds: str
    hours: str
    usd: str
    least_seconds: float
    least_hours: float
    default: float


# ---- fixed values: thresholds and defaults of the components ---------------------------------------------------
COMPONENTS = (
    Component("cpu", "rd_cpu", "cpu_core_hours", "cpu_cost_usd", 3600, 1, 1.0),
    Component("mem", "rd_mem", "ram_gb_hours", "memory_cost_usd", 3600, 1, 0.0958),
    Component("gpu", "rd_gpu", "gpu_hours", "gpu_cost_usd", 60, 0.1, 1.0),
)
# ---- end of fixed values ---------------------------------------------------------------------------------------


def pod_days(pods: DataFrame, start: str, end: str, now_us: int | None = None) -> DataFrame:
    """A row per pod and day it ran on: `day_us`, `fraction` of its life and `minutes` on that day.

    A pod without an end lasts until `now_us`, or to the end of its first day where that is not given. One without a start is
    on no day. A pod is cut at the borders of its own days, so no pods and days are paired."""
    first = F.floor(col(start) / DAY_US) * DAY_US
    until = F.coalesce(col(end), F.lit(now_us).cast("long"), first + DAY_US)
    days = F.sequence(first, F.greatest(first, F.floor((until - 1) / DAY_US) * DAY_US), F.lit(DAY_US).cast("long"))
    cut = pods.filter(col(start).isNotNull()).withColumn("_until", until).withColumn("day_us", F.explode(days))
    fraction, minutes = day_share(start, "_until", F.col("day_us"))
    cut = cut.withColumns({"fraction": fraction, "minutes": minutes}).drop("_until")
    return cut.filter(F.col("fraction") > 0)


def unit_ratios(days: DataFrame, billed: DataFrame, keys: Sequence[str], components: Sequence[Component] = COMPONENTS) -> DataFrame:
    """One row with a column per component: billed hours per requested hour, the median over `keys` of substantial use.

    `keys` must name the day too where several days are calibrated on: a workflow that ran on two of them would be compared
    with twice its bill otherwise."""
    asked = days.groupBy(*keys).agg(*[F.sum(F.col(c.seconds) * F.col("fraction")).alias(f"_s_{c.name}") for c in components])
    paid = billed.groupBy(*keys).agg(*[F.sum(c.hours).alias(f"_h_{c.name}") for c in components])
    cells = F.array(
        *[
            F.when(
                (F.col(f"_s_{c.name}") > c.least_seconds) & (F.col(f"_h_{c.name}") > c.least_hours),
                F.struct(F.lit(c.name).alias("component"), (F.col(f"_h_{c.name}") / (F.col(f"_s_{c.name}") / 3600)).alias("ratio")),
            )
            for c in components
        ]
    )
    long = asked.join(paid, list(keys)).select(F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("x")).select("x.*")
    medians = exact_quantiles(written_once(long), ["component"], "ratio", {"ratio": 0.5})
    picked = [F.max(F.when(F.col("component") == c.name, F.nullif(F.col("ratio"), F.lit(0.0)))) for c in components]
    return medians.agg(*[F.coalesce(p, F.lit(c.default)).alias(c.name) for p, c in zip(picked, components, strict=True)])


def type_sums(billed: DataFrame, kind: str, components: Sequence[Component] = COMPONENTS) -> DataFrame:
    """Dollars and hours per instance type (`kind`, empty where unknown) and component: what all rates are quotients of."""
    sums = [F.sum(x).alias(f"{c.name}_{n}") for c in components for n, x in (("usd", c.usd), ("hours", c.hours))]
    return billed.groupBy(F.coalesce(F.col(kind), F.lit("")).alias(kind)).agg(*sums)


def rate(name: str, sums=lambda c: c) -> Column:
    """Dollars per hour, 0 where no hours were billed."""
    usd, hours = sums(F.col(f"{name}_usd")), sums(F.col(f"{name}_hours"))
    return F.coalesce(F.when(hours != 0, usd / hours), F.lit(0.0))


def type_rates(sums: DataFrame, kind: str, components: Sequence[Component] = COMPONENTS) -> DataFrame:
    """Rate per instance type and component: ratio of sums."""
    return sums.select(kind, *[rate(c.name).alias(c.name) for c in components])


def pooled_rates(sums: DataFrame, components: Sequence[Component] = COMPONENTS) -> DataFrame:
    """One row: the rates over all types, for types that were never billed."""
    return sums.agg(*[rate(c.name, F.sum).alias(c.name) for c in components])


def reconstruct_costs(
    days: DataFrame, runs: DataFrame, ratios: DataFrame, sums: DataFrame, kind: str, scraped: DataFrame | None = None,
    components: Sequence[Component] = COMPONENTS, workflow: str = "workflow_name", pod: Sequence[str] = ("pod",), start: str = "start_us",
) -> DataFrame:
    """Cost per (day, workflow, subject): requested seconds × ratio × share of the day × rate of the pod's instance type.

    `days`: :func:`pod_days` of the pods. `runs` (workflow, run, subject, start_us, end_us): a reused workflow name is told apart
    by the run whose window holds the pod's start; its subject goes before the one the pod was seen with. A type that
    was not billed has the pooled rates. `scraped` (day_us, workflow, usd) is what billing had, put beside it."""
    named = F.struct(F.col("run"), F.max("subject").over(Window.partitionBy(workflow, "run")).alias("subject"))
    runs = written_once(runs.select(workflow, F.when(F.col("run").isNotNull(), named).alias("_run"), "start_us", "end_us"))
    others = [c for c in days.columns if c not in (workflow, *pod, start)]
    rows = assign_by_window(days, runs, [workflow], list(pod), start, "_run", "start_us", "end_us", chunk_us=DAY_US, carry=others)

    def known(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(""))

    types = type_rates(sums, kind, components)
    types = measured(types.select(F.col(kind).alias("_type"), F.struct(*[c.name for c in components]).alias("_own")))
    rows = rows.join(types, F.coalesce(F.col(kind), F.lit("")) == F.col("_type"), "left")
    names = [c.name for c in components]
    scalars = {"_ratio": ratios.select(F.struct(*names)).scalar(), "_pooled": pooled_rates(sums, components).select(F.struct(*names)).scalar()}
    rows = rows.withColumns(scalars).withColumn("_price", F.coalesce("_own", "_pooled"))
    for c in components:
        rows = rows.withColumn(f"_{c.name}_h", F.col(c.seconds) / 3600 * F.col(f"_ratio.{c.name}") * F.col("fraction"))
    subject = F.coalesce(known("_run.subject"), known("subject"), F.lit("")).alias("subject")
    sums = {"pods": F.count(F.lit(1)), "pod_minutes": F.sum("minutes")}
    sums |= {c.hours: F.sum(f"_{c.name}_h") for c in components} | {c.usd: F.sum(F.col(f"_{c.name}_h") * F.col(f"_price.{c.name}")) for c in components}
    sums |= {"pods_without_instance_type": F.count_if(F.col(kind).isNull())}
    # rows of a workflow and a chunk lie together and are added up there; the sums are dealt out as what was billed is joined
    parts = rows.groupBy(workflow, "_chunk", "day_us", subject).agg(*[x.alias(n) for n, x in sums.items()])
    out = parts.repartition("day_us", workflow).groupBy("day_us", workflow, "subject").agg(*[F.sum(n).alias(n) for n in sums])
    out = out.withColumn("total_cost_usd", sum((F.col(c.usd) for c in components[1:]), F.col(components[0].usd)))
    if scraped is not None:
        held = scraped.select(F.col("day_us").alias("_day"), F.col(workflow).alias("_w"), F.col("usd").alias("scraped_total_cost_usd"))
        out = out.join(held, (F.col("day_us") == F.col("_day")) & (F.col(workflow) == F.col("_w")), "left").drop("_day", "_w")
    return out
