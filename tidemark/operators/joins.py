"""Scope joins, presence checks and paired-arm joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import chain, count_if, finite, ratio
from tidemark.operators.quantiles import with_quantiles


def presence(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Which keys each of two roots has: both, missing_in_a, missing_in_b."""
    marked = (
        a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
        .unionByName(b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
        .groupBy(*keys)
        .agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    )
    status = chain([(F.col("_a") == 0, "missing_in_a"), (F.col("_b") == 0, "missing_in_b")], "both")
    return marked.select(*keys, status.alias("presence"))


def paired_ratios(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, tuple]) -> DataFrame:
    """Arm a over arm b per unit both have. A zero or missing denominator gives NULL.

    `measures` may map an output name to (column of a, column of b): a view compares two different columns."""
    if not isinstance(measures, Mapping):
        measures = {m: (m, m) for m in measures}
    present = {m: (x, y) for m, (x, y) in measures.items() if x in a.columns and y in b.columns}
    left = a.select(*keys, *[F.col(x).alias(f"_a_{m}") for m, (x, _) in present.items()])
    right = b.select(*keys, *[F.col(y).alias(f"_b_{m}") for m, (_, y) in present.items()])
    joined = left.join(right, list(keys))
    return joined.select(*keys, *[ratio(f"_a_{m}", f"_b_{m}").alias(m) for m in present])


def calibrate_pair(
    measured: DataFrame, tabulated: DataFrame, keys: Sequence[str], x: str, y: str, tolerance: float
) -> DataFrame:
    """One row comparing a recomputed value with a tabulated one: pairs, largest and median difference, beyond tolerance."""
    joined = measured.select(*keys, finite(x).alias("_x")).join(tabulated.select(*keys, finite(y).alias("_y")), list(keys))
    diffs = joined.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull()).select(
        F.abs(F.col("_x") - F.col("_y")).alias("_d")
    )
    summary = diffs.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.max("_d").alias("max_abs_difference"),
        count_if(F.col("_d") > tolerance).alias("n_beyond"),
    )
    return with_quantiles(summary, diffs, [], "_d", {"median_abs_difference": 0.5})


def scope_to_batch(
    costs: DataFrame, workflows: DataFrame | None, key: str = "workflow_name"
) -> tuple[DataFrame, DataFrame]:
    """(rows of the batch's workflows, rows of foreign workflows). Without a workflow list everything is in scope."""
    if workflows is None:
        return costs, costs.limit(0)
    listed = workflows.select(key)
    return costs.join(listed, key, "left_semi"), costs.join(listed, key, "left_anti")


def foreign_summary(costs: DataFrame, workflows: DataFrame, key: str = "workflow_name", amount: str = "total_cost_usd"):
    """One row: rows, distinct workflows and dollars in and outside the batch."""
    marked = costs.join(workflows.select(key).distinct().withColumn("_in", F.lit(True)), key, "left")
    inside = F.col("_in").isNotNull()
    return marked.agg(
        count_if(inside).alias("rows_in_batch"),
        count_if(~inside).alias("rows_foreign"),
        F.countDistinct(F.when(~inside, F.col(key))).alias("workflows_foreign"),
        F.coalesce(F.sum(F.when(~inside, F.col(amount))), F.lit(0.0)).alias("usd_foreign"),
    )


def session_flags(base: DataFrame, flags: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """A boolean column per flag: is the unit in that flag's table."""
    out = base
    for name, df in flags.items():
        marked = df.select(*keys).distinct().withColumn(name, F.lit(True))
        out = out.join(marked, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


def first_failing(reasons: Sequence[tuple[Column, str]], out: str = "reason") -> Column:
    """The first reason that holds, NULL for an eligible row."""
    return chain(reasons).alias(out)


def subject_summary(
    workflows: DataFrame, sides: Sequence[tuple[DataFrame, Sequence[str]]], averaged: Sequence[DataFrame], key: str = "subject"
) -> DataFrame:
    """Workflow rows with per-subject summaries of other tables.

    `sides` are joined on the subject with their distinct value combinations (a subject with two anatomies has two
    rows), `averaged` are one-row-per-subject aggregates. An average over a many-to-many join on the subject equals the
    average over its own table, because every row repeats equally often; so nothing is multiplied before it is averaged."""
    base = workflows.distinct()
    out = reduce(lambda df, s: df.join(s[0].select(key, *s[1]).distinct(), key, "left"), sides, base)
    return reduce(lambda df, s: df.join(s, key, "left"), averaged, out)


def lookup_steps(df: DataFrame, vocabulary: Mapping[str, str], template: str, out: str) -> DataFrame:
    """Template name to canonical step; a name outside the vocabulary is an error, not an empty result."""
    table = F.create_map(*[F.lit(x) for pair in vocabulary.items() for x in pair])
    message = F.concat(F.lit("no step for template "), F.col(template))
    return df.withColumn(out, F.coalesce(F.try_element_at(table, F.col(template)), F.raise_error(message)))


def route_rows(df: DataFrame, name: str, pairs: Mapping[str, str], default: str) -> DataFrame:
    """Target store of each row by audit pair (`audit-<pair>-…` prefix); `default` otherwise, NULL if not configured."""
    pair = F.regexp_extract(F.col(name), r"^audit-([a-z0-9]+)-", 1)
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]) if pairs else F.create_map()
    target = F.when(pair == "", F.lit(default)).otherwise(F.try_element_at(table, pair))
    return df.withColumn("target", target)


def classified_differences(rows: DataFrame, floor: DataFrame) -> DataFrame:
    """Each difference against the noise floor of its hardware pair: within_noise, hardware, defect, unexplained.

    `rows` has measure, distance, hardware_a, hardware_b; `floor` has measure, pair ("x|y", sorted), largest distance."""
    ordered = F.array_sort(F.array("hardware_a", "hardware_b"))
    same = F.col("hardware_a") == F.col("hardware_b")
    pair_floor = floor.select("measure", "pair", F.col("largest").alias("_pair"))
    parts = F.split("pair", r"\|")
    same_floor = (
        floor.filter(parts[0] == parts[1]).groupBy("measure").agg(F.min("largest").alias("_same"))
    )
    joined = (
        rows.withColumn("pair", F.array_join(ordered, "|"))
        .join(pair_floor, ["measure", "pair"], "left")
        .join(same_floor, "measure", "left")
    )
    d = F.col("distance")
    verdict = chain(
        [
            (same & F.col("_pair").isNull(), "unexplained"),
            (same & (d <= F.col("_pair")), "within_noise"),
            (same, "defect"),
            (d <= F.col("_same"), "within_noise"),
            (F.col("_pair").isNull(), "unexplained"),
            (d <= F.col("_pair"), "hardware"),
        ],
        "defect",
    )
    return joined.withColumn("verdict", verdict).drop("_pair", "_same")


def family_differences(
    a: DataFrame, b: DataFrame, keys: Sequence[str], unit: Sequence[str], family: Mapping[str, str]
) -> DataFrame:
    """Largest relative difference per column family of two tables with the same columns.

    Per column max|a−b| / max|a| (1 where max|a| is 0), then the largest over the family; a value present on one side
    only makes the family a `nan_mismatch` with difference 1."""
    columns = [c for c in family if c in a.columns and c in b.columns]
    joined = a.select(*keys, *[finite(c).alias(f"_a_{c}") for c in columns]).join(
        b.select(*keys, *[finite(c).alias(f"_b_{c}") for c in columns]), list(keys)
    )
    aggs = []
    for c in columns:
        x, y = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        aggs += [
            F.max(F.abs(x - y)).alias(f"_d_{c}"),
            F.max(F.abs(x)).alias(f"_m_{c}"),
            F.bool_or(x.isNull() != y.isNull()).alias(f"_n_{c}"),
        ]
    per_unit = joined.groupBy(*unit).agg(*aggs)
    cells = F.array(
        *[
            F.struct(
                F.lit(family[c]).alias("family"),
                F.lit(c).alias("column"),
                F.col(f"_n_{c}").alias("mismatch"),
                F.when(F.col(f"_n_{c}"), 1.0)
                .otherwise(
                    F.coalesce(F.col(f"_d_{c}"), F.lit(0.0))
                    / F.when(F.coalesce(F.col(f"_m_{c}"), F.lit(0.0)) > 0, F.col(f"_m_{c}")).otherwise(1.0)
                )
                .alias("difference"),
            )
            for c in columns
        ]
    )
    return (
        per_unit.select(*unit, F.inline(cells))
        .groupBy(*unit, "family")
        .agg(
            F.max("difference").alias("max_rel_diff"),
            F.max_by("column", F.struct("difference", "column")).alias("worst_column"),
            F.bool_or("mismatch").alias("nan_mismatch"),
        )
    )
