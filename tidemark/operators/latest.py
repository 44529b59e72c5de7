"""Newest record per unit, and the joins that need it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import chain


def latest(
    df: DataFrame, keys: Sequence[str], time: str, tie_break: Sequence[str] = (), keep: int = 1
) -> DataFrame:
    """The newest row of each unit. `tie_break` (descending) makes the choice total.

    Filtering a row number lets Spark keep only the best row per unit and partition before the shuffle, so a unit with
    very many versions costs no more than the others."""
    order = [F.col(time).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= keep).drop("_rn")


def scan_scope_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    window: Column,
    left_columns: Sequence[str],
    right_columns: Sequence[str],
    time: str = "completed_at",
    tie_break: Sequence[str] = (),
    left_prefix: str = "",
    right_prefix: str = "",
) -> DataFrame:
    """Units with a record of either table in the window, each with the newest record of both tables whenever written.

    Which units are in scope and which record describes them are separate questions: the window only selects units."""
    keys = list(keys)
    units = left.filter(window).select(*keys).union(right.filter(window).select(*keys)).distinct()
    sides = []
    for df, columns, prefix in ((left, left_columns, left_prefix), (right, right_columns, right_prefix)):
        newest = latest(df.join(units, keys, "left_semi"), keys, time, tie_break)
        sides.append(newest.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in columns]))
    return units.join(sides[0], keys, "left").join(sides[1], keys, "left")


def enrich_latest(
    df: DataFrame, other: DataFrame, keys: Sequence[str], time: str, tie_break: Sequence[str], prefix: str,
    columns: Sequence[str],
) -> DataFrame:
    """Left join with the newest record of another table, its columns prefixed; row count unchanged."""
    newest = latest(other, keys, time, tie_break)
    return df.join(newest.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in columns]), list(keys), "left")


def accepted_latest(
    df: DataFrame, accepted: DataFrame, keys: Sequence[str], time: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Rows of accepted units, newest record per unit."""
    return latest(df.join(accepted.select(*keys).distinct(), list(keys), "left_semi"), keys, time, tie_break)


def hybrid_read(raw: DataFrame, compacted: DataFrame, today: str, columns: Sequence[str], dt: str = "dt") -> DataFrame:
    """Today's raw rows and older compacted rows: no date is on both sides, so nothing is counted twice."""
    return (
        raw.filter(F.col(dt) == today)
        .select(*columns)
        .unionByName(compacted.filter(F.col(dt) < today).select(*columns))
    )


def superseded_plan(
    records: DataFrame, keys: Sequence[str], time: str, verdict: str | None = None, path: str | None = None,
    passing: str = "pass", failing: str = "fail", tie: str | None = None,
) -> DataFrame:
    """Per unit with more than one record: records, superseded records, and the first reason to hold its clean-up.

    A unit is held when a record has no time, when two records share the final time, when a pass would be superseded by
    a fail, or when a superseded record shares its object with another unit."""
    keys = list(keys)
    if path is not None:
        per_object = records.groupBy(path).agg(F.count(F.lit(1)).alias("_in_object"))
        # a record without a path shares its object with none and stays in the plan
        records = records.join(per_object.filter(F.col(path).isNotNull()), path, "left")
    same_time = records.groupBy(*keys, time).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.max("_in_object") if path is not None else F.lit(1)).alias("_shared"),
        (F.bool_or(F.col(verdict) == passing) if verdict else F.lit(False)).alias("_pass"),
        (F.bool_or(F.col(verdict) == failing) if verdict else F.lit(False)).alias("_fail"),
    )
    last = same_time.groupBy(*keys).agg(F.max(time).alias("_last"), F.sum("_n").alias("n_records"))
    older, newest = F.col(time) < F.col("_last"), F.col(time) == F.col("_last")
    grouped = (
        same_time.join(last.filter(F.col("n_records") > 1), keys)
        .groupBy(*keys)
        .agg(
            F.max("n_records").alias("n_records"),
            F.sum(F.when(F.col(time).isNull(), F.col("_n")).otherwise(0)).alias("n_undated"),
            F.sum(F.when(newest, F.col("_n")).otherwise(0)).alias("n_newest"),
            F.sum(F.when(older, F.col("_n")).otherwise(0)).alias("n_superseded"),
            F.coalesce(F.bool_or(F.col("_pass") & older), F.lit(False)).alias("_pass"),
            F.coalesce(F.bool_or(F.col("_fail") & newest), F.lit(False)).alias("_fail"),
            F.coalesce(F.max(F.when(older, F.col("_shared"))), F.lit(0)).alias("_shared"),
        )
    )
    cases = [
        (F.col("n_undated") > 0, "record_without_time"),
        (F.col("n_newest") > 1, "ambiguous_final"),
        (F.col("_pass") & F.col("_fail"), "pass_superseded_by_fail"),
        (F.col("_shared") > 1, "shared_object"),
    ]
    return grouped.withColumn("hold", chain(cases)).drop("_pass", "_fail", "_shared")
