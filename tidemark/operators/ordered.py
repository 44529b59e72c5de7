"""Ordered operators that never put one key into one task.

A plain window over `partitionBy(key)` sends every row of a key to one task, and one key may hold a third of the
table. These operators split each key's timeline into chunks. A window runs inside (key, chunk); one small row per
chunk carries what the later chunks need, so only the chunk summary is ordered per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.session import cut_lineage, measured

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def time_chunk(us: str | Column, width_us: int = HOUR_US) -> Column:
    """Number of the fixed-width chunk a microsecond timestamp falls into."""
    return F.floor(col(us) / F.lit(width_us)).cast("long")


def _with_chunk_carry(
    df: DataFrame, keys: Sequence[str], chunk: str, summary: Column, prefix, out: str, ascending: bool
) -> DataFrame:
    """Join to every row the prefix of a per-chunk summary over the chunks before it."""
    order = F.col(chunk).asc() if ascending else F.col(chunk).desc()
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        df.groupBy(*keys, chunk)
        .agg(summary.alias("_in_chunk"))
        .select(*keys, chunk, prefix(F.col("_in_chunk")).over(before).alias(out))
    )
    return df.join(carry, [*keys, chunk], "left")


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    chunk: str,
    include_current: bool = False,
    ascending: bool = True,
) -> DataFrame:
    """Last non-NULL `value` before each row of its key (`ascending=False`: the next one after it).

    `order` must be a total order inside a key and must not contradict `chunk` (a later chunk has later rows).
    """
    df = df.withColumn("_v", value)
    position = F.struct(*[F.col(c) for c in order])
    pick = F.max_by if ascending else F.min_by
    summary = pick(F.col("_v"), F.when(F.col("_v").isNotNull(), position))
    df = _with_chunk_carry(
        df, keys, chunk, summary, lambda c: F.last(c, ignorenulls=True), "_carried", ascending
    )
    inside = Window.partitionBy(*keys, chunk).orderBy(
        *[F.col(c).asc() if ascending else F.col(c).desc() for c in order]
    )
    inside = inside.rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    return df.withColumn(
        out, F.coalesce(F.last("_v", ignorenulls=True).over(inside), F.col("_carried"))
    ).drop("_v", "_carried")


def previous_value(df, keys, order, value: Column, out: str, chunk: str) -> DataFrame:
    """`lag` by one row, as a struct so that a NULL in the previous row stays a NULL."""
    boxed = carry_last(df, keys, order, F.struct(value.alias("v")), "_boxed", chunk)
    return boxed.withColumn(out, F.col("_boxed.v")).drop("_boxed")


def next_value(df, keys, order, value: Column, out: str, chunk: str) -> DataFrame:
    """`lead` by one row."""
    boxed = carry_last(df, keys, order, F.struct(value.alias("v")), "_boxed", chunk, ascending=False)
    return boxed.withColumn(out, F.col("_boxed.v")).drop("_boxed")


def running_sum(df, keys, order: Sequence[str], value: Column, out: str, chunk: str) -> DataFrame:
    """Sum of `value` over the key's rows up to and including the current one."""
    df = df.withColumn("_v", value)
    df = _with_chunk_carry(df, keys, chunk, F.sum("_v"), F.sum, "_carried", True)
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce(F.col("_carried"), F.lit(0)) + F.coalesce(F.sum("_v").over(inside), F.lit(0))
    return df.withColumn(out, total).drop("_v", "_carried")


def upto_here(df: DataFrame, key: str, order: Sequence[str], weight: str, out: str) -> DataFrame:
    """Sum of `weight` over the key's rows up to and including the current one, for an order without natural chunks.

    Rows are dealt out by sampled ranges of (key, order) and sorted there, so a hot key spreads over tasks of equal size; one
    row per (range, key) carries the sum before it. The rows are checkpointed once, because a range must keep its number."""
    sorted_ = cut_lineage(df.repartitionByRange(key, *order).sortWithinPartitions(key, *order))
    sorted_ = sorted_.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    sums = sorted_.groupBy("_part", F.col(key).alias("_of")).agg(F.sum(weight).alias("_w"))
    before = Window.partitionBy("_of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(F.col("_part").alias("_p"), "_of", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy("_part", key).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    held = sorted_.join(measured(carry), (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_of")))
    return held.withColumn(out, F.col("_carried") + F.sum(weight).over(inside)).drop("_part", "_at", "_p", "_of", "_carried")


def row_position(df, keys, order: Sequence[str], out: str, chunk: str) -> DataFrame:
    """1-based position inside the key: `row_number` with the key split into chunks."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), out, chunk)
