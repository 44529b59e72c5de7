"""Exact interpolating quantiles of groups of any size.

The built-in exact `percentile` keeps all distinct values of a group in one aggregation buffer. That is right for
small groups (frames of a voxel), and wrong where one group may hold a third of the table. Here passes narrow a rank down:
rows are counted in logarithmic cells, those of large cells that hold wanted ranks in linear cells between the cell's own
ends, and only the values of the cells hit are shuffled, equal ones as one. Counting is a partial aggregate, so no pass
but the last moves values; an outlier or a heavy tail stretches no cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.operators.ordered import upto_here
from tidemark.session import BROADCAST_ROWS, cut_lineage, measured

#: Cells per group. A cell of an evenly spread group holds 1/4096 of its distinct values.
GRID = 4096
#: Logarithmic cells per factor e. Costs from a cent to a million take about 3,500.
LOG_CELLS = 256
#: Rows of a logarithmic cell that are fetched without a look at its linear cells.
CELL_ROWS = 200_000


def packed_key(keys: Sequence[str]) -> Column:
    """The key as one struct, so that a NULL key stays a group of its own through joins; a constant without keys."""
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str | Column, probs: Mapping[str, float]
) -> DataFrame:
    """One row per key with a column per entry of `probs` (name -> probability), linear interpolation between
    closest ranks, NULL, NaN and infinite values left out. Groups without any value are absent."""
    position = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, p in probs.items()}
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in position.values()])))
    picked = values_at_ranks(df, keys, value, wanted)
    out = []
    for name, p in position.items():
        lo, hi = F.element_at("_at", F.floor(p)), F.element_at("_at", F.ceil(p))
        out.append((lo + (hi - lo) * (p - F.floor(p))).alias(name))
    return picked.select(*(["_k.*"] if keys else []), *out)


def values_at_ranks(
    df: DataFrame, keys: Sequence[str], value: str | Column, ranks: Column, per_key: DataFrame | None = None
) -> DataFrame:
    """Per key `_k` the size `_n` and a map `_at` from each wanted 0-based rank to its value. `ranks` is an array
    expression of `_n` and of the columns of `per_key` (one row per key); ranks outside the group are left out."""
    x = col(value).cast("double")
    rows = df.select(packed_key(keys).alias("_k"), x.alias("_x"))
    rows = rows.filter(F.col("_x").isNotNull() & ~F.isnan("_x") & (F.abs("_x") != F.lit(float("inf"))))
    coarse = F.signum("_x") * F.floor(F.log1p(F.abs("_x")) * LOG_CELLS)
    rows = rows.withColumn("_a", coarse.cast("long"))
    ends = [F.count(F.lit(1)).alias("_cc"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]

    grid = cut_lineage(rows.groupBy("_k", "_a").agg(*ends))
    upto = Window.partitionBy("_k").orderBy("_a").rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.withColumn("_upto", F.sum("_cc").over(upto)).withColumn("_n", F.sum("_cc").over(Window.partitionBy("_k")))
    if per_key is not None:
        extra = [c for c in per_key.columns if c not in keys]
        grid = grid.join(per_key.select(packed_key(keys).alias("_k"), *extra), "_k")
    hit = _hit(grid.withColumn("_before", F.col("_upto") - F.col("_cc")).withColumn("_wanted", ranks))
    hit = cut_lineage(hit.select("_k", "_a", "_lo", "_hi", "_cc", "_before", "_n", "_wanted"))
    wide = hit.filter("_lo < _hi").select("_k", "_a", F.col("_lo").alias("_low"), F.col("_hi").alias("_high"), "_cc")
    size = wide.agg(F.count(F.lit(1)).alias("n"), F.max("_cc").alias("rows")).first()
    few = F.broadcast(wide.drop("_cc")) if size["n"] <= BROADCAST_ROWS else wide.drop("_cc")
    inner = rows.join(few, ["_k", "_a"])
    settled = [hit]  # one value in the whole cell
    if (size["rows"] or 0) <= CELL_ROWS:
        inner, last = inner.withColumn("_b", F.lit(0)), hit.withColumn("_b", F.lit(0))
    else:
        inner, last = _linear_cells(inner, hit, ends)
        settled.append(last)
    last = last.filter("_lo < _hi").select("_k", "_a", "_b", "_before", "_n", "_wanted")
    values = inner.join(measured(last.select("_k", "_a", "_b")), ["_k", "_a", "_b"]) if len(settled) > 1 else inner
    values = values.groupBy("_k", "_a", "_b", "_x").agg(F.count(F.lit(1)).alias("_c")).join(last, ["_k", "_a", "_b"])
    inside = Window.partitionBy("_k", "_a", "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("_to", F.col("_before") + F.sum("_c").over(inside))
    mine = F.filter("_wanted", lambda r: (r >= F.col("_to") - F.col("_c")) & (r < F.col("_to")))
    found = values.select("_k", "_n", "_x", F.explode(mine).alias("_r"))
    for cells in settled:
        one = cells.filter("_lo = _hi").select("_k", "_n", F.col("_lo").alias("_x"), F.explode("_wanted").alias("_r"))
        found = found.unionByName(one)
    return found.groupBy("_k").agg(F.max("_n").alias("_n"), F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at"))


def _linear_cells(inner: DataFrame, hit: DataFrame, ends: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows of the logarithmic cells hit with their linear cell `_b`, and the linear cells hit: the second pass."""
    fine = F.least(F.floor((F.col("_x") - F.col("_low")) / (F.col("_high") - F.col("_low")) * GRID), F.lit(GRID - 1)).cast("int")
    inner = inner.withColumn("_b", fine)
    upto = Window.partitionBy("_k", "_a").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cells = inner.groupBy("_k", "_a", "_b").agg(*ends).withColumn("_upto", F.sum("_cc").over(upto))
    cells = cells.join(hit.select("_k", "_a", F.col("_before").alias("_base"), "_n", "_wanted"), ["_k", "_a"])
    cells = cells.withColumn("_upto", F.col("_base") + F.col("_upto")).withColumn("_before", F.col("_upto") - F.col("_cc"))
    return inner, cut_lineage(_hit(cells).select("_k", "_a", "_b", "_lo", "_hi", "_before", "_n", "_wanted"))


def trimmed_sums(df: DataFrame, keys: Sequence[str], value: str | Column, trim: float) -> DataFrame:
    """Per key: `n`, `cut` = floor(trim · n), the cut-th value from either end (`low`, `high`) and, over the n − 2 cut values between
    them, `s1` = Σx and `s2` = Σx².

    Two ranks are looked up; then one partial aggregate adds the values between the cuts, and those equal to a cut by their
    number, so no value is shuffled or sorted. Values that are not finite are left out; keys without any are absent."""
    k = F.floor(F.lit(trim) * F.col("_n")).cast("long")
    cuts = values_at_ranks(df, keys, value, F.array_distinct(F.array(k, F.col("_n") - 1 - k)))
    cuts = cuts.filter(F.col("_n") > 2 * k).select(
        F.col("_k").alias("_of"), F.col("_n").alias("n"), k.alias("cut"), F.element_at("_at", k).alias("low"), F.element_at("_at", F.col("_n") - 1 - k).alias("high")
    )
    x = F.col("_x")
    rows = df.select(packed_key(keys).alias("_k"), col(value).cast("double").alias("_x"))
    rows = rows.filter(x.isNotNull() & ~F.isnan("_x") & (F.abs("_x") != F.lit(float("inf"))))
    met = rows.join(measured(cuts), F.col("_k") == F.col("_of"))
    between = (x > F.col("low")) & (x < F.col("high"))
    sums = met.groupBy("_k", "n", "cut", "low", "high").agg(
        F.sum(F.when(between, x)).alias("_s1"), F.sum(F.when(between, x * x)).alias("_s2"),
        F.count_if(x <= F.col("low")).alias("_to_low"), F.count_if(x < F.col("high")).alias("_below_high"),
    )
    kept = F.col("n") - 2 * F.col("cut")
    same = F.col("low") == F.col("high")
    at_low = F.when(same, kept).otherwise(F.col("_to_low") - F.col("cut"))
    at_high = F.when(same, F.lit(0)).otherwise(F.col("n") - F.col("cut") - F.col("_below_high"))
    zero = F.lit(0.0)
    return sums.select(
        *(["_k.*"] if keys else []), "n", "cut", "low", "high",
        (F.coalesce("_s1", zero) + at_low * F.col("low") + at_high * F.col("high")).alias("s1"),
        (F.coalesce("_s2", zero) + at_low * F.col("low") ** 2 + at_high * F.col("high") ** 2).alias("s2"),
    )


def mid_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Average ranks (1-based) of a value inside each key; equal values share their mean rank, missing ones have none.

    Distinct values are dealt out by ranges of their order (sampled, so each task gets an equal share wherever the values
    lie), and a task's first rank is the number of rows in the tasks before it."""
    x = F.col(value).cast("double")
    counts = df.select(packed_key(keys).alias("_k"), x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    counts = counts.groupBy("_k", "_x").agg(F.count(F.lit(1)).alias("_c"))
    placed = upto_here(counts, "_k", ["_x"], "_c", "_to")
    ranked = placed.select(F.col("_k"), F.col("_x"), (F.col("_to") - (F.col("_c") - 1) / 2.0).alias(out))
    keyed = df.withColumn("_k", packed_key(keys)).withColumn("_x", x)
    return keyed.join(ranked, ["_k", "_x"], "left").drop("_k", "_x")


def _hit(cells: DataFrame) -> DataFrame:
    """Cells in which wanted ranks lie, with those ranks."""
    here = F.filter("_wanted", lambda r: (r >= F.col("_before")) & (r < F.col("_upto")))
    return cells.withColumn("_wanted", here).filter(F.size("_wanted") > 0)


def with_quantiles(
    grouped: DataFrame, df: DataFrame, keys: Sequence[str], value: str | Column, probs: Mapping[str, float]
) -> DataFrame:
    """Attach :func:`exact_quantiles` of `df` to an already grouped report over the same keys."""
    q = exact_quantiles(df, keys, value, probs)
    if not keys:
        row = grouped.withColumn("_q", q.select(F.struct(*probs)).scalar())
        return row.select(*grouped.columns, *[F.col(f"_q.{name}").alias(name) for name in probs])
    packed = q.select(F.struct(*keys).alias("_k"), *probs)
    return grouped.withColumn("_k", F.struct(*keys)).join(packed, "_k", "left").drop("_k")
