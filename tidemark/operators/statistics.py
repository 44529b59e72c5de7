"""Long measurement tables: propagation, uniqueness, pivot to wide tables, describes and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import count_if
from tidemark.operators.ordered import row_position
from tidemark.operators.quantiles import exact_quantiles, with_quantiles

SEPARATOR = "__"
DROPPED_MEASURES = ("SegId",)


class DuplicateKey(ValueError):
    """A unit carries the same (structure, measure) twice, so a pivot would have to drop a value."""


def propagate_version(
    long: DataFrame, unit: Sequence[str], version: str = "fs_version"
) -> DataFrame:
    """Version of a unit from whichever of its files declares one; a file's own version stays."""
    unit = list(unit)
    declared = F.when(F.coalesce(F.col(version), F.lit("")) != "", F.col(version))
    per_unit = long.groupBy(*unit).agg(F.min(declared).alias("_any"))
    filled = F.coalesce(declared, F.col("_any"), F.lit(""))
    return long.join(per_unit, unit, "left").withColumn(version, filled).drop("_any")


def duplicated_keys(long: DataFrame, unit: Sequence[str], key: Sequence[str] = ("structure", "measure")) -> DataFrame:
    return long.groupBy(*unit, *key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_unique(long: DataFrame, unit: Sequence[str], key: Sequence[str] = ("structure", "measure")) -> None:
    """Raise with a few examples if any unit has a key twice."""
    sample = duplicated_keys(long, unit, key).limit(5).collect()
    if sample:
        raise DuplicateKey(f"duplicate {tuple(key)} within a unit: {[r.asDict() for r in sample]}")


def with_position(long: DataFrame, unit: Sequence[str], order: Sequence[str], chunk: str | None = None) -> DataFrame:
    """0-based position of each row inside its unit's file."""
    df = long if chunk else long.withColumn("_chunk", F.lit(0))
    out = row_position(df, unit, order, "pos", chunk or "_chunk").withColumn("pos", F.col("pos") - 1)
    return out if chunk else out.drop("_chunk")


def column_plan(
    long: DataFrame, group: Sequence[str] = (), bare_names: bool = False, dropped: Sequence[str] = DROPPED_MEASURES
) -> DataFrame:
    """Column dictionary of the wide tables: name, source key, unit, rows, and `column_order` following the files.

    Identifier columns and columns NULL in every row are left out. Ordered by the mean position in the file."""
    stats = (
        long.filter(~F.col("measure").isin(*dropped))
        .groupBy(*group, "structure", "measure")
        .agg(
            F.avg("pos").alias("mean_pos"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count("value").alias("_present"),
            F.min("unit").alias("unit"),
        )
        .filter(F.col("_present") > 0)
    )
    name = F.col("structure") if bare_names else F.concat_ws(SEPARATOR, "structure", "measure")
    # a dictionary row per column: thousands of rows, whatever the size of the cohort
    order = F.row_number().over(Window.partitionBy(*group).orderBy("mean_pos", "structure", "measure"))
    return stats.select(*group, name.alias("column"), "structure", "measure", "unit", "n_rows", order.alias("column_order"))


def pivot_wide(long: DataFrame, unit: Sequence[str], plan: DataFrame, version: str | None = "fs_version") -> DataFrame:
    """One row per unit, one column per planned (structure, measure), in plan order; a unit without planned rows has NULLs.

    The dictionary, a row per column, is fetched for the column names. Then the long table is read once: a unit is one map from
    column to value and its version in one grouping. Two rows of a unit for one column raise, as a map takes a key once."""
    spark = long.sparkSession
    planned = plan.orderBy("column_order").select("column", "structure", "measure").collect()
    names = [r["column"] for r in planned]
    named = spark.createDataFrame(
        [(r["structure"], r["measure"], r["column"]) for r in planned], long.select("structure", "measure", F.lit("").alias("_column")).schema
    )
    cell = F.when(F.col("_column").isNotNull(), F.struct("_column", "value"))
    held = [F.map_from_entries(F.collect_list(cell)).alias("_cells")]
    if version is not None:
        held.append(F.min(F.when(F.col(version) != "", F.col(version))).alias(version))
    wide = long.join(F.broadcast(named), ["structure", "measure"], "left").groupBy(*unit).agg(*held)  # a dictionary, bounded by the file formats
    return wide.select(*unit, *([version] if version is not None else []), *[F.col("_cells")[n].alias(n) for n in names])


def build_wide(long: DataFrame, unit: Sequence[str], source: str, out: str, bare_sources: Sequence[str] = ()) -> DataFrame:
    """Write one wide Parquet table per source under `out` and return the column dictionary.

    Memory is bounded per source: a source is pivoted on its own, from the long table partitioned by source."""
    sources = [r[0] for r in long.select(source).distinct().orderBy(source).collect()]  # a few dozen file kinds
    dictionary = None
    for name in sources:
        part = long.filter(F.col(source) == name)
        check_unique(part, unit)
        plan = column_plan(part, bare_names=name in bare_sources)
        pivot_wide(part, unit, plan).write.mode("overwrite").option("compression", "zstd").parquet(
            f"{out}/{name.replace('/', SEPARATOR)}"
        )
        entry = plan.select(F.lit(name).alias("source"), "*")
        dictionary = entry if dictionary is None else dictionary.unionByName(entry)
    return dictionary


def describe_columns(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, sd, min, quartiles and max per column, as rows."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    long = df.select(*keys, F.inline(cells)).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    by = [*keys, "column"]
    base = long.groupBy(*by).agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), F.min("x").alias("min"), F.max("x").alias("max")
    )
    return with_quantiles(base, long, by, "x", {"q25": 0.25, "median": 0.5, "q75": 0.75})


def decile_profile(df: DataFrame, keys: Sequence[str], x: str, covered: str, bins: int = 10) -> DataFrame:
    """Coverage range over the deciles of a coordinate: largest minus smallest share covered over the bins.

    A value on an edge belongs to both of its bins, as bins include both edges."""
    keys = list(keys)
    edges = exact_quantiles(df, keys, x, {f"e{i}": i / bins for i in range(bins + 1)})
    packed = edges.select(*keys, F.array(*[f"e{i}" for i in range(bins + 1)]).alias("_edges"))
    hit = df.filter(F.col(x).isNotNull()).join(packed, keys)
    inside = F.filter(
        F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: (F.col(x) >= F.get("_edges", i)) & (F.col(x) <= F.get("_edges", i + 1))
    )
    per_bin = (
        hit.select(*keys, covered, F.explode(inside).alias("_bin"))
        .groupBy(*keys, "_bin")
        .agg((count_if(F.col(covered)) / F.count(F.lit(1))).alias("_f"))
    )
    return per_bin.groupBy(*keys).agg(
        (F.max("_f") - F.min("_f")).alias("coverage_range"), F.min("_f").alias("min_coverage"), F.max("_f").alias("max_coverage")
    )
