"""Wide delimited tables with numbered run columns, and CSV export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.predicates import tolerant_datetime

# ---- fixed values: column naming of the run tables --------------------------------------------------------------
RUN_COLUMN_PATTERN = r"^mr_y_qc__raw__([a-z0-9_]+?)__r(\d\d)(_.*)$"
MISSING = ("", "n/a", "NA")
RUN_FIELDS = {
    "uid": "__series_uid", "study_dt": "__study_dt", "series_t": "__series_t", "indicator": "_indicator",
    "protcom": "__protcom_indicator", "comp": "__comp_indicator", "fm_indicator": "__fm_indicator",
    "fm_protcom": "__fm__protcom_indicator", "fm_comp": "__fm__comp_indicator", "fm_invalid": "__fm__invalid_indicator",
    "fm_missing": "__fm__mssng_indicator", "fm_wrongloc": "__fm__wrngloc_indicator",
}
# ---- end of fixed values ----------------------------------------------------------------------------------------


def read_wide(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """All columns as text: a type guess would need a second pass and could turn labels into numbers."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=False)


def _value(name: str):
    text = F.trim(F.coalesce(F.col(f"`{name}`"), F.lit("")))
    return F.when(~text.isin(*MISSING), text)


def runs_to_long(wide: DataFrame, ids: tuple[str, ...], table: str, fields: Mapping[str, str] = RUN_FIELDS) -> DataFrame:
    """One row per unit and numbered run that has a series UID; flags as integers, acquisition time parsed.

    Each unit's row becomes an array of run structs and is exploded: no regrouping, hence no shuffle."""
    import re

    numbered: dict[int, dict[str, str]] = {}
    for name in wide.columns:
        m = re.match(RUN_COLUMN_PATTERN, name)
        if m and m.group(1) == table:
            numbered.setdefault(int(m.group(2)), {})[m.group(3)] = name
    if not numbered:
        raise ValueError(f"no run columns of table {table!r}")
    structs = []
    for n, columns in sorted(numbered.items()):
        values = {out: (_value(columns[suffix]) if suffix in columns else F.lit(None).cast("string")) for out, suffix in fields.items()}
        structs.append(F.struct(F.lit(n).alias("run_index"), *[v.alias(k) for k, v in values.items()]))
    long = wide.select(*ids, F.inline(F.array(*structs))).filter(F.col("uid").isNotNull())
    flags = [f for f in fields if f not in ("uid", "study_dt", "series_t")]
    out = long.select(
        *ids, F.lit(table).alias("table"), "run_index", "uid",
        tolerant_datetime("study_dt", "series_t").alias("acquired") if "study_dt" in fields else F.lit(None).cast("timestamp").alias("acquired"),
        *[F.col(f).try_cast("double").cast("int").alias(f) for f in flags],
    )
    return out


def usable():
    """The run's own three indicators are all 1."""
    return (F.col("indicator") == 1) & (F.col("protcom") == 1) & (F.col("comp") == 1)


def field_map_passes():
    """The attached field map's three indicators are 1 and it is not marked invalid."""
    return (F.col("fm_indicator") == 1) & (F.col("fm_protcom") == 1) & (F.col("fm_comp") == 1) & (F.col("fm_invalid") == 0)


def scoped_tables(
    tables: Mapping[str, DataFrame], subjects: DataFrame, dates: Mapping[str, str], first: str | None = None, last: str | None = None
) -> dict[str, DataFrame]:
    """Tables restricted to a batch: rows of its subjects, and between `first` and `last` (inclusive days) of the column that
    `dates` names for a table. The list of subjects joins by its key; it never becomes a literal in a query."""
    units = subjects.select("subject").distinct()
    out = {}
    for name, df in tables.items():
        day = dates.get(name)
        if day and first:
            df = df.filter(F.col(day) >= first)
        if day and last:
            df = df.filter(F.col(day) <= last)
        out[name] = df.join(units, "subject", "left_semi").select(*df.columns)
    return out


def export_csv(tables: Mapping[str, DataFrame], out: str) -> dict[str, str]:
    """One CSV folder with header per table. Written by the tasks, part by part; nothing is gathered on the driver."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").csv(paths[name], header=True)
    return paths
