"""Long and wide statistics tables over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import micros
from tidemark.operators import statistics as ST
from tidemark.plans.records_queries import scratch
from tidemark.plans.registry import query, rounded
from tidemark.sources import stats_text as X
from tidemark.sources import wide_runs as R

_LONG = """
    WITH long AS (SELECT l_orderkey, l_linestatus AS structure, 'm' || l_linenumber AS measure, AVG(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END) AS value,
                         CAST(MIN(l_partkey) AS DOUBLE) AS pos, CASE WHEN l_linestatus = 'F' AND l_orderkey % 2 = 0 THEN 'v7' ELSE '' END AS fs_version FROM lineitem GROUP BY ALL)"""


def _long(t):
    n = F.col("l_linenumber")
    version = F.when((F.col("l_linestatus") == "F") & (F.col("l_orderkey") % 2 == 0), "v7").otherwise("")
    return t.lineitem.groupBy(
        "l_orderkey", F.col("l_linestatus").alias("structure"), F.concat(F.lit("m"), n.cast("string")).alias("measure"), version.alias("fs_version")
    ).agg(
        F.avg(F.when(n != 7, F.col("l_quantity"))).alias("value"), F.min("l_partkey").cast("double").alias("pos"), F.lit("u").alias("unit")
    )


@query(
    "a28_version_propagation",
    _LONG
    + """ SELECT l_orderkey, structure, measure, ROUND(value, 6) AS value, COALESCE(NULLIF(fs_version, ''), MIN(NULLIF(fs_version, '')) OVER (PARTITION BY l_orderkey), '') AS fs_version FROM long""",
)
def version_propagation(t):
    out = ST.propagate_version(_long(t), ["l_orderkey"])
    return rounded(out.select("l_orderkey", "structure", "measure", "value", "fs_version"), 6)


@query(
    "a29_duplicate_keys",
    """SELECT l_orderkey, l_linestatus AS structure, l_linenumber AS measure, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
)
def duplicate_keys(t):
    raw = t.lineitem.select("l_orderkey", F.col("l_linestatus").alias("structure"), F.col("l_linenumber").alias("measure"))
    return ST.duplicated_keys(raw, ["l_orderkey"])


@query(
    "a30_column_plan",
    _LONG
    + """,
    s AS (SELECT structure, measure, AVG(pos) AS mean_pos, COUNT(*) AS n_rows, COUNT(value) AS present FROM long GROUP BY ALL)
    SELECT structure || '__' || measure AS "column", structure, measure, 'u' AS unit, n_rows, ROW_NUMBER() OVER (ORDER BY mean_pos, structure, measure) AS column_order FROM s WHERE present > 0""",
)
def column_plan(t):
    return ST.column_plan(_long(t))


@query(
    "a30_wide_table",
    _LONG
    + " SELECT l_orderkey, MIN(NULLIF(fs_version, '')) AS fs_version, "
    + ", ".join(
        f"ROUND(MAX(CASE WHEN structure = '{s}' AND measure = 'm{n}' THEN value END), 6) AS {s}__m{n}" for s in "FO" for n in range(1, 7)
    )
    + " FROM long GROUP BY l_orderkey",
)
def wide_table(t):
    """The column dictionary is computed first (a dozen rows), then every unit is one row of the pivot."""
    long = _long(t)
    return rounded(ST.pivot_wide(long, ["l_orderkey"], ST.column_plan(long)), 6)


@query(
    "a25_describe_columns",
    """
    WITH l AS (SELECT 'l_quantity' AS "column", l_quantity AS x FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem)
    SELECT "column", COUNT(x) AS n, ROUND(AVG(x), 6) AS mean, ROUND(STDDEV_SAMP(x), 6) AS sd, MIN(x) AS min, MAX(x) AS max, ROUND(QUANTILE_CONT(x, 0.25), 6) AS q25,
           ROUND(QUANTILE_CONT(x, 0.5), 6) AS median, ROUND(QUANTILE_CONT(x, 0.75), 6) AS q75 FROM l GROUP BY "column" """,
)
def describe_columns(t):
    return rounded(ST.describe_columns(t.lineitem, ["l_quantity", "l_discount", "l_extendedprice"]), 6)


def _stats_files(t):
    """A statistics text per order, put together by Spark from its lines (at most a few dozen per order)."""
    row = F.format_string("%d %s-%d %.2f nan", "l_linenumber", "l_returnflag", "l_partkey", "l_extendedprice")
    order = F.col("l_orderkey")
    body = t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("rows"))
    head = F.concat_ws(
        "\n",
        F.lit("# fs_version 7.4"),
        F.format_string("# Measure Brain, BrainVol, Volume, with a comma, %d, mm^3", order),
        F.lit("# TableCol  3 ColHeader Volume_mm3"),
        F.lit("# TableCol  3 Units     mm^3"),
        F.lit("# ColHeaders Index StructName Volume_mm3 Mean"),
    )
    return body.select(
        "l_orderkey", F.concat_ws("\n", head, "rows").alias("text"), F.concat(order.cast("string"), F.lit(".stats")).alias("name")
    )


@query(
    "s15_statistics_text",
    """
    SELECT l_orderkey, 'Brain' AS structure, 'BrainVol' AS measure, CAST(l_orderkey AS DOUBLE) AS value, 'mm^3' AS unit, '7.4' AS fs_version, 1 AS n FROM lineitem GROUP BY l_orderkey
    UNION ALL SELECT l_orderkey, l_returnflag || '-' || l_partkey, 'Volume_mm3', MAX(l_extendedprice), 'mm^3', '7.4', COUNT(*) FROM lineitem GROUP BY ALL
    UNION ALL SELECT l_orderkey, l_returnflag || '-' || l_partkey, 'Mean', NULL, '', '7.4', COUNT(*) FROM lineitem GROUP BY ALL""",
)
def statistics_text(t):
    long = X.parse_all(_stats_files(t), ["l_orderkey"], "name")
    return long.groupBy("l_orderkey", "structure", "measure", "unit", "fs_version").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("n"))


@query(
    "s16_stable_shards",
    """
    WITH crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
    u AS (SELECT 'sub-' || l_orderkey AS unit, COUNT(*) AS n, SUM(l_extendedprice) AS total FROM lineitem GROUP BY l_orderkey),
    h AS (SELECT u.*, xor(list_reduce([4294967295] || list_transform(string_split(unit, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1])), 4294967295) % 16 AS shard FROM u, crc)
    SELECT shard, COUNT(*) AS n_units, CAST(SUM(n) AS BIGINT) AS n_rows, ROUND(SUM(total), 2) AS total FROM h GROUP BY shard""",
)
def stable_shards(t):
    """Line items as long rows of units, written as 16 shards and read back; the SQL has CRC-32 bit by bit."""
    rows = t.lineitem.select(F.concat(F.lit("sub-"), F.col("l_orderkey").cast("string")).alias("unit"), "l_extendedprice")
    path = scratch(t, "s16")
    X.write_shards(rows, "unit", 16, path)
    back = t.spark.read.schema("unit string, l_extendedprice double, shard string").parquet(path)
    out = back.groupBy(F.col("shard").cast("long").alias("shard"))
    return rounded(out.agg(F.countDistinct("unit").alias("n_units"), F.count(F.lit(1)).alias("n_rows"), F.sum("l_extendedprice").alias("total")), 2)


@query(
    "s17_listed_tables",
    """
    WITH f AS (SELECT l_suppkey, l_partkey, COUNT(*) AS n, MAX(l_extendedprice) AS value FROM lineitem GROUP BY ALL)
    SELECT l_suppkey AS supplier, 'part-' || l_partkey AS structure, n, value, CAST(1 AS BIGINT) AS n_files, TRUE AS listed FROM f""",
)
def listed_tables(t):
    """A volume table per supplier, written as a file, listed without its content, then read whole and parsed."""
    row = F.format_string("part-%d %.2f", "l_partkey", "l_extendedprice")
    texts = t.lineitem.groupBy(F.col("l_suppkey").alias("supplier")).agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("text"))
    root = scratch(t, "s17")
    texts.select("text", "supplier").hint("rebalance", F.col("supplier")).write.partitionBy("supplier").text(root)
    supplier = F.regexp_extract("path", "/supplier=([0-9]+)/", 1).cast("long").alias("supplier")
    files = X.list_files(t.spark, root).select(supplier, "size").groupBy("supplier").agg(F.count(F.lit(1)).alias("n_files"), (F.min("size") > 0).alias("listed"))
    named = X.read_texts(t.spark, root).select(supplier, "text", F.element_at(F.split("path", "/"), -1).alias("name"))
    long = X.parse_all(named, ["supplier"], "name").groupBy("supplier", "structure").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))
    return long.join(files, "supplier")


@query(
    "s17_complete_units",
    """
    WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN '_complete.json' ELSE 'stats/' || l_returnflag || '.stats' END AS f FROM lineitem)
    SELECT l_orderkey || '/' || l_linenumber || '/' || f AS path FROM l WHERE f <> '_complete.json' AND (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM l WHERE f = '_complete.json')""",
)
def complete_units(t):
    flag = F.col("l_returnflag")
    name = F.when(flag == "A", X.COMPLETE_MARKER).otherwise(F.concat(F.lit("stats/"), flag, F.lit(".stats")))
    listing = t.lineitem.select(F.concat_ws("/", "l_orderkey", "l_linenumber", name).alias("path")).distinct()
    return X.complete_files(listing).select("path")


@query(
    "s13_numbered_runs",
    """
    WITH g AS (SELECT l_orderkey, l_linenumber AS run_index, MAX(l_partkey) AS uid, CAST(MAX(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS INTEGER) AS indicator,
                      CASE WHEN MAX(l_tax) <= 0.06 THEN 1 END AS comp, MIN(l_quantity) >= 10 AND MAX(l_discount) < 0.09 AS field_map_passes, MAX(l_shipdate) AS d FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, run_index, uid, indicator, indicator = 1 AND comp = 1 AS usable, field_map_passes,
           epoch_us(d) // 86400000000 * 86400000000 + CASE WHEN run_index % 2 = 0 THEN 36642250000 ELSE 36642000000 END AS acquired_us FROM g""",
)
def numbered_runs(t):
    """The numbered-column table is pivoted from the lines, written as a delimited file with two spellings of the time and `n/a` for
    what is missing, and read back into one row per run."""
    n = F.col("l_linenumber")
    day = F.max("l_shipdate")
    by_run = t.lineitem.groupBy("l_orderkey", n).agg(
        F.max("l_partkey").alias("__series_uid"),
        F.max(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("_indicator"),
        F.when(n % 2 == 0, F.date_format(day, "yyyyMMdd")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("__study_dt"),
        F.when(n % 2 == 0, "101042.25").otherwise("10:10:42").alias("__series_t"),
        F.lit(1).alias("__protcom_indicator"),
        F.when(F.max("l_tax") <= 0.06, "1").otherwise("n/a").alias("__comp_indicator"),
        F.when(F.min("l_quantity") >= 10, 1).otherwise(0).alias("__fm__fm_indicator"),
        F.when(F.max("l_discount") >= 0.09, 1).otherwise(0).alias("__fm__invalid_indicator"),
    )
    by_run = by_run.withColumnRenamed("__fm__fm_indicator", "__fm_indicator").withColumns({f"__fm__{c}_indicator": F.lit(1) for c in ("protcom", "comp")})
    fields = [c for c in by_run.columns if c.startswith("_")]
    wide = by_run.groupBy("l_orderkey").agg(
        *[F.max(F.when(n == i, F.col(c))).cast("string").alias(f"mr_y_qc__raw__rsfmri__r0{i}{c}") for i in range(1, 8) for c in fields]
    )
    path = scratch(t, "s13")
    wide.write.csv(path, sep="\t", header=True)
    long = R.runs_to_long(R.read_wide(t.spark, path), ("l_orderkey",), "rsfmri")
    return long.select(
        F.col("l_orderkey").cast("long").alias("l_orderkey"), "run_index", F.col("uid").cast("long").alias("uid"), "indicator",
        R.usable().alias("usable"), R.field_map_passes().alias("field_map_passes"), micros("acquired").alias("acquired_us"),
    )
