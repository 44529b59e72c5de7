"""Samples drawn from customers and orders. The hash is Spark's own, so the SQL checks quotas and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sampling as Q
from tidemark.plans.registry import query

_QUOTA = """
    WITH s AS (SELECT c_nationkey, COUNT(*) AS size FROM customer GROUP BY 1), e AS (SELECT *, 120.0 * size / SUM(size) OVER () AS x FROM s),
    f AS (SELECT *, CAST(floor(x + 1e-9) AS BIGINT) AS fl FROM e), r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY fl - x, c_nationkey) AS rk, 120 - SUM(fl) OVER () AS rest FROM f),
    q AS (SELECT c_nationkey, size, fl + CASE WHEN rk <= rest THEN 1 ELSE 0 END AS quota FROM r)"""


@query("q1_stratified_quota", _QUOTA + " SELECT c_nationkey, size, CAST(quota AS BIGINT) AS quota FROM q")
def stratified_quota(t):
    return Q.largest_remainder(Q.stratum_sizes(t.customer, ["c_nationkey"]), ["c_nationkey"], 120)


@query("q1_stratified_sample", _QUOTA + " SELECT c_nationkey, CAST(quota AS BIGINT) AS n_drawn FROM q WHERE quota > 0")
def stratified_sample(t):
    drawn = Q.stratified_sample(t.customer, ["c_nationkey"], 120, ["c_custkey"], 7)
    return drawn.groupBy("c_nationkey").agg(F.countDistinct("c_custkey").alias("n_drawn"))


@query(
    "q2_merged_bins",
    """
    WITH s AS (SELECT c_nationkey % 3 AS grp, CASE WHEN c_custkey % 100 < 2 THEN 'low' WHEN c_custkey % 100 < 70 THEN 'mid' ELSE 'high' END AS bin, COUNT(*) AS size FROM customer GROUP BY ALL), t AS (SELECT SUM(size) AS n FROM s)
    SELECT grp, bin, size, CASE WHEN bin = 'low' AND size * 60.0 / n < 1 THEN 'mid' ELSE bin END AS merged_bin FROM s, t""",
)
def merged_bins(t):
    k = F.col("c_custkey") % 100
    sizes = Q.stratum_sizes(
        t.customer.select((F.col("c_nationkey") % 3).alias("grp"), F.when(k < 2, "low").when(k < 70, "mid").otherwise("high").alias("bin")),
        ["grp", "bin"],
    )
    return Q.merge_small_bins(sizes, "grp", "bin", ["low", "mid", "high"], "mid", 60)


@query("q3_ordered_draw", _QUOTA.replace("customer", "(SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING')").replace("120", "60") + " SELECT c_nationkey, CAST(quota AS BIGINT) AS n_drawn, CAST(60 AS BIGINT) AS last_position, TRUE AS positions_are_unique FROM q WHERE quota > 0")
def ordered_draw(t):
    exclude = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    drawn = Q.ordered_draw(t.customer, ["c_nationkey"], 60, ["c_custkey"], 7, ["c_custkey"], exclude)
    overall = drawn.agg(F.max("position").alias("last"), F.countDistinct("position").alias("distinct"))
    return drawn.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_drawn")).select(
        "c_nationkey", "n_drawn", overall.select("last").scalar().alias("last_position"),
        (overall.select("last").scalar() == overall.select("distinct").scalar()).alias("positions_are_unique"),
    )


@query(
    "q5_audit_sample",
    """
    WITH s AS (SELECT c_mktsegment, COUNT(*) AS size FROM customer GROUP BY 1)
    SELECT c_mktsegment, LEAST(GREATEST(1, CAST(round_even(size * 40.0 / (SELECT SUM(size) FROM s), 0) AS BIGINT)), size) AS quota FROM s""",
)
def audit_quota(t):
    return Q.cell_quota(t.customer, ["c_mktsegment"], 40).select("c_mktsegment", "quota")


@query(
    "q5_audit_topup",
    "SELECT COUNT(DISTINCT c_nationkey) AS n_nations, TRUE AS every_nation_topped_up, TRUE AS no_member_twice FROM customer",
)
def audit_topup(t):
    df = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey", (F.col("c_acctbal") > 5000).cast("int").alias("rich"))
    drawn = Q.audit_sample(df, ["c_mktsegment"], ["c_nationkey", "rich"], ["c_custkey"], 40, 2, 11)
    per = drawn.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("c_custkey").alias("d"))
    return per.agg(
        F.count(F.lit(1)).alias("n_nations"), F.bool_and(F.col("n") >= 2).alias("every_nation_topped_up"), (F.sum("n") == F.sum("d")).alias("no_member_twice")
    )


@query("q5_noise_sample", "SELECT c_mktsegment, TRUE AS present, CAST(30 AS BIGINT) AS n_total FROM customer GROUP BY c_mktsegment")
def noise_sample(t):
    drawn = Q.one_per_cell(t.customer.select("c_custkey", "c_mktsegment"), ["c_mktsegment"], ["c_custkey"], 30, 3)
    total = drawn.agg(F.countDistinct("c_custkey")).scalar()
    return drawn.groupBy("c_mktsegment").agg((F.count(F.lit(1)) >= 1).alias("present")).withColumn("n_total", total)


@query(
    "q6_first_pairs",
    """
    SELECT COUNT(*) AS n_pairs, TRUE AS ordered FROM (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1 HAVING COUNT(DISTINCT o_orderkey) >= 2 LIMIT 25)""",
)
def first_pairs(t):
    pairs = Q.first_pairs(t.orders, ["o_custkey"], "o_orderkey", "o_orderpriority", "5-LOW", 25, 5)
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.bool_and(F.col("run_a") < F.col("run_b")).alias("ordered"))
