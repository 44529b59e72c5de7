"""Interval and timeline reports over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import day, micros
from tidemark.operators import intervals as I
from tidemark.operators.costs import share_of_total
from tidemark.operators.ordered import DAY_US, next_value, previous_value, row_position, running_sum, time_chunk
from tidemark.plans.registry import query, rounded

_IV = """
    WITH iv AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS s, epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 18000000 AS e,
                       CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)"""


def _intervals(t):
    start = micros("ts")
    return t.events.select(
        "event_id", "user_id", "event_type", start.alias("s"),
        (start + F.round(F.col("value") * 100).cast("long") * 18000000).alias("e"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


@query(
    "w5_interval_union",
    _IV
    + """,
    o AS (SELECT *, MAX(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM iv WHERE e > s),
    i AS (SELECT *, SUM(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM o)
    SELECT user_id, CAST(SUM(len) AS BIGINT) AS union_us FROM (SELECT user_id, island, MAX(e) - MIN(s) AS len FROM i GROUP BY ALL) GROUP BY user_id""",
)
def interval_union(t):
    return I.union_length(_intervals(t), ["user_id"], "s", "e")


@query(
    "w6_concurrency_shares",
    _IV
    + """,
    pts AS (SELECT DISTINCT user_id, p FROM (SELECT user_id, s AS p FROM iv WHERE e > s UNION ALL SELECT user_id, e FROM iv WHERE e > s)),
    seg AS (SELECT user_id, p AS a, LEAD(p) OVER (PARTITION BY user_id ORDER BY p) AS b FROM pts),
    act AS (SELECT seg.user_id, a, b, COUNT(*) AS n FROM seg JOIN iv ON iv.user_id = seg.user_id AND s <= a AND e >= b WHERE b IS NOT NULL GROUP BY ALL)
    SELECT iv.event_id, ROUND(COALESCE(SUM((b - a) / n), 0) / 1000000.0, 3) AS share_s FROM iv LEFT JOIN act ON act.user_id = iv.user_id AND iv.s <= a AND iv.e >= b AND iv.e > iv.s GROUP BY iv.event_id""",
)
def concurrency_shares(t):
    out = I.concurrency_shares(_intervals(t), ["user_id"], ["event_id"], "s", "e")
    return out.select("event_id", F.round(F.col("share_us") / 1000000.0, 3).alias("share_s"))


@query(
    "w7_node_occupancy",
    _IV
    + """
    SELECT a.event_id, ROUND(SUM(CASE WHEN b.event_id <> a.event_id THEN b.k * (LEAST(a.e, b.e) - GREATEST(a.s, b.s)) ELSE 0 END) / (a.e - a.s) / 400, 6) AS occupied_frac
    FROM iv a JOIN iv b ON a.user_id = b.user_id AND b.s < a.e AND b.e > a.s WHERE a.event_type = 'purchase' AND a.e > a.s AND b.e > b.s GROUP BY a.event_id, a.e, a.s""",
)
def node_occupancy(t):
    pods = _intervals(t)
    targets = pods.filter(F.col("event_type") == "purchase").withColumn("capacity", F.lit(400.0))
    out = I.occupied_fraction(pods, targets, ["user_id"], ["event_id"], "s", "e", "k", "capacity")
    return rounded(out.select("event_id", "occupied_frac"), 6)


@query(
    "w11_day_share",
    _IV
    + """,
    d AS (SELECT *, epoch_us(TIMESTAMP '2024-01-15') AS d0, epoch_us(TIMESTAMP '2024-01-16') AS d1 FROM iv)
    SELECT event_id, ROUND(CASE WHEN s >= d1 OR e <= d0 THEN 0 WHEN e > s THEN (LEAST(e, d1) - GREATEST(s, d0)) / (e - s) ELSE 1 END, 6) AS fraction,
           ROUND(CASE WHEN s >= d1 OR e <= d0 THEN 0 ELSE (LEAST(e, d1) - GREATEST(s, d0)) / 60000000 END, 4) AS minutes FROM d""",
)
def day_share(t):
    fraction, minutes = I.day_share("s", "e", F.lit(1705276800000000))
    return rounded(_intervals(t).select("event_id", fraction.alias("fraction"), minutes.alias("minutes")), 6, minutes=4)


@query(
    "w12_first_complete_sighting",
    """
    SELECT user_id, d, finished, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, d ORDER BY finished IS NOT NULL DESC, event_id) AS rn
        FROM (SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS d, CASE WHEN value > 40 THEN epoch_us(ts) END AS finished FROM events)) WHERE rn = 1""",
)
def first_complete_sighting(t):
    seen = t.events.select(
        "event_id", "user_id", day("ts").alias("d"), F.when(F.col("value") > 40, micros("ts")).alias("finished")
    )
    return I.first_complete_sighting(seen, ["user_id", "d"], "finished", ["event_id"]).select("user_id", "d", "finished", "event_id")


@query(
    "w3_share_of_total",
    "SELECT event_type, ROUND(SUM(value), 4) AS total, ROUND(SUM(value) * 100.0 / SUM(SUM(value)) OVER (), 6) AS pct FROM events GROUP BY event_type",
)
def share_total(t):
    grouped = t.events.groupBy("event_type").agg(F.sum("value").alias("total"))
    return rounded(share_of_total(grouped, "total", "pct"), 6, total=4)


@query(
    "w4_rows_per_object",
    "SELECT event_id, path, COUNT(*) OVER (PARTITION BY path) AS rows_in_object FROM (SELECT event_id, dt || '/' || session AS path FROM records)",
)
def rows_per_object(t):
    rows = t.records.select("event_id", F.concat_ws("/", "dt", "session").alias("path"))
    return rows.join(rows.groupBy("path").agg(F.count(F.lit(1)).alias("rows_in_object")), "path")


@query(
    "w10_mean_position",
    """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(AVG(pos), 6) AS mean_pos FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos FROM lineitem)
    GROUP BY ALL""",
)
def mean_position(t):
    from tidemark.operators.statistics import with_position

    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    placed = with_position(li, ["l_orderkey"], order, chunk="l_linenumber")
    return rounded(
        placed.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.avg("pos").alias("mean_pos")), 6
    )


@query(
    "w_timeline_neighbours",
    """
    SELECT event_id, LAG(value) OVER w AS prev_value, LEAD(value) OVER w AS next_value, ROW_NUMBER() OVER w AS pos,
           CAST(SUM(CAST(round(value * 100) AS BIGINT)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_cents
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def timeline_neighbours(t):
    """Neighbours, position and running total of every event, with each user's timeline split into days."""
    line = t.events.select("event_id", "user_id", "value", micros("ts").alias("us"))
    line = line.withColumn("chunk", time_chunk("us", DAY_US))
    keys, order = ["user_id"], ["us", "event_id"]
    out = previous_value(line, keys, order, F.col("value"), "prev_value", "chunk")
    out = next_value(out, keys, order, F.col("value"), "next_value", "chunk")
    out = row_position(out, keys, order, "pos", "chunk")
    out = running_sum(out, keys, order, F.round(F.col("value") * 100).cast("long"), "running_cents", "chunk")
    return out.select("event_id", "prev_value", "next_value", "pos", "running_cents")
