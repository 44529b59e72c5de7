"""Sharding by balanced label propagation: linked documents move together under quotas, then counts are made exact."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, measured, row_view

#: Rows that one ordered chunk of a shard holds about.
CHUNK_ROWS = 50_000


def at_shard(values: list, shard: str = "shard") -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.col(shard) + 1)


def node_table(docs: DataFrame, shards: int, id_col: str, text_col: str) -> DataFrame:
    """(row, _id, size, text_crc32, hub, shard): one narrow row per document; texts are read once and not moved.

    `row` numbers rows uniquely, also repeated ones. Equal texts share a hub. A document starts in the shard of its id's hash.
    """
    view = row_view(docs, id_col, text_col)
    text = F.coalesce(F.col("_text"), F.lit(""))
    return view.select(
        F.monotonically_increasing_id().alias("row"),
        "_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text, F.octet_length(text)).alias("hub"),
        F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(shards)).cast("int").alias("shard"),
    )


def split_hubs(nodes: DataFrame, most: int) -> DataFrame:
    """Hubs with more than `most` documents become several, each by a hash of the row; documents of no hub have null.

    A hub of a third of all rows cannot fit into one shard, so it moves in parts that do. Where a part still has more than
    CHUNK_ROWS documents, `salt` (0 to `salts` - 1) divides it for joins and numbering, so no key is larger than that. Hubs
    above either size are told by their counts first (there are at most rows / size of them) and do not meet the join that
    finds the smaller ones.
    """
    sizes = cut_lineage(nodes.groupBy("hub").agg(F.count("*").alias("n")).filter("n > 1"))
    heavy = F.col("n") > min(most, CHUNK_ROWS)
    names = [c for c in nodes.columns if c != "hub"]
    met = nodes.join(measured(sizes.filter(heavy)), "hub", "left")
    parts = F.ceil(F.col("n") / most)
    salts = F.ceil(F.col("n") / parts / CHUNK_ROWS)
    crowd = met.filter("n is not null").select(
        *names, F.xxhash64("hub", F.pmod(F.xxhash64("row"), parts)).alias("hub"), salts.alias("salts"), F.pmod(F.xxhash64("row", F.lit(1)), salts).alias("salt")
    )
    light = met.filter("n is null").drop("n").join(sizes.filter(~heavy), "hub", "left")
    light = light.select(*names, F.when(F.col("n").isNotNull(), F.col("hub")).alias("hub"), F.lit(1).cast("long").alias("salts"), F.lit(0).cast("long").alias("salt"))
    return crowd.unionByName(light)


def propagate(nodes: DataFrame, shards: int, rows: int, rounds: int, slack: float) -> DataFrame:
    """`nodes` with the shards of the last round: each round a hub asks for the shard that most of its documents are in.

    Loads and wishes are counted per shard (as many rows as shards reach the driver). Where more rows want to enter a shard
    than its quota, rows / shards x (1 + slack), and those who want to leave give room for, hubs are admitted by a hash of hub
    and round, whole, in that share. Ends early when nobody wants to move.
    """
    quota = rows / shards * (1 + slack)
    alone = nodes.filter("hub is null")
    linked = cut_lineage(nodes.filter("hub is not null"))
    still = {r["shard"]: r["n"] for r in alone.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    for turn in range(rounds):
        votes = linked.groupBy("hub", "shard").agg(F.count("*").alias("n"), F.max("salts").alias("salts"))
        # equal votes: by a hash, so that hubs do not all prefer the same shard
        vote = F.struct("n", F.xxhash64("hub", "shard").alias("tie"), "shard")
        wants = votes.groupBy("hub").agg(F.max(vote)["shard"].alias("want"), F.max("salts").alias("n_salts"))
        wants = wants.select("hub", "want", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_salts") - 1)).alias("salt"))
        wished = cut_lineage(linked.join(wants, ["hub", "salt"]))
        flows = wished.groupBy("shard", "want").agg(F.count("*").alias("n")).collect()
        moving = [r for r in flows if r["shard"] != r["want"]]
        if not moving:
            return nodes.filter("hub is null").unionByName(linked)
        load = [still.get(s, 0) + sum(r["n"] for r in flows if r["shard"] == s) for s in range(shards)]
        enter = [sum(r["n"] for r in moving if r["want"] == s) for s in range(shards)]
        leave = [sum(r["n"] for r in moving if r["shard"] == s) for s in range(shards)]
        share = [min(1.0, max(0.0, quota - load[s] + leave[s]) / max(enter[s], 1)) for s in range(shards)]
        drawn = F.pmod(F.xxhash64("hub", F.lit(turn)), F.lit(1_000_000)) / 1_000_000
        admitted = drawn < at_shard(share, "want")
        linked = wished.withColumn("shard", F.when(admitted, F.col("want")).otherwise(F.col("shard"))).drop("want")
    return alone.unionByName(cut_lineage(linked))


def even_out(nodes: DataFrame, shards: int, rows: int) -> DataFrame:
    """`nodes` with counts per shard at most one apart, and `slot`, gapless from 0 in each shard.

    Rows of a shard are numbered in chunks of about CHUNK_ROWS: linked ones first, hubs together, then the single ones. Numbers
    at or over the shard's even count move to the free places of other shards in order; so single documents go first.
    """
    chunks = max(1, -(-rows // (shards * CHUNK_ROWS)))
    chunk = F.when(F.col("hub").isNull(), F.pmod(F.xxhash64("row"), F.lit(chunks)) + chunks).otherwise(
        F.pmod(F.xxhash64("hub", "salt", F.lit(1)), F.lit(chunks))
    )
    nodes = nodes.withColumn("chunk", chunk)
    counts = cut_lineage(nodes.groupBy("shard", "chunk").agg(F.count("*").alias("n")))
    before = F.expr("sum(n) over (partition by shard order by chunk) - n")
    starts = counts.select("shard", "chunk", before.alias("before"))
    loads = {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    load = [loads.get(s, 0) for s in range(shards)]
    even = [rows // shards + (s < rows % shards) for s in range(shards)]
    over = [max(0, a - b) for a, b in zip(load, even, strict=True)]
    free = [max(0, b - a) for a, b in zip(load, even, strict=True)]
    over_before = [0, *accumulate(over)][:-1]
    free_until = list(accumulate(free))
    numbered = nodes.join(measured(starts), ["shard", "chunk"])
    number = F.expr("before + row_number() over (partition by shard, chunk order by hub, row) - 1")
    numbered = numbered.withColumn("number", number)
    moves = F.col("number") >= at_shard(even)
    order = F.col("number") - at_shard(even) + at_shard(over_before)
    ends = F.array(*(F.lit(x) for x in free_until))
    target = F.size(F.filter(ends, lambda e: e <= F.col("order")))
    numbered = numbered.withColumn("order", F.when(moves, order)).withColumn("to", F.when(moves, target).cast("int"))
    place = at_shard(load, "to") + F.col("order") - at_shard([u - f for u, f in zip(free_until, free, strict=True)], "to")
    return numbered.select(
        "row",
        "_id",
        "size",
        "text_crc32",
        "hub",
        F.coalesce("to", "shard").alias("shard"),
        F.when(moves, place).otherwise(F.col("number")).cast("long").alias("slot"),
    )


def balanced_shards(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", rounds: int = 6, slack: float = 0.05
) -> DataFrame:
    """(id_col, size, text_crc32, hub, shard, slot), one row per row of `docs`; counts per shard differ by one at most.

    Links join documents of equal text (through a hub, never pair by pair). Null text counts as empty: 16 bytes, crc 0.
    Null ids start in one shard and are evened out; repeated rows are rows of their own. No rows: no rows.
    """
    nodes = cut_lineage(node_table(docs, shards, id_col, text_col))
    rows = nodes.count()
    nodes = cut_lineage(split_hubs(nodes, max(2, rows // (4 * shards))))
    moved = propagate(nodes, shards, rows, rounds, slack)
    return even_out(cut_lineage(moved), shards, rows).drop("row").withColumnRenamed("_id", id_col)
