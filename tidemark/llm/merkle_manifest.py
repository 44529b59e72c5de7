"""Merkle manifest of a dataset: ternary trees per source and over sources, inclusion proofs by pointer jumping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut_lineage, measured

#: Consecutive nodes under one parent.
ARITY = 3
#: Levels that one grouping climbs: at most ARITY ** LEVELS nodes meet in one row.
LEVELS = 4
BLOCK = ARITY**LEVELS
#: The tree over sources; source trees are numbered from 0.
TOP = -1
#: Ancestor rows up to which a round of jumps broadcasts them. More of them means that few nodes share an ancestor.
NEAR_ROWS = 20_000


def encoded(value: Column, as_text: bool = True) -> Column:
    """`-` for null, else the number of UTF-8 bytes, `:` and the value."""
    text = value if as_text else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*fields), 256))


def digest(parts: Column) -> Column:
    """SHA-256 of the concatenated hex texts of an array of binary digests."""
    return F.unhex(F.sha2(F.array_join(F.transform(parts, lambda d: F.lower(F.hex(d))), ""), 256))


def places(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `pos`, the place from 0 within `group` in `order`: sorted by ranges, so a hot group spreads over many
    tasks; only (range, group) counts are ordered per group. Null groups and values come first."""
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    spread = cut_lineage(spread).withColumn("_at", F.monotonically_increasing_id())
    spread = spread.withColumn("_part", F.shiftright("_at", 33))
    firsts = spread.groupBy("_part", F.col(group).alias("_group")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    over = "sum(_n) OVER (PARTITION BY _group ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    firsts = firsts.withColumn("_before", F.coalesce(F.expr(over), F.lit(0)))
    firsts = measured(firsts.select(F.col("_part").alias("_p"), "_group", "_first", "_before"))
    met = spread.join(firsts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_group")))
    return met.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos"))


def depth_of(n: Column) -> Column:
    """Levels above the leaves of a tree of `n` leaves: the least d with ARITY ** d >= n."""
    return sum((F.when(n > ARITY**k, 1).otherwise(0) for k in range(40)), F.lit(0))


def _next_level(below: Column) -> Column:
    """One level up: the digests of runs of ARITY neighbours."""
    runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda r: digest(F.slice(below, r * ARITY + 1, ARITY)))


def blocks_of(nodes: DataFrame, base: int, member: list[str]) -> DataFrame:
    """(tree, block, depth, climb, members, level0 .. levelN): the next levels above `nodes` (tree, depth, pos, digest).

    Every BLOCK neighbours are one row, a bounded one; `climb` levels are made inside it, fewer where the tree ends.
    """
    made = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.first("depth").alias("depth"),
        F.sort_array(F.collect_list(F.struct("pos", "digest", *member))).alias("members"),
    )
    made = made.withColumn("climb", F.least(F.lit(LEVELS), F.col("depth") - base))
    made = made.withColumn("level0", F.col("members.digest"))
    for k in range(1, LEVELS + 1):
        below = F.col(f"level{k - 1}")
        made = made.withColumn(f"level{k}", F.when(F.col("climb") >= k, _next_level(below)).otherwise(below))
    return cut_lineage(made)


def siblings(place: Column) -> Column:
    """The proof of the member at `place` within its block: per level climbed the digests left and right of its own."""
    steps = []
    for k in range(LEVELS):
        level, own = F.col(f"level{k}"), F.floor(place / ARITY**k).cast("int")
        first = own - own % ARITY
        left = F.slice(level, first + 1, own % ARITY)
        right = F.slice(level, own + 2, ARITY - 1 - own % ARITY)
        steps.append(F.when(F.col("climb") > k, F.struct(left.alias("left"), right.alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def inner_nodes(blocks: DataFrame, above: int) -> DataFrame:
    """(tree, depth, pos, digest) of the nodes that the blocks climb to; `done` where it is the tree's root."""
    done = F.col("depth") <= above * LEVELS
    return blocks.select("tree", "depth", F.col("block").alias("pos"), F.element_at(f"level{LEVELS}", 1).alias("digest"), done.alias("done"))


def climb_trees(nodes: DataFrame, deepest: int, member: list[str], keep_first: bool) -> tuple[DataFrame | None, list[DataFrame], DataFrame]:
    """(first blocks, links, roots) of all trees of `nodes`.

    A link (tree, layer, pos) -> (up_layer, up_pos) spans LEVELS levels and holds the segment of sibling digests on the way.
    Layers count the groupings; `keep_first`: the nodes given are no link sources, their blocks are returned instead.
    """
    links, roots, first, layer = [], None, None, 0
    while True:
        blocks = blocks_of(nodes, layer * LEVELS, member if layer == 0 else [])
        if layer == 0 and keep_first:
            first = blocks
        else:
            place = F.col("m.pos") % BLOCK
            exploded = blocks.withColumn("m", F.explode("members")).withColumn("seg", siblings(place))
            links.append(
                exploded.select(
                    "tree", F.lit(layer).alias("layer"), F.col("m.pos").alias("pos"), F.lit(layer + 1).alias("up_layer"),
                    F.col("block").alias("up_pos"), "seg",
                )
            )
        layer += 1
        made = inner_nodes(blocks, layer)
        ended = made.filter("done").select("tree", F.lit(layer).alias("layer"), "digest")
        roots = ended if roots is None else roots.unionByName(ended)
        if deepest <= layer * LEVELS:
            return first, links, roots
        nodes = made.filter("not done")


def node_key(tree: Column, layer: Column, pos: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), layer.cast("int").alias("layer"), pos.cast("long").alias("pos"))


def jump(links: DataFrame, far: int) -> DataFrame:
    """(node, seg, subroot): pointer jumping. Each round joins every node with the node that its pointer leads to, appends that
    node's segment and takes over its pointer, so distances double until every node's segment reaches the root.

    Nodes that have reached it leave the joins. Late rounds, in which many nodes share an ancestor, have few ancestors: those
    are broadcast, behind a count.
    """
    done = links.filter("up is null")
    left = links.filter("up is not null")
    span = 1
    while span < far:
        span *= 2
        every = done.unionByName(left)
        wanted = left.select(F.col("up").alias("wanted")).distinct()
        to = every.join(wanted, F.col("node") == F.col("wanted"), "left_semi")
        to = to.select(F.col("node").alias("at"), F.col("up").alias("next"), F.col("seg").alias("more"), F.col("subroot").alias("later"))
        met = left.join(measured(to, NEAR_ROWS), F.col("up") == F.col("at"))
        met = met.select("node", F.col("next").alias("up"), F.concat("seg", "more").alias("seg"), F.coalesce("subroot", "later").alias("subroot"))
        met = cut_lineage(met)
        done = done.unionByName(met.filter("up is null"))
        left = met.filter("up is not null")
    return done


def manifest_proofs(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    changed_text: Column | None = None,
    text_col: str = "text",
) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of `docs`.

    A leaf is the SHA-256 of its fields, each `-` if null, else length, `:` and value. Per group, leaves ascend by id and every
    three neighbours become their digest until one is left, the subroot (a lone leaf is its own); subroots in the order of
    groups give the root in the same way. A proof is the siblings' digests from leaf to root. `changed_text` is the text as
    somebody hands it in, to be checked against the manifest: folded_root is made from it and the original siblings, and
    verified tells whether that is the root.

    Trees are made BLOCK neighbours at a time; nodes above a block hold their segment of siblings towards the next layer, and
    :func:`jump` doubles these distances. Leaves meet their block's finished segment once, block by block.

    Null ids come first in their group, a null group is the first group; rows of one id are ordered by their digest, so equal
    rows may stand for each other. No rows: no rows.
    """
    kinds = {f.name: f.dataType for f in docs.schema.fields}

    def enc(name: str, text: Column | None = None) -> Column:
        value = F.col(f"`{name}`") if text is None else text
        return encoded(value, isinstance(kinds[name], T.StringType))

    given = changed_text if changed_text is not None else F.col(f"`{text_col}`")
    leaves = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{group_col}`").alias("_of"),
        leaf_digest([enc(f) for f in fields]).alias("digest"),
        F.when(given.eqNullSafe(F.col(f"`{text_col}`")), leaf_digest([enc(f) for f in fields]))
        .otherwise(leaf_digest([enc(f, given if f == text_col else None) for f in fields]))
        .alias("given"),
    )
    leaves = places(cut_lineage(leaves), "_of", ["_id", "digest"])
    groups = leaves.groupBy("_of").agg(F.count("*").alias("n")).withColumn("_all", F.lit(0))
    groups = cut_lineage(places(groups, "_all", ["_of"]).select("_of", F.col("pos").alias("tree"), depth_of(F.col("n")).alias("depth")))
    facts = groups.agg(F.max("depth").alias("depth"), F.count("*").alias("n")).first()
    deepest, trees = facts["depth"] or 0, facts["n"]
    known = measured(groups.select(F.col("_of").alias("_group"), "tree", "depth"))
    leaves = leaves.join(known, F.col("_of").eqNullSafe(F.col("_group")))
    first, inner, subroots = climb_trees(leaves.select("tree", "depth", "pos", "digest", "_id", "given"), deepest, ["_id", "given"], True)
    subroots = cut_lineage(subroots)
    top_depth = next(d for d in range(64) if ARITY**d >= trees)
    tops = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(top_depth).alias("depth"), F.col("tree").alias("pos"), "digest"
    )
    _, outer, roots = climb_trees(tops, top_depth, [], False)
    top_layers = max(1, -(-top_depth // LEVELS))
    own = node_key(F.col("tree"), F.col("layer"), F.col("pos"))
    up = node_key(F.col("tree"), F.col("up_layer"), F.col("up_pos"))
    top_end = F.when(F.col("up_layer") < top_layers, up).alias("up")
    # a subroot is a leaf of the tree over sources: its link starts at the node it is in the source's own tree
    ends = subroots.select(F.col("tree").alias("of_tree"), F.col("layer").alias("of_layer"), F.col("digest").alias("subroot"))
    held = outer[0].join(measured(ends), F.col("pos") == F.col("of_tree"))
    held = held.select(node_key(F.col("of_tree"), F.col("of_layer"), F.lit(0)).alias("node"), top_end, "seg", "subroot")
    no_sub = F.lit(None).cast("binary").alias("subroot")
    links = held
    for part in inner:
        links = links.unionByName(part.select(own.alias("node"), up.alias("up"), "seg", no_sub))
    for part in outer[1:]:
        links = links.unionByName(part.select(own.alias("node"), top_end, "seg", no_sub))
    layers = max(1, -(-deepest // LEVELS))
    paths = jump(cut_lineage(links), layers + top_layers)
    found = roots.select("digest").first()
    root = F.lit(bytes(found["digest"]).hex() if found else None).cast("string")
    blocks = first.join(
        paths.select("node", F.col("seg").alias("path"), "subroot"),
        F.col("node") == node_key(F.col("tree"), F.lit(1), F.col("block")),
    )
    rows = blocks.withColumn("m", F.explode("members")).withColumn("seg", F.concat(siblings(F.col("m.pos") % BLOCK), "path"))
    rows = rows.select("m", "subroot", "seg")
    proof = F.flatten(F.transform("seg", lambda s: F.concat(s["left"], s["right"])))
    folded = F.aggregate("seg", F.col("m.given"), lambda acc, s: digest(F.concat(s["left"], F.array(acc), s["right"])))
    made = rows.select(
        F.col("m._id").alias(id_col),
        F.lower(F.hex("m.digest")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        root.alias("root"),
        F.lower(F.hex(digest(proof))).alias("proof_sha256"),
        F.lower(F.hex(folded)).alias("folded_root"),
    )
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))
