"""SimHash near-duplicates through distances to reference fingerprints; groups at a similarity by shingle prefixes."""

from __future__ import annotations

import math
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import cut_lineage, map_texts, measured, row_view, written
from tidemark.llm.components import components

BITS = 64


def fingerprint(text: bytes | None, size: int, seed: int = 42) -> int:
    """The fingerprint of one text: a bit is set where over half of the shingle hashes set it. No words: 0."""
    words = (text or b"").lower().split()  # of bytes: ASCII letters, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    hashes = np.fromiter(
        (xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, stops, strict=True)), np.uint64, len(starts)
    )
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """(_id, fp LONG): one row per row of `docs`, over whole texts. Null and wordless texts have 0."""

    def work(texts, _):
        made = np.array([fingerprint(t, size) for t in texts], dtype=np.uint64)
        return {"fp": pa.array(made.view(np.int64))}

    return map_texts(row_view(docs, id_col, text_col), "fp bigint", work)


def spans(blocks: int) -> list[tuple[int, int]]:
    """The bit ranges of `blocks` nearly equal blocks."""
    widths = [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]
    return list(zip(accumulate(widths, initial=0), accumulate(widths), strict=False))


def pivots(blocks: int) -> list[int]:
    """The zero fingerprint, then for each block the fingerprints with the block's first 1, 2, ... bits set.

    Neighbours of a block's staircase differ in one bit, so the distances to them, less the distance to zero, agree for two
    fingerprints just where their block does: the distance table alone tells which fingerprints agree on a block.
    """
    return [0, *(((1 << (i + 1)) - 1) ^ ((1 << low) - 1) for low, high in spans(blocks) for i in range(low, high))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def distance(fp: Column, pivot: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(signed(pivot)).cast("long")))


def pivot_table(reps: DataFrame, blocks: int) -> DataFrame:
    """`reps` with `coords` ARRAY<TINYINT>: the distances to all pivots, in their order."""
    made = F.array(*(distance(F.col("fp"), p).cast("tinyint") for p in pivots(blocks)))
    return reps.withColumn("coords", made)


def block_keys(table: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    """(key, fp): a key per choice of `blocks` - `max_bits` blocks, from the table's coordinates.

    Fingerprints with up to `max_bits` differing bits leave that many blocks untouched, so linked ones share a key.
    """
    zero = F.element_at("coords", 1)
    signs = [
        F.xxhash64(F.lit(n), *(F.element_at("coords", i + 2) - zero for i in range(low, high)))
        for n, (low, high) in enumerate(spans(blocks))
    ]
    parts = table.select("fp", *(s.alias(f"s{n}") for n, s in enumerate(signs)))
    keys = [F.xxhash64(*(F.col(f"s{n}") for n in chosen)) for chosen in combinations(range(blocks), blocks - max_bits)]
    return parts.select("fp", F.explode(F.array(*keys)).alias("key"))


def blocks_for(distinct: int, max_bits: int, crowd: int = 8) -> int:
    """The least number of blocks whose keys would hold no more than `crowd` of `distinct` fingerprints, were they spread evenly.

    For 4 bits: 6 blocks give 15 keys of 20 bits or more (up to 8 million fingerprints), 7 give 35 of 27, 8 give 70 of 32."""
    blocks = max_bits + 2
    while blocks < BITS // 4 and distinct > crowd << sum(sorted(high - low for low, high in spans(blocks))[: blocks - max_bits]):
        blocks += 1
    return blocks


def near_pairs(reps: DataFrame, max_bits: int = 4, blocks: int = 6, dense: int = 64, screen: int = 4) -> DataFrame:
    """(a, b) of distinct fingerprints: enough links for the components of "at most `max_bits` differing bits".

    Keys with up to `dense` fingerprints give candidate pairs; those whose coordinates differ by more than `max_bits` for any
    screening pivot are discarded and the rest verified. Fingerprints of a denser key (thousands of edited copies) are linked
    through reference fingerprints halfway: two of them link just if one reference lies within `max_bits` / 2 of both, so each
    fingerprint sends its 1 + 64 + 2016 such references (for 4 bits) and links to the smallest one seen there. That is
    linear in their number and exact for an even `max_bits`; no pair is lost or capped either way.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    keys = block_keys(pivot_table(reps, blocks), blocks, max_bits)
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut_lineage(keys.join(sizes.hint("merge"), "key"))
    few = shared.filter(F.col("n") <= dense).select("key", "fp")
    pairs = (
        few.select("key", F.col("fp").alias("a"))
        .join(few.select("key", F.col("fp").alias("b")).hint("merge"), "key")
        .filter("a < b")
    )
    for p in pivots(blocks)[:: max(1, BITS // (4 * screen))]:
        pairs = pairs.filter(F.abs(distance(F.col("a"), p) - distance(F.col("b"), p)) <= max_bits)
    pairs = pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    crowd = shared.filter(F.col("n") > dense).select("fp").distinct()
    reached = crowd.select("fp", F.col("fp").alias("middle"), F.lit(-1).alias("at"))
    for _ in range(max_bits // 2):
        later = reached.withColumn("bit", F.explode(F.sequence(F.least(F.col("at") + 1, F.lit(BITS)), F.lit(BITS))))
        flip = F.when(F.col("bit") < BITS, F.expr("shiftleft(1L, bit)")).otherwise(F.lit(0).cast("long"))
        reached = later.select("fp", F.col("middle").bitwiseXOR(flip).alias("middle"), F.col("bit").alias("at"))
    least = reached.groupBy("middle").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("middle", "a")
    stars = reached.join(least.hint("merge"), "middle").filter("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4,
    max_bits: int = 4,
    blocks: int | None = None,
    dense: int = 64,
) -> DataFrame:
    """(id_col, fingerprint, component_id), one row per row of `docs`.

    Texts are lower-cased (A-Z), cut at ASCII white space and shingled by `size` words. Fingerprints link at `max_bits` or
    fewer differing bits; component_id is the smallest id reachable. Equal fingerprints are one node from the start, so a group
    of copies costs one row. `blocks` follows the number of distinct fingerprints (:func:`blocks_for`) where none is given; it only
    trades keys for candidates, and the components are the same.

    Null or wordless text: fingerprint 0, linked like any other. Null id: the row stays, its component is the smallest
    id that is not null (null if there is none). Repeated rows each get their row. No rows: no rows.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col, size))
    reps = cut_lineage(prints.groupBy("fp").agg(F.min("_id").alias("least")))
    blocks = blocks or blocks_for(reps.count(), max_bits)
    labels = components(near_pairs(reps.select("fp"), max_bits, blocks, dense))
    linked = reps.join(labels.hint("merge"), F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    roots = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    named = linked.join(roots.hint("merge"), "label").select("fp", "component_id")
    return prints.join(named.hint("merge"), "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# -- groups at a similarity of shingle sets --------------------------------------------------------------------------------

#: Cells in which shingles are counted for the order of prefixes; a shared cell costs candidates, never a pair.
SHINGLE_CELLS = 1 << 18
#: Words of 64 bits in the sketch of a shingle set, and the multipliers that make their hashes from a shingle's.
SKETCH = 4
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
#: Reference sketches that distances are tabulated to.
REFERENCES = 24
#: Deviations beyond the expected distance that the screens allow, and the size of sets under which no screen is asked.
DEVIATIONS, SMALL_SET = 6.0, 64
#: Rounds that compare one or two pairs a member only, before all pairs that are still in different groups.
NEIGHBOUR_ROUNDS = 2
#: Nodes that a task remembers in order to write the prefix of copies once.
SEEN_NODES = 200_000
#: Members of a shingle that one window or one cell of the last comparison takes.
WINDOW_ROWS, BLOCK_ROWS = 4096, 256


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """The distinct hashes of `size`-word shingles of one text, sorted; words as in :func:`fingerprint`. No words: none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(joined, 42)], np.uint64).view(np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: len(words) - size] + 1)).tolist()
    stops = ends[size - 1 :].tolist()
    hashes = np.fromiter((xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, stops, strict=True)), np.uint64, len(starts))
    return np.unique(hashes.view(np.int64))


def sketch(grams: np.ndarray) -> np.ndarray:
    """The SimHash of a set in SKETCH words: a bit is 1 if it is set in over half of the hashes."""
    votes = np.zeros(64 * SKETCH, np.int64)
    plain = grams.view(np.uint64)
    for at in range(0, len(plain), 16_384):
        part = plain[at : at + 16_384]
        mixed = []
        for m in _MIX[:SKETCH]:
            x = (part ^ (part >> np.uint64(31))) * np.uint64(m)
            mixed.append(x ^ (x >> np.uint64(29)))
        votes += np.unpackbits(np.stack(mixed, axis=1).view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > len(grams)).view(np.int64)


def widest(similarity: float) -> int:
    """Differing bits that two sketches of sets of the similarity may have: the expected number of the angle between the sets, and
    DEVIATIONS beyond it."""
    bits = 64 * SKETCH
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * p + DEVIATIONS * math.sqrt(bits * p * (1 - p)))


def least_shared(similarity: float, total: Column) -> Column:
    """Shingles that two sets of `total` shingles together must share for a Jaccard similarity of `similarity`."""
    return F.ceil(total * (similarity / (1 + similarity)) - 1e-9)


def may_reach(a: Column, b: Column, similarity: float) -> Column:
    """False only where the sizes, or the places of a shared prefix shingle, rule the similarity out. It is asked of each
    shingle; the first one shared by a similar pair passes."""
    sizes = F.least(a["n"], b["n"]) >= similarity * F.greatest(a["n"], b["n"]) - 1e-9
    return sizes & (F.least(a["n"] - a["at"], b["n"] - b["at"]) >= least_shared(similarity, a["n"] + b["n"]))


def _texts_to_nodes(view: DataFrame, size: int) -> DataFrame:
    """One pass over the texts: (_id, key, node, n, sketch) per row, and at the end of each task (cell, times): how many
    shingles fell into each cell."""
    kind = view.schema["_id"].dataType.simpleString()
    names = ["_id", "key", "node", "n", "sketch", "cell", "times"]

    def run(batches):
        total, id_type = np.zeros(SHINGLE_CELLS, np.int64), None
        for batch in batches:
            id_type = batch.column("_id").type
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                made = [shingle_set(t, size) for t in part.column("_text").to_pylist()]
                for m in made:
                    np.add.at(total, m & (SHINGLE_CELLS - 1), 1)
                bits = np.concatenate([sketch(m) for m in made])
                nothing = pa.nulls(len(made), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("key"), _nodes(made), pa.array([len(m) for m in made], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1) * SKETCH, pa.int32()), pa.array(bits)), nothing, nothing],
                    names=names,
                )
        hit = np.flatnonzero(total)
        if len(hit):
            n = len(hit)
            empty = [pa.nulls(n, t) for t in (id_type, pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(hit), pa.array(total[hit])], names=names)

    texts = view.select("_id", "key", F.col("_text").cast("binary").alias("_text"))
    return texts.mapInArrow(run, f"_id {kind}, key bigint, node bigint, n int, sketch array<bigint>, cell bigint, times bigint")


def _nodes(made: list[np.ndarray]) -> pa.Array:
    """One number per set, the same for equal sets."""
    return pa.array(np.array([xxh64_intdigest(m.tobytes(), 7) for m in made], np.uint64).view(np.int64))


def _prefixes(view: DataFrame, size: int, similarity: float, often) -> DataFrame:
    """(gram, node, at, n): of each set the rarest n - ceil(similarity * n) + 1 of its n shingles, with their places.

    Two sets of that similarity share a shingle of both prefixes under any order of all shingles. The order is by the count of
    their cells, then by hash, so shingles of common passages come last and meet in few prefixes."""

    def cut(batches):
        counts, seen = often.value, set()
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                made = []
                for t in part.column("_text").to_pylist():
                    held = shingle_set(t, size)
                    name = xxh64_intdigest(held.tobytes(), 7)
                    if name not in seen:  # copies in one task are one node
                        made.append(held)
                        if len(seen) < SEEN_NODES:
                            seen.add(name)
                if not made:
                    continue
                grams = []
                for held in made:
                    kept = min(len(held), len(held) - int(np.ceil(similarity * len(held) - 1e-9)) + 1)
                    grams.append(held[np.lexsort((held, counts[held & (SHINGLE_CELLS - 1)]))[:kept]])
                lengths = np.array([len(g) for g in grams], np.int64)
                columns = {
                    "gram": np.concatenate(grams),
                    "node": np.repeat(_nodes(made).to_numpy(), lengths),
                    "at": np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]),
                    "n": np.repeat(np.array([len(m) for m in made], np.int32), lengths),
                }
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))

    return view.select(F.col("_text").cast("binary").alias("_text")).mapInArrow(cut, "gram bigint, node bigint, at int, n int")


def distance_table(nodes: DataFrame, references: list[list[int]]) -> DataFrame:
    """`nodes` (node, sketch, ...) with `coords` ARRAY<SMALLINT>: the Hamming distances to all reference sketches."""
    made = [_differing(F.col("sketch"), F.array(*(F.lit(w).cast("long") for w in r))).cast("smallint") for r in references]
    return nodes.withColumn("coords", F.array(*made) if made else F.array().cast("array<smallint>"))


def _differing(a: Column, b: Column) -> Column:
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, SKETCH)), F.bit_count(a[0].bitwiseXOR(b[0])))


def screened(pairs: DataFrame, table: DataFrame, similarity: float) -> DataFrame:
    """Those of `pairs` (a, b) whose coordinates differ nowhere by more than the allowed distance, and whose sketches do not either.

    |d(a, r) - d(b, r)| <= d(a, b) for every reference r, so the first test discards nothing that the second would keep. Sets too
    small for a sketch to be near its expectation pass."""
    one, two = (table.select(F.col("node").alias(e), *(F.col(c).alias(f"{e}_{c}") for c in ("coords", "sketch", "n"))).hint("merge") for e in "ab")
    met = pairs.join(one, "a").join(two, "b")
    apart = F.array_max(F.zip_with("a_coords", "b_coords", lambda x, y: F.abs(x - y)))
    near = (F.coalesce(apart, F.lit(0)) <= widest(similarity)) & (_differing(F.col("a_sketch"), F.col("b_sketch")) <= widest(similarity))
    return met.filter((F.least("a_n", "b_n") < SMALL_SET) | near).select("a", "b")


def similar_pairs(pairs: DataFrame, table: DataFrame, view: DataFrame, size: int, similarity: float) -> DataFrame:
    """Those of `pairs` (a, b) whose shingle sets have the similarity, counted on the sets themselves.

    Sets are made anew from the texts of the nodes that stand in a pair, and only they are shuffled, to their pair. They travel as
    32 bits a shingle, so a count may be off by one with a chance of about 1e-4 a pair."""
    pair = F.struct("a", "b").alias("pair")
    ends = pairs.select(F.col("a").alias("node"), pair, F.lit(True).alias("first")).unionByName(pairs.select(F.col("b").alias("node"), pair, F.lit(False).alias("first")))
    wanted = table.join(ends.select("node").distinct().hint("merge"), "node", "left_semi")
    wanted = measured(wanted.select(F.col("least._id").alias("least_id"), F.col("least.key").alias("least_key")))
    texts = view.join(wanted, (F.col("key") == F.col("least_key")) & F.col("_id").eqNullSafe(F.col("least_id")), "left_semi")

    def work(texts, _):
        made = [shingle_set(t, size) for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(m) for m in made]))).astype(np.int32)
        short = np.concatenate(made).astype(np.int32)
        return {"node": _nodes(made), "grams": pa.ListArray.from_arrays(pa.array(offsets), pa.array(short))}

    sets = map_texts(texts, "node bigint, grams array<int>", work, ())
    met = sets.join(measured(ends), "node")
    both = met.groupBy("pair").agg(
        F.first(F.when(F.col("first"), F.col("grams")), ignorenulls=True).alias("x"), F.first(F.when(~F.col("first"), F.col("grams")), ignorenulls=True).alias("y")
    )
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared >= least_shared(similarity, F.size("x") + F.size("y"))).select("pair.*")


def _neighbours(left: DataFrame, turn: int, similarity: float) -> DataFrame:
    """Pairs of members of a shingle, one or two a member. First each member and the one of its size that has the fewest rarer
    shingles: the text that a family was edited from, or the least edited copy, is in reach of all that two copies with other edits
    are not. Then members next to each other by size and in a hashed order. The members of a frequent shingle are spread over
    windows by another hash."""
    spread = F.pmod(F.xxhash64("node", F.lit(turn + 100)), F.ceil(F.col("members") / WINDOW_ROWS))
    one = F.struct("node", "at", "n", "label")
    if turn == 0:
        alike = F.floor(F.log("n") / max(-math.log(similarity), 1e-3))  # of one number: within the ratio of sizes
        ends = F.array(F.first(one).over(Window.partitionBy("gram", spread, alike).orderBy("at", "node")))
    else:
        window = Window.partitionBy("gram", spread)
        ends = F.array(*(F.lead(one).over(window.orderBy(*order)) for order in (["n", "node"], [F.xxhash64("node", F.lit(turn))])))
    met = left.select(one.alias("x"), ends.alias("ends"))
    both = met.select("x", F.explode("ends").alias("y")).filter("y is not null and x.label <> y.label")
    return both.filter(may_reach(F.col("x"), F.col("y"), similarity))


def _all_pairs(left: DataFrame, similarity: float) -> DataFrame:
    """All pairs of members of a shingle that are in different groups. A frequent shingle is a square of cells of BLOCK_ROWS by
    BLOCK_ROWS members, each a join key of its own, so no task takes all its pairs."""
    blocks = F.ceil(F.col("members") / BLOCK_ROWS)
    mine = F.pmod(F.xxhash64("node", F.lit(77)), blocks)
    every = F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)
    base = left.select("gram", F.struct("node", "at", "n", "label").alias("x"), mine.alias("own"), F.explode(every).alias("other"))
    rows, columns = (base.select("gram", F.col("x").alias(e), F.col(a).alias("i"), F.col(b).alias("j")) for e, a, b in (("x", "own", "other"), ("y", "other", "own")))
    both = rows.join(columns.hint("merge"), ["gram", "i", "j"]).filter("x.node < y.node and x.label <> y.label")
    return both.filter(may_reach(F.col("x"), F.col("y"), similarity))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8
) -> DataFrame:
    """(_id, key, winner STRUCT<_id, key>), one row per row of `docs`: groups of texts linked at `similarity` and more.

    The similarity is the Jaccard similarity of the sets of `size`-word shingles. Candidates share one of their rarest shingles
    (:func:`_prefixes`), which no pair of the similarity fails to do. A pair is discarded where the distances of its sketches to
    REFERENCES reference sketches, a stored table, differ too much (:func:`screened`); survivors are counted on the sets
    themselves. The screens lose a pair of the similarity with a chance of about 1e-9 and keep all pairs of small sets.

    Texts with equal sets are one node. Rounds compare members with the least edited one and with neighbours first
    (:func:`_neighbours`), which joins most of a family at a cost in proportion to its size; pairs inside a group need no comparison. Last, every candidate pair still in two groups is compared,
    so no link is lost or capped; a family of which most pairs are candidates under the similarity costs its pairs. The
    winner is the least (id, key) of the group; `key` is a 64-bit hash of the text.

    Null or wordless texts are one group. No rows: no rows.
    """
    spark = docs.sparkSession
    view = row_view(docs, id_col, text_col).withColumn("key", F.xxhash64("_text"))
    first = written(_texts_to_nodes(view, size))
    rows = first.filter("cell is null").select("_id", "key", "node", "n", "sketch")
    cells = first.filter("cell is not null").groupBy("cell").agg(F.sum("times").alias("times")).toArrow()
    counts = np.zeros(SHINGLE_CELLS, np.int64)
    counts[cells.column("cell").to_numpy()] = cells.column("times").to_numpy()
    prefixes = written(_prefixes(view, size, similarity, spark.sparkContext.broadcast(counts)))
    # most shingles have one node; the others are told by its least and greatest, partial sums that need no list of nodes
    ends = prefixes.groupBy("gram").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = written(ends.filter("low <> high").select("gram"))
    members = prefixes.join(measured(shared), "gram").groupBy("gram", "node").agg(F.min("at").alias("at"), F.min("n").alias("n"))
    members = written(members.withColumn("label", F.col("node")))
    sizes = members.groupBy("gram").agg(F.count("*").alias("members"))
    left = written(members.join(sizes.hint("merge"), "gram"))
    reps = written(
        rows.groupBy("node").agg(F.min(F.struct("_id", "key")).alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    )
    candidates = reps.join(left.select("node").distinct().hint("merge"), "node", "left_semi")
    references = [r["sketch"] for r in candidates.orderBy(F.xxhash64("node"), "node").limit(REFERENCES).select("sketch").collect()]
    table = written(distance_table(candidates, references))
    labels = table.select("node", F.col("node").alias("label"))
    for turn in range(NEIGHBOUR_ROUNDS + 1):
        last = turn == NEIGHBOUR_ROUNDS
        both = _all_pairs(left, similarity) if last else _neighbours(left, turn, similarity)
        pairs = both.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
        pairs = written(screened(pairs, table, similarity))
        links = written(similar_pairs(pairs, table, view, size, similarity))
        if links.isEmpty():
            continue
        # only what is new: links between groups, and the groups that they join
        ends = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("u")).hint("merge"), "a")
        ends = ends.join(labels.select(F.col("node").alias("b"), F.col("label").alias("v")).hint("merge"), "b")
        joined = components(ends.select("u", "v"), "u", "v").select(F.col("node").alias("was"), F.col("label").alias("now"))
        labels = _renamed(labels, joined)
        if not last:
            left = _renamed(left, joined)
            open_ = left.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("gram")
            left = written(left.join(open_.hint("merge"), "gram"))
    labels = labels.select(F.col("node").alias("member"), "label")
    linked = reps.join(labels.hint("merge"), F.col("node") == F.col("member"), "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    winners = linked.groupBy("label").agg(F.min("least").alias("winner"))
    named = written(linked.join(winners.hint("merge"), "label").select("node", "winner"))
    return rows.select("_id", "key", "node").join(named.hint("merge"), "node").select("_id", "key", "winner")


def _renamed(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """`rows` with `label` replaced where `joined` (was, now) has another."""
    met = rows.join(joined.hint("merge"), F.col("label") == F.col("was"), "left")
    return written(met.withColumn("label", F.coalesce("now", "label")).select(*rows.columns))
