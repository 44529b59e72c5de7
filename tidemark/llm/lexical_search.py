"""Ranked lexical search of many queries at once: shared term sets are added up once per document."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, row_view

#: Terms of items that one plan holds; more items are searched in several passes over the documents.
PLAN_TERMS = 200_000
#: Numbers in the accumulators of one block of documents.
CELLS = 4_000_000
#: Rounds that look for shared pairs of term sets, and sets of an item that take part in one.
ROUNDS, PAIRED = 8, 64
#: Parts that the best documents of tasks are first ranked in.
PARTS = 32

#: Upper to lower case, signs that end a term to spaces, everything else as it is.
_TABLE = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a whole text, in order: runs of ASCII letters and digits and of all signs beyond ASCII, A-Z lower-cased."""
    return (text or b"").translate(_TABLE).split()


@dataclass
class Plan:
    """What several items share, as a graph over term sets.

    Terms that occur in the same items are one set, whose accumulator is made from the postings. `steps` add two
    accumulators to a third one that several items use; an item is the sum of the accumulators `nodes[starts[i]:]`.
    """

    vocabulary: dict[bytes, int]
    set_of: np.ndarray
    sets: int
    steps: list[tuple[np.ndarray, np.ndarray]]
    nodes: np.ndarray
    starts: np.ndarray

    @property
    def size(self) -> int:
        return self.sets + sum(len(a) for a, _ in self.steps)

    def scores(self, terms: np.ndarray, docs: np.ndarray, amounts: np.ndarray, n_docs: int) -> np.ndarray:
        """Items x documents, from postings (term, document, amount) of a block: 64-bit integers throughout."""
        held = np.zeros((self.size, n_docs), np.int64)
        np.add.at(held, (self.set_of[terms], docs), amounts)
        at = self.sets
        for a, b in self.steps:
            held[at : at + len(a)] = held[a] + held[b]
            at += len(a)
        return np.add.reduceat(held[self.nodes], self.starts, axis=0)


def mine(items: list[list[bytes]]) -> Plan:
    """The plan of items that have a term each. Sharing decides what is added first and never a result."""
    vocabulary: dict[bytes, int] = {}
    users: list[list[int]] = []
    for i, terms in enumerate(items):
        for term in terms:
            at = vocabulary.setdefault(term, len(users))
            if at == len(users):
                users.append([])
            users[at].append(i)
    numbers: dict[tuple, int] = {}
    set_of = np.array([numbers.setdefault(tuple(u), len(numbers)) for u in users], np.int64)
    uses: list[set[int]] = [set() for _ in items]
    for held, number in numbers.items():
        for i in held:
            uses[i].add(number)
    shared = {number: len(held) for held, number in numbers.items() if len(held) > 1}
    steps, total = [], len(numbers)
    for _ in range(ROUNDS):
        pairs: Counter = Counter()
        for use in uses:
            often = sorted((x for x in use if x in shared), key=lambda x: (-shared[x], x))[:PAIRED]
            pairs.update(combinations(sorted(often), 2))
        chosen, taken = {}, set()
        for (a, b), n in sorted(pairs.items(), key=lambda p: (-p[1], p[0])):
            if n > 1 and a not in taken and b not in taken:
                taken |= {a, b}
                chosen[a, b] = total + len(chosen)
        if not chosen:
            break
        for (a, b), c in chosen.items():
            n = 0
            for use in uses:
                if a in use and b in use:
                    use -= {a, b}
                    use.add(c)
                    n += 1
            shared[c] = n
        ends = np.array(list(chosen), np.int64)
        steps.append((ends[:, 0], ends[:, 1]))
        total += len(chosen)
    nodes = np.concatenate([np.array(sorted(use), np.int64) for use in uses])
    starts = np.cumsum([0] + [len(use) for use in uses[:-1]])
    return Plan(vocabulary, set_of, len(numbers), steps, nodes, starts)


class Best:
    """The best `k` documents per item of the blocks seen so far: score, then id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 4

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray):
        item, doc = np.nonzero(scores >= self.least[:, None])
        new = (item, scores[item, doc], missing[doc], ids[doc])
        self.rows = [np.concatenate([old, x]) for old, x in zip(self.rows, new, strict=True)]
        if len(self.rows[0]) > 4 * self.k * len(self.least):
            self.cut()

    def cut(self):
        item, score, missing, ids = self.rows
        order = np.lexsort((ids, missing, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = order[place == self.k - 1]
        self.least[self.rows[0][last]] = score[last]
        self.rows = [x[order[place < self.k]] for x in self.rows]


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(_id, n, terms ARRAY<INT>, times ARRAY<INT>), one row per document with a term: `n` counts all its terms, the arrays hold
    those of the vocabulary."""
    view = row_view(docs, id_col, text_col)
    kind = view.schema["_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches):
        known = shared.value
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                kept, sizes, terms, times, ends = [], [], [], [], [0]
                for i, scalar in enumerate(part.column("_text")):
                    words = terms_of(scalar.as_py())
                    if words:
                        counts = Counter(words)
                        hit = counts.keys() & known.keys()
                        kept.append(i)
                        sizes.append(len(words))
                        terms += [known[t] for t in hit]
                        times += [counts[t] for t in hit]
                        ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(pa.array(kept, pa.int32())), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                    names=["_id", "n", "terms", "times"],
                )

    return view.withColumn("_text", F.col("_text").cast("binary")).mapInArrow(
        work, f"_id {kind}, n bigint, terms array<int>, times array<int>"
    )


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _search(docs: DataFrame, rows: list, id_col: str, text_col: str, item_type, k: int) -> DataFrame:
    """(no, item_id, _id, score): each task's best `k` documents of each item of one plan."""
    spark = docs.sparkSession
    plan = mine([r["terms"] for r in rows])
    held = cut_lineage(postings(docs, plan.vocabulary, id_col, text_col))
    facts = held.agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    n_docs, all_terms = facts["n"], facts["terms"]
    df = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    weights = np.zeros(len(plan.vocabulary), np.int64)
    for term, n in zip(df.column("term").to_pylist(), df.column("df").to_pylist(), strict=True):
        weights[term] = term_weight(n_docs, n)
    shared = spark.sparkContext.broadcast((plan, weights, [r["no"] for r in rows], [r["item"] for r in rows]))
    kind = held.schema["_id"].dataType.simpleString()

    def work(batches):
        plan, weights, numbers, items = shared.value
        best = Best(len(items), k)
        block = max(16, min(2048, CELLS // (plan.size + len(plan.nodes))))
        id_type = pa.int64()
        for batch in batches:
            for part in (batch.slice(at, block) for at in range(0, batch.num_rows, block)):
                ids, terms, times = part.column("_id"), part.column("terms"), part.column("times").flatten().to_numpy()
                id_type = ids.type
                lengths = np.diff(terms.offsets.to_numpy())
                # whole numbers of any size: n * N outgrows 64 bits in a large corpus
                middle = np.array([50 + 50 * n * n_docs // all_terms for n in part.column("n").to_pylist()], np.int64)
                docs_of = np.repeat(np.arange(part.num_rows), lengths)
                term, tf = terms.flatten().to_numpy(), times.astype(np.int64)
                amounts = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * middle[docs_of]))
                scores = plan.scores(term, docs_of, amounts, part.num_rows)
                best.add(scores, ids.fill_null(0).to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        best.cut()
        item, score, missing, doc = best.rows
        where = pa.array(item)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()).take(where), pa.array(items, item_type).take(where), pa.array(doc, mask=missing.astype(bool)).cast(id_type), pa.array(score)],
            names=["no", "item", "_id", "score"],
        )

    return held.mapInArrow(work, f"no bigint, item {_sql_type(item_type)}, _id {kind}, score bigint")


def _sql_type(kind: pa.DataType) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(kind).simpleString()


def ranked_search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    k: int = 50,
) -> DataFrame:
    """(item_col, rank, id_col, score): the `k` best documents of each item, all if fewer have a score above 0.

    Scores are integers: weight of a term times its saturated, length-normalised frequency, over the distinct terms of the
    item. Equal scores rank by ascending id, null ids last; ids are whole numbers. All documents are scored against all items:
    texts are read once into counts of the items' terms, a plan shared by all items (:func:`mine`) turns a block of counts into
    scores, and a task hands on only its best `k` per item, which are ranked in two rounds, so neither postings nor scores
    are shuffled. Items are taken in as many passes as their distinct terms need, see PLAN_TERMS.

    Null texts have no terms; an item without terms has no rows. Each row of `items` is an item of its own, also one with a
    null id or an id that another row has. Repeated documents each count and rank. No documents or items: no rows.
    """
    view = row_view(items, item_col, item_text_col).withColumn("no", F.monotonically_increasing_id())
    kind = view.schema["_id"].dataType.simpleString()

    def distinct_terms(batches):
        for batch in batches:
            held = [sorted(set(terms_of(t))) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("no"), batch.column("_id"), pa.array(held, pa.list_(pa.binary()))], names=["no", "item", "terms"]
            )

    wanted = view.select("no", "_id", F.col("_text").cast("binary").alias("_text")).mapInArrow(
        distinct_terms, f"no bigint, item {kind}, terms array<binary>"
    )
    wanted = cut_lineage(wanted.filter(F.size("terms") > 0))
    total = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = -(-total // PLAN_TERMS)
    empty = wanted.select("no", "item", F.lit(None).cast(row_view(docs, id_col, text_col).schema["_id"].dataType).alias("_id"), F.lit(0).cast("long").alias("score"))
    found = empty.limit(0)
    for turn in range(passes):
        rows = wanted.filter(F.pmod(F.xxhash64("no"), F.lit(passes)) == turn).toArrow()
        if rows.num_rows:
            found = found.unionByName(_search(docs, rows.to_pylist(), id_col, text_col, rows.schema.field("item").type, k))
    order = [F.desc("score"), F.asc_nulls_last("_id")]
    found = found.withColumn("part", F.spark_partition_id() % PARTS)
    for keys in (["no", "part"], ["no"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return found.select(F.col("item").alias(item_col), "rank", F.col("_id").alias(id_col), "score")
