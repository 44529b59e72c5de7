"""Packing of tokenised documents into sequences: local best fit, then a tree of merges of the underfull bins."""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, map_texts, row_view

#: Pieces of text whose ids a Python worker remembers; beyond that it starts again from the batch at hand.
CACHE_WORDS = 300_000


class WordTokens:
    """Ids of whole texts, put together from the ids of their space-separated pieces.

    The byte-level pattern never reaches over a single space between two characters that are no white space, so the ids of
    a text are those of its pieces, each with its space in front. Texts with other white space before a space are encoded
    whole. The encoder runs once per new piece.
    """

    def __init__(self, path: str):
        self.known: dict[str, bytes] = {}
        self.double = re.compile(r"\s ").search
        if path.endswith(".tiktoken"):
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            one = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [np.array(one.encode_ordinary(t), dtype="<u4").tobytes() for t in texts]
        else:
            from tokenizers import Tokenizer

            many = Tokenizer.from_file(path)
            many.encode_special_tokens = True
            self.encode = lambda texts: [
                np.array(e.ids, dtype="<u4").tobytes() for e in many.encode_batch_fast(texts, add_special_tokens=False)
            ]

    def cut(self, text: str) -> list[str]:
        if self.double(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *map(" ".__add__, rest)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        cuts = [self.cut(t) for t in texts]
        used = set().union(*cuts)
        if len(self.known) > CACHE_WORDS:
            self.known = {p: self.known[p] for p in used if p in self.known}
        new = list(used.difference(self.known))
        self.known.update(zip(new, self.encode(new), strict=True))
        made = [b"".join(map(self.known.__getitem__, c)) for c in cuts]
        for p in new:
            if len(p) > 100:
                del self.known[p]
        return made


_TOKENS: dict[str, WordTokens] = {}


def tokens_of(path: str) -> WordTokens:
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, piece, start, length, ids_crc32): each document's ids with `end_id` behind, cut where longer than `size`.

    The first piece of a longer document holds what is over, so all others are full. Null text: the end id alone.
    """

    def work(texts):
        streams = tokens_of(tokenizer)([(t or b"").decode() for t in texts])
        rows, piece, start, length, crc = [], [], [], [], []
        end = pack("<I", end_id)
        for row, stream in enumerate(streams):
            ids = stream + end
            n = len(ids) // 4
            cuts = [0, *range(n % size or size, n + 1, size)] if n > size else [0, n]
            for i in range(len(cuts) - 1):
                rows.append(row)
                piece.append(i)
                start.append(cuts[i])
                length.append(cuts[i + 1] - cuts[i])
                crc.append(zlib.crc32(ids[4 * cuts[i] : 4 * cuts[i + 1]]))
        return pa.array(rows, pa.int32()), piece, start, length, crc

    view = row_view(docs, id_col, text_col)
    schema = "made array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"

    def lists(texts, _):
        rows, piece, start, length, crc = work(texts)
        counts = np.bincount(np.asarray(rows), minlength=len(texts))
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        fields = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        values = pa.StructArray.from_arrays(fields, names=["piece", "start", "length", "ids_crc32"])
        return {"made": pa.ListArray.from_arrays(offsets, values)}

    return map_texts(view, schema, lists).select("_id", F.inline("made"))


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: items by falling size, each into the fullest bin that still has room for it.

    Bins wait in a stack per room left and one integer has a bit per stack in use, so an item costs a shift and a lookup.
    """
    bins: list[list[int]] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        fits = used >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            bin_ = waiting[room].pop()
            if not waiting[room]:
                used &= ~(1 << room)
        else:
            room, bin_ = capacity, len(bins)
            bins.append([])
        bins[bin_].append(item)
        left = room - size
        waiting[left].append(bin_)
        used |= 1 << left
    return bins


def dealt(waiting: DataFrame, level: int, groups: int) -> DataFrame:
    """`waiting` with a `tie` and its partition `part`, by a hash of level, id, piece and the row's place.

    The place, the same in every recomputation because `waiting` is read from a checkpoint, spreads rows that share a null or
    repeated id."""
    first = F.element_at("members", 1)
    tie = F.xxhash64(F.lit(level), first["_id"], first["piece"], F.monotonically_increasing_id())
    return waiting.withColumn("tie", tie).withColumn("part", F.pmod(F.col("tie"), F.lit(groups)))


def residual_packing(items: DataFrame, capacity: int, leaf: int = 100_000, fan_in: int = 4, slack: int = 0) -> DataFrame:
    """(members ARRAY<STRUCT<_id, piece, length, ...>>, filled): bins of at most `capacity` from `items` (`member`, `length`).

    Level 0 packs hashed partitions of about `leaf` items by best fit. Bins with at most `slack` room left are emitted; the
    underfull ones become items of the next level, where `fan_in` partitions meet, and so on up the tree. A bin whose room is
    smaller than the level's smallest bin can take no other and is emitted too. Where more bins wait than one task should
    hold, the level keeps more partitions (about `leaf` rows a task at any size) and the last level emits what is left.
    """
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(items.select(F.array("member").alias("members"), F.col("length").alias("filled")).schema.jsonValue())

    def pack_group(table: pa.Table) -> pa.Table:
        order = table.sort_by([("filled", "descending"), ("tie", "ascending")])
        sizes = order.column("filled").to_numpy().tolist()
        bins = best_fit(sizes, capacity)
        flat = np.fromiter((i for b in bins for i in b), np.int64, len(sizes))
        members = order.column("members").combine_chunks()
        taken = members.take(pa.array(flat))
        counts = np.array([len(b) for b in bins], np.int64)
        lengths = members.value_lengths().to_numpy(zero_copy_only=False)[flat]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        merged = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), taken.flatten())
        filled = np.add.reduceat(np.array(sizes)[flat], np.concatenate([[0], np.cumsum(counts)[:-1]])) if bins else np.zeros(0, np.int64)
        return pa.table([merged.cast(members.type), pa.array(filled, pa.int64())], names=["members", "filled"])

    waiting = items.select(F.array("member").alias("members"), F.col("length").alias("filled"))
    groups = max(1, -(-items.count() // leaf))
    levels = math.ceil(math.log(groups, fan_in)) + 1
    done = None
    for level in range(levels):
        bins = cut_lineage(dealt(waiting, level, groups).groupBy("part").applyInArrow(lambda t: pack_group(t), schema))
        if level == levels - 1:
            return bins if done is None else done.unionByName(bins)
        least = bins.agg(F.min("filled")).first()[0] or 0
        full = (F.col("filled") >= capacity - slack) | (F.lit(capacity) - F.col("filled") < F.lit(least))
        done = bins.filter(full) if done is None else done.unionByName(bins.filter(full))
        waiting = bins.filter(~full)
        groups = max(-(-groups // fan_in), -(-waiting.count() // leaf))


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each bin with the bin's number and their place in it."""
    for batch in batches:
        members = batch.column("members")
        counts = members.value_lengths().to_numpy(zero_copy_only=False)
        flat = members.flatten()
        length = flat.field("length").to_numpy(zero_copy_only=False)
        before = np.cumsum(length) - length
        firsts = np.cumsum(counts) - counts
        offset = before - np.repeat(before[firsts] if len(counts) else before, counts)
        number = np.repeat(batch.column("sequence_id").to_numpy(zero_copy_only=False), counts)
        names = [flat.type.field(i).name for i in range(flat.type.num_fields)]
        yield pa.RecordBatch.from_arrays(
            [*flat.flatten(), pa.array(number), pa.array(offset)], names=[*names, "sequence_id", "offset"]
        )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    size: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf: int = 100_000,
    fan_in: int = 4,
) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset): every piece of every document in its sequence.

    Full pieces are sequences by themselves and never move; the rest is packed by :func:`residual_packing`.
    Null text: a document of the end id alone. Null ids and repeated rows are packed like any other row and dealt over all partitions. Ties go
    by a hash of id, piece and place in the checkpoint, so a recomputed task packs alike. No rows: no rows.
    """
    made = cut_lineage(pieces(docs, tokenizer, size, end_id, id_col, text_col))
    member = F.struct("_id", "piece", "start", "length", "ids_crc32")
    loose = made.filter(F.col("length") < size).select(member.alias("member"), "length")
    bins = residual_packing(loose, size, leaf, fan_in)
    packed = bins.withColumn("sequence_id", F.monotonically_increasing_id() * 2)  # even; full pieces have odd numbers
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
    packed = packed.mapInArrow(unpacked, f"{fields}, sequence_id bigint, offset bigint")
    alone = made.filter(F.col("length") == size).select(
        "*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(alone).withColumnRenamed("_id", id_col)
