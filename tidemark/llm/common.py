"""Helpers of the corpus operators: column views, measured joins, batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir, cut_lineage

#: Rows of a key table (one id and one hash each) up to which it is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000

#: A Java class of what belongs to a word of letters and digits: ASCII letters and digits and all that is not ASCII.
WORD_CLASS = r"0-9A-Za-z\x{80}-\x{10FFFF}"
WORD = rf"[{WORD_CLASS}]+"

__all__ = ["BROADCAST_ROWS", "WORD", "WORD_CLASS", "ascii_lower", "cut_lineage", "map_texts", "measured", "row_view", "written"]


def row_view(docs: DataFrame, id_col: str, text_col: str, **more: str) -> DataFrame:
    """Only the named columns, as `_id`, `_text` and the names of `more`: other columns cannot clash."""
    picked = [F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")]
    return docs.select(*picked, *(F.col(f"`{c}`").alias(name) for name, c in more.items()))


def measured(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for a broadcast if it has no more than `rows` rows. The count is one pass over a narrow table;
    with more rows the plan stays a shuffle join with the same result."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def written(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the shared checkpoint folder, read again.

    For loops: a checkpoint hands the sort order and the constraints known of its rows on to the next plan, with every column
    that was ever joined equal to them, and over some rounds of merge joins the driver plans for minutes. A table read
    from files carries nothing but its rows."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else; whole-ASCII texts take the fast way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def map_texts(
    docs: DataFrame, schema: str, work: Callable[[list[bytes | None], pa.RecordBatch], dict], columns: tuple[str, ...] = ("_id",),
    uses: tuple[str, ...] = (),
) -> DataFrame:
    """`work(texts, batch)` for each Arrow batch of `_text` as UTF-8 bytes and the columns `columns` and `uses`; `work` returns
    output columns by name, `columns` are passed on in front of them."""
    kept = {f.name: f.dataType.simpleString() for f in docs.schema.fields if f.name in columns}
    out = ", ".join([*(f"`{c}` {kept[c]}" for c in columns), schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = work(part.column("_text").to_pylist(), part)
                arrays = [part.column(c) for c in columns] + [
                    v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v) for v in made.values()
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *made])

    picked = docs.withColumn("_text", F.col("_text").cast("binary"))
    return picked.select("_text", *columns, *uses).mapInArrow(run, out)
