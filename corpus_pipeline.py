"""A training-text pipeline over `documents`: each stage works on all that the one before it kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.best_fit_packing import pack_documents
from tidemark.llm.common import measured
from tidemark.llm.decontamination import benchmark_matches
from tidemark.llm.quality_classifier import keep_good, train
from tidemark.llm.secret_scan import find_secrets
from tidemark.llm.simhash_dedup import near_groups
from tidemark.session import checkpoint_dir


#: Whole texts are long rows: batches of no more of them bound what the JVM and Python workers hold beside the heap.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """`docs` less those whose id and text hash are in `rows` (_id, key); null ids are equal to each other. Texts of one id count as
    equal if their 64-bit hashes are."""
    gone = measured(rows.select(F.col("_id").alias("gone_id"), F.col("key").alias("gone_key")).distinct())
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_key")), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; null and empty texts are scored like any other. Columns of any name are kept."""
    _small_batches(spark)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 and more of five-word shingles, the one with the least id.

    Texts without words, null and empty ones too, are one group. A null id is the least; of rows equal in id and text one stays."""
    _small_batches(spark)
    groups = near_groups(docs, size=5, similarity=0.8)
    groups = groups.select("_id", "key", F.struct("_id", "key").eqNullSafe(F.col("winner")).alias("wins"))
    kept = _without(docs, groups.filter("not wins"))
    # a winner that stands in the table more than once, the same id and text, stays once
    again = groups.filter("wins").groupBy("_id", "key").count().filter("count > 1")
    single = _without(kept, again)
    many = measured(again.select(F.col("_id").alias("many_id"), F.col("key").alias("many_key")))
    copies = kept.join(many, F.col("doc_id").eqNullSafe(F.col("many_id")) & (F.xxhash64("text") == F.col("many_key")), "left_semi")
    return single.unionByName(copies.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item stands; null and empty texts stay, as do all without items."""
    return _without(docs, benchmark_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret found is replaced by `[secret]`, and n_chars follows. Texts without one, and null ones, stay as they are."""
    found = find_secrets(docs).filter(F.size("spans") > 0).distinct()
    found = measured(found.select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key"), "spans"))
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.xxhash64("text") == F.col("hit_key")), "left")
    none = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    masked = F.aggregate(
        "spans",
        none,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(acc["out"], F.substr("text", (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("[secret]")).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substr("text", (acc["at"] + 1).cast("int"))),
    )
    text = F.when(F.col("spans").isNotNull(), masked).otherwise(F.col("text"))
    chars = F.when(F.col("spans").isNotNull(), F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return joined.select(*({"text": text, "n_chars": chars}.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document kept, null and empty texts too, cut and packed into sequences of at most 1024 tokens."""
    _small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), size=1024)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", packing),
]

# a fitted model, group fingerprints and packing are no SQL; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written as Parquet into the shared folder and read again."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir.rstrip("/"))
        if name != STAGES[-1][0]:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
