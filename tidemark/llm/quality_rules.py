"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target to the raw corpus, with plain structure rules."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import map_texts, measured, row_view

#: Buckets of hashed word unigrams and bigrams; the model is two counts per bucket, whatever the corpus.
BUCKETS = 1 << 14
SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """64-bit numbers of words, remembered up to a bound."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxh64_intdigest(w, 11)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


_WORDS = Words()


def grams(numbers: np.ndarray) -> np.ndarray:
    """Buckets of all unigrams and bigrams of a text."""
    if not len(numbers):
        return np.zeros(0, np.int64)
    pairs = (numbers[:-1] * _MULTIPLIER) ^ (numbers[1:] + (numbers[:-1] >> np.uint64(7)))
    mixed = np.concatenate([numbers, pairs * _MULTIPLIER])
    return (mixed >> np.uint64(64 - 14)).astype(np.int64)


def repeated_words(numbers: np.ndarray, size: int = 8) -> int:
    """Words inside windows of `size` words that occur at least twice in the text."""
    n = len(numbers) - size + 1
    if n < 2:
        return 0
    windows = np.zeros(n, np.uint64)
    for i in range(size):
        windows = (windows ^ numbers[i : i + n]) * _MULTIPLIER
        windows ^= windows >> np.uint64(29)
    order = np.sort(windows)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    edge = np.zeros(len(numbers) + 1, np.int64)
    starts = np.flatnonzero(counts[where] > 1)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def structure(text: bytes, words: list[bytes], numbers: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    chars = len(text.decode()) - (len(text) - len(text.translate(None, SPACE)))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return chars, symbols, len(lines) - len(set(lines)), repeated_words(numbers)


def gram_counts(docs: DataFrame, trusted: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, raw, target): counts of all n-grams of the corpus and of its trusted documents.

    `trusted`: distinct ids. A task adds up its texts and yields one row per bucket, so the shuffle carries tasks x buckets
    rows and no text; the id list is broadcast while it is small and joined by a shuffle beyond that.
    """
    view = row_view(docs, id_col, text_col)
    if trusted is None:
        view = view.withColumn("trust", F.lit(False))
    else:
        ids = trusted.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct().withColumn("trust", F.lit(True))
        view = view.join(measured(ids), "_id", "left").withColumn("trust", F.coalesce("trust", F.lit(False)))

    def count(batches):
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, trust in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(grams(_WORDS((text.as_py() or b"").split())), minlength=BUCKETS)
                sums[0] += found
                if trust:
                    sums[1] += found
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(sums[0][used]), pa.array(sums[1][used])], names=["bucket", "raw", "target"]
        )

    parts = view.select(F.col("_text").cast("binary"), "trust").mapInArrow(count, "bucket int, raw bigint, target bigint")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """log(p target / p raw) per bucket, smoothed; BUCKETS numbers reach the driver. No counts: zeros."""
    got = counts.toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[got.column("bucket").to_numpy()] = got.column("raw").to_numpy()
    target[got.column("bucket").to_numpy()] = got.column("target").to_numpy()
    if not target.sum():
        return np.zeros(BUCKETS)
    p = (target + smoothing) / (target.sum() + smoothing * BUCKETS)
    q = (raw + smoothing) / (raw.sum() + smoothing * BUCKETS)
    return np.log(p) - np.log(q)


def quality_verdicts(
    docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = -0.12
) -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept), one row per row of `docs`.

    llr is the mean log ratio of the text's unigrams and bigrams, so long and short texts compare; `kept` is a fixed cut of
    it (>= `threshold`), drawn from no random number, after the structure rules. Every text is read whole.
    Null and empty texts have no words and fail the base rules; their llr is 0. Repeated rows each get their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def work(texts, _):
        rows = []
        for text in texts:
            text = text or b""
            words = text.split()
            numbers = _WORDS(words)
            found = grams(numbers)
            # counts times ratios in bucket order: the sum doesn't depend on the order of the words
            rows.append((len(words), *structure(text, words, numbers), float(shared.value[np.sort(found)].mean()) if len(found) else 0.0))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        made = {n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=False)}
        return made | {"llr": pa.array(columns[5], pa.float64())}

    made = map_texts(row_view(docs, id_col, text_col), ", ".join(f"{n} bigint" for n in names) + ", llr double", work)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return made.withColumnRenamed("_id", id_col).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.round("llr", 9) >= threshold)
    )
