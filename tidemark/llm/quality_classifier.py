"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from tidemark.llm.common import map_texts, row_view

#: Hashed words: buckets. Structure statistics and metadata take the numbers above.
WORD_BUCKETS = 1 << 14
STATISTICS = (
    "bias words chars word_length long_words short_words symbols pipes upper digits marks non_ascii distinct top_word "
    "repeats lines line_copies meta_chars"
).split()
SYMBOLS = b"#*$%&|<>=@^~_\\{}[]"
SPACE = b" \t\n\r\x0b\x0c"

#: Rows of labels that a model is fitted on at most, chosen by a hash of the id. Scoring has no such bound.
FIT_ROWS = 12_000
#: Words whose hashes a worker remembers.
KNOWN_WORDS = 100_000


def statistics_of(text: bytes, words: list[bytes], ids: np.ndarray, chars: int | None) -> list[float]:
    """Shares and saturated logarithms in about [0, 1], in the order of STATISTICS."""
    n, size = len(words), max(len(text), 1)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = np.unique(ids, return_counts=True)[1] if n else np.zeros(1, np.int64)
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper = size - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return [
        1.0,
        min(np.log1p(n) / 10, 1.5),
        min(np.log1p(len(text)) / 14, 1.5),
        min(float(lengths.mean()) / 12, 2.0) if n else 0.0,
        float((lengths > 12).mean()) if n else 0.0,
        float((lengths < 4).mean()) if n else 0.0,
        min(5 * (size - len(text.translate(None, SYMBOLS))) / size, 2.0),
        text.count(b" | ") / max(n, 1),
        upper / size,
        (size - len(text.translate(None, b"0123456789"))) / size,
        min(10 * (text.count(b"!") + text.count(b"?")) / size, 2.0),
        sum(text.count(bytes([c])) for c in (0xC3, 0xC4, 0xC5)) / size,
        len(counts) / max(n, 1),
        float(counts.max()) / max(n, 1),
        float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
        min(np.log1p(len(lines)) / 8, 1.5),
        1 - len(set(lines)) / max(len(lines), 1),
        min(np.log1p(max(chars or 0, 0)) / 14, 1.5),
    ]


class Features:
    """Sparse features of texts; hashes of words seen are remembered up to a bound."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None, chars: int | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or b""
        words = text.split()
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxh32_intdigest(w.lower().strip(b".,;:!?"), 7) % WORD_BUCKETS
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        if len(ids):
            index, counts = np.unique(ids, return_counts=True)
            value = np.log1p(counts)
            value /= np.sqrt((value**2).sum())
        else:
            index, value = np.zeros(0, np.int64), np.zeros(0)
        stats = np.array(statistics_of(text, words, ids, chars))
        return np.concatenate([index, WORD_BUCKETS + np.arange(len(stats))]), np.concatenate([value, stats])


_FEATURES = Features()


@dataclass
class FactorisationMachine:
    """score = sigmoid(bias + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): linear in the features."""

    w: np.ndarray
    v: np.ndarray
    bias: float = 0.0

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        xv = self.v[index] * value[:, None]
        total = xv.sum(axis=0)
        return self.bias + float(self.w[index] @ value) + 0.5 * float(total @ total - (xv * xv).sum())

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(index, value), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = 8, epochs: int = 6, rate: float = 0.05,
        decay: float = 1e-6, batch: int = 64, seed: int = 5) -> FactorisationMachine:
    """AdaGrad on the logistic loss, in batches whose gradients are scattered onto the features they hold. No rows: score 0.5."""
    rng = np.random.default_rng(seed)
    width = WORD_BUCKETS + len(STATISTICS)
    fm = FactorisationMachine(np.zeros(width), rng.normal(0, 0.02 if rows else 0.0, (width, rank)))
    g_w, g_v, g_b = np.full(width, 1e-6), np.full((width, rank), 1e-6), 1e-6
    for _ in range(epochs if rows else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            sizes = np.array([len(rows[i][0]) for i in chosen])
            index = np.concatenate([rows[i][0] for i in chosen])
            value = np.concatenate([rows[i][1] for i in chosen])
            firsts = np.cumsum(sizes) - sizes
            xv = fm.v[index] * value[:, None]
            total = np.add.reduceat(xv, firsts)
            square = np.add.reduceat((xv * xv).sum(axis=1), firsts)
            raw = fm.bias + np.add.reduceat(fm.w[index] * value, firsts) + 0.5 * ((total**2).sum(axis=1) - square)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) / len(chosen)
            e = np.repeat(error, sizes)
            used, where = np.unique(index, return_inverse=True)
            d_w = np.bincount(where, e * value, len(used)) + decay * fm.w[used]
            slope = (e * value)[:, None] * (np.repeat(total, sizes, axis=0) - xv)
            d_v = np.stack([np.bincount(where, slope[:, f], len(used)) for f in range(rank)], axis=1) + decay * fm.v[used]
            g_w[used] += d_w**2
            g_v[used] += d_v**2
            g_b += error.sum() ** 2
            fm.w[used] -= rate * d_w / np.sqrt(g_w[used])
            fm.v[used] -= rate * d_v / np.sqrt(g_v[used])
            fm.bias -= rate * error.sum() / np.sqrt(g_b)
    return fm


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves 0 modulo 5; null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, chars_col: str | None, label_col: str,
                  rows: int = FIT_ROWS) -> DataFrame:
    """(_text, chars, label) of at most `rows` labelled documents that are not held out, chosen by a hash of the id.

    The bounded id list is broadcast, so texts are not shuffled. An id labelled more than once has its smallest label; rows
    with a null id or label are not used.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isNotNull() & ~held_out("_id")
    )
    known = known.groupBy("_id").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(rows)
    return _view(docs, id_col, text_col, chars_col).join(F.broadcast(chosen), "_id").select("_id", "_text", "chars", "label")


def _view(docs: DataFrame, id_col: str, text_col: str, chars_col: str | None) -> DataFrame:
    if chars_col is not None and chars_col in docs.columns:
        view = row_view(docs, id_col, text_col, chars=chars_col)
        return view.withColumn("chars", F.col("chars").cast("long"))
    return row_view(docs, id_col, text_col).withColumn("chars", F.length("_text").cast("long"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          chars_col: str | None = "n_chars", label_col: str = "quality", rows: int = FIT_ROWS) -> FactorisationMachine:
    """Fit on a bounded sample: features are made in tasks, the driver gets at most `rows` of them."""
    def work(texts, batch):
        made = [_FEATURES(t, c) for t, c in zip(texts, batch.column("chars").to_pylist(), strict=True)]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(i) for i, _ in made])]), pa.int32())
        index = np.concatenate([i for i, _ in made]).astype(np.int32) if made else np.zeros(0, np.int32)
        value = np.concatenate([v for _, v in made]).astype(np.float32) if made else np.zeros(0, np.float32)
        return {
            "features": pa.ListArray.from_arrays(offsets, pa.array(index)),
            "amounts": pa.ListArray.from_arrays(offsets, pa.array(value)),
        }

    sample = training_rows(docs, labels, id_col, text_col, chars_col, label_col, rows)
    table = map_texts(sample, "features array<int>, amounts array<float>", work, ("_id", "label"), ("chars",))
    # a copied row of a document must not outgrow the bound
    table = table.groupBy("_id").agg(*(F.first(c).alias(c) for c in ("label", "features", "amounts")))
    model = _fitted(table.select("_id", "label", "features", "amounts").toArrow())
    pa.default_memory_pool().release_unused()
    return model


def _fitted(got: pa.Table) -> FactorisationMachine:
    """The fit over the fetched rows by id, through views of the Arrow buffers: no Python object per feature, no sorted copy."""
    order = pc.sort_indices(got, sort_keys=[("_id", "ascending")]).to_numpy()
    rows: list[list[np.ndarray]] = []
    for name in ("features", "amounts"):
        views = []
        for chunk in got.column(name).chunks:
            ends = np.cumsum(chunk.value_lengths().to_numpy(zero_copy_only=False))[:-1]
            views += np.split(chunk.flatten().to_numpy(), ends) if len(chunk) else []
        rows.append(views)
    return fit([(rows[0][i], rows[1][i]) for i in order], got.column("label").to_numpy()[order].astype(float))


def quality_scores(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text",
                   chars_col: str | None = "n_chars", threshold: float = 0.3) -> DataFrame:
    """(id_col, held_out, score, predicted), one row per row of `docs`; each text is read whole, in a map without a shuffle.

    Null and empty texts are scored from their statistics alone. A null id is held out. Repeated rows each get their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.w, model.v, model.bias))

    def work(texts, batch):
        fm = FactorisationMachine(*shared.value)
        chars = batch.column("chars").to_pylist()
        return {"score": pa.array([fm.score(*_FEATURES(t, c)) for t, c in zip(texts, chars, strict=True)], pa.float64())}

    scored = map_texts(_view(docs, id_col, text_col, chars_col), "score double", work, uses=("chars",))
    return scored.select(
        F.col("_id").alias(id_col),
        held_out("_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: FactorisationMachine, text_col: str = "text", chars_col: str | None = "n_chars",
              threshold: float = 0.3) -> DataFrame:
    """The rows of `docs`, with all their columns, whose score reaches `threshold`: a map without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast((model.w, model.v, model.bias))
    chars = F.col(f"`{chars_col}`").cast("long") if chars_col in docs.columns else F.length(F.col(f"`{text_col}`")).cast("long")
    names = docs.columns
    extra = "_chars_of_text"
    while extra in names:
        extra += "_"
    place = names.index(text_col)

    def run(batches):
        fm = FactorisationMachine(*shared.value)
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                texts, counts = part.column(place).to_pylist(), part.column(len(names)).to_pylist()
                made = [fm.score(*_FEATURES(t.encode() if t is not None else None, c)) for t, c in zip(texts, counts, strict=True)]
                kept = part.filter(pa.array([x >= threshold for x in made], pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns[: len(names)], names=names)

    return docs.withColumn(extra, chars).mapInArrow(run, docs.schema)
