"""The pipeline's stages on the smallest given tables and on hand-made rows."""

import collections
import re

import corpus_pipeline
import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


def test_stages_keep_columns_and_shrink(staged):
    names = [n for n, _ in corpus_pipeline.STAGES]
    counts = [staged[n].count() for n in ("documents", *names[:-1])]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    for n in names[:-1]:
        assert staged[n].columns == staged["documents"].columns


def test_each_document_kept_is_packed_whole(staged):
    kept = {r["doc_id"] for r in staged["secret_scan"].collect()}
    assert {r["doc_id"] for r in staged["best_fit_packing"].collect()} == kept


def test_no_benchmark_window_and_no_secret_is_left(spark, staged):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    before, after = ({r["doc_id"]: r["text"] for r in staged[n].collect()} for n in ("simhash_dedup", "decontamination"))
    hit = {i for i, t in before.items() for w in [words(t)] if any(tuple(w[k : k + 10]) in windows for k in range(len(w)))}
    assert set(before) - set(after) == hit
    for r in staged["secret_scan"].collect():
        assert not re.search("[0-9a-f]{24,}", r["text"])
        assert "[secret]" in r["text"] or r["text"] == after[r["doc_id"]]
        assert len(r["text"]) == r["n_chars"]


def test_copies_leave_one(spark, staged):
    texts = collections.Counter(r["text"] for r in staged["simhash_dedup"].collect())
    assert max(texts.values()) == 1
    gone = {r["text"] for r in staged["quality_classifier"].collect()}
    assert set(texts) <= gone


def test_stages_take_odd_rows(spark):
    rows = [(1, None, "en", "s", None), (2, "", "en", None, 0), (2, "", "en", None, 0), (None, "a b c", None, "s", 5), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, FOLDER)
        if name == "simhash_dedup":
            assert docs.count() == 2
    assert docs.count() == 2
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), FOLDER).count() == 0, name


def test_run_is_repeatable(spark):
    one, two = ({(r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, FOLDER).collect()} for _ in range(2))
    assert one == two and one
