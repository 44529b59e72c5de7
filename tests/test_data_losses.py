"""Cases in which rows, records or sizes were once lost."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import agreement as A
from tidemark.operators.costs import cost_scope
from tidemark.operators.latest import superseded_plan
from tidemark.operators.quantiles import exact_quantiles
from tidemark.sources.records import CORRUPT, read_json_or_jsonl
from tidemark.streaming.jobs import settled_upsert


def test_reader_keeps_every_good_line(spark, tmp_path):
    files = {
        "1": 'garbage\n{"a":2}',
        "2": '{"a":4}\noops\n[1]\n{"a":5}',
        "3": '{\n"a":\n7}\n',
        "4": '{"a":8}',
        "5": "\n\n",
        "6": '{"a":9}\n\n{"a":10}',
    }
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = read_json_or_jsonl(spark, str(tmp_path), T.StructType([T.StructField("a", T.LongType())])).collect()
    assert sorted(r["a"] for r in got if r["a"] is not None) == [2, 4, 5, 7, 8, 9, 10]
    assert sorted(r[CORRUPT] for r in got if r[CORRUPT] is not None) == ["[1]", "garbage", "oops"]


def test_a_record_without_path_stays_in_the_plan(frame):
    df = frame([("u", "2024-01-01", None), ("u", "2024-01-02", "p"), ("v", "2024-01-01", "q"), ("v", "2024-01-02", "p")], "u string, t string, path string")
    got = {r["u"]: r["n_records"] for r in superseded_plan(df, ["u"], "t", path="path").collect()}
    assert got == {"u": 2, "v": 2}


def test_sizes_that_do_not_exist_raise_and_large_ones_are_found(frame):
    bad = frame([("hard", 0.0, 1.0, True), ("easy", 1.0, 1.0, True)], "endpoint string, gap double, sd double, one_sided boolean")
    with pytest.raises(Exception, match="both must be positive"):
        A.required_sessions(bad).collect()
    large = frame([("hard", 0.002, 1.0, True), ("easy", 1.0, 1.0, True)], "endpoint string, gap double, sd double, one_sided boolean")
    got = {r["endpoint"]: (r["required_sessions"], r["binding"]) for r in A.required_sessions(large).collect()}
    assert got["hard"][0] > 1_000_000 and got["hard"][1] and not got["easy"][1]


COSTS = "date string, workflow_name string, scrape_age_days long, usd double"


def _feed(spark, folder, batches, path, **options):
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, COSTS).coalesce(1).write.mode("append").json(str(folder))
        stream = spark.readStream.schema(COSTS).json(str(folder))
        settled_upsert(stream, str(path), f"{path}-checkpoint", ["date", "workflow_name"], **options).awaitTermination()


def test_late_rows_are_merged(spark, tmp_path):
    first = [("d1", f"w{i}", 0, 1.0) for i in range(4)]
    _feed(spark, tmp_path / "in", [first, [("d1", "w0", 3, 9.0)]], tmp_path / "out")
    got = {r["workflow_name"]: r["usd"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"w0": 9.0, "w1": 1.0, "w2": 1.0, "w3": 1.0}


def test_a_short_full_scrape_raises_and_is_read_again(spark, tmp_path):
    first = [("d1", f"w{i}", 0, 1.0) for i in range(4)]
    with pytest.raises(Exception, match="less than"):
        _feed(spark, tmp_path / "in", [first, [("d1", "w0", 3, 9.0)]], tmp_path / "out", full_scrape=True)
    stream = spark.readStream.schema(COSTS).json(str(tmp_path / "in"))
    settled_upsert(stream, str(tmp_path / "out"), f"{tmp_path / 'out'}-checkpoint", ["date", "workflow_name"]).awaitTermination()
    got = {r["workflow_name"]: r["usd"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["w0"] == 9.0 and len(got) == 4


def test_scope_takes_a_list_of_any_length(frame):
    df = frame([(i, "2024-01-01") for i in range(3000)], "subject long, date string")
    assert cost_scope(df, subjects=range(2500)).count() == 2500
    assert cost_scope(df, subjects=[1, 2, 2]).count() == 2


def test_quantiles_of_outliers_tails_and_ties(frame):
    rng = np.random.default_rng(1)
    rows = [("far", float(x)) for x in rng.uniform(0, 1, 3000)] + [("far", 1e9)]
    rows += [("tail", float(x)) for x in rng.lognormal(0, 3, 2001)] + [("tie", 7.0)] * 50 + [("tiny", float(x)) for x in rng.normal(0, 1e-9, 500)]
    rows += [("none", None), ("odd", 5.0), ("odd", float("nan")), ("odd", float("inf")), (None, -3.0), (None, -4.5)]
    by = collections.defaultdict(list)
    for k, v in rows:
        if v is not None and np.isfinite(v):
            by[k].append(v)
    got = {r["k"]: (r["m"], r["p"]) for r in exact_quantiles(frame(rows, "k string, v double"), ["k"], "v", {"m": 0.5, "p": 0.95}).collect()}
    assert set(got) == set(by)
    for k, v in by.items():
        assert np.allclose(got[k], np.quantile(v, [0.5, 0.95]), rtol=1e-12, atol=0)


def test_last_pass_sees_few_values_under_an_outlier(frame, monkeypatch):
    from tidemark.operators import quantiles

    seen, cut = [], quantiles.cut_lineage
    monkeypatch.setattr(quantiles, "cut_lineage", lambda df: seen.append(cut(df)) or seen[-1])
    df = frame([(float(x),) for x in np.random.default_rng(3).uniform(0, 1, 20_000)] + [(1e9,)], "v double")
    exact_quantiles(df, [], "v", {"m": 0.5}).collect()
    assert seen[-1].agg(F.max(F.size("_wanted"))).first()[0] <= 2
    assert seen[1].count() == 1
