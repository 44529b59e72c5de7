"""Quantiles, trimmed sums and ranks against numpy: ties, outliers, heavy tails, missing keys and both ways of narrowing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles as Q
from tidemark.operators.ordered import upto_here

PROBS = {"p05": 0.05, "median": 0.5, "p95": 0.95, "high": 1.0}


def groups():
    rng = np.random.default_rng(4)
    return {
        "uniform": rng.uniform(0, 1, 3000),
        "outlier": np.append(rng.uniform(5, 6, 2000), 1e9),
        "tail": np.exp(rng.normal(0, 8, 2000)) * rng.choice([-1, 1], 2000),
        "ties": rng.integers(0, 4, 1500).astype(float),
        "one": np.array([7.0]),
        None: rng.normal(100, 1e-6, 800),
    }


@pytest.fixture(scope="module")
def values(spark):
    rows = [(k, float(x)) for k, v in groups().items() for x in v]
    rows += [("ties", None), ("one", math.nan), ("uniform", math.inf), ("empty", None)]
    return spark.createDataFrame(rows, "k string, x double").repartition(6).cache()


@pytest.mark.parametrize("cell_rows", [200_000, 0])
def test_quantiles(values, monkeypatch, cell_rows):
    monkeypatch.setattr(Q, "CELL_ROWS", cell_rows)
    got = {r["k"]: r for r in Q.exact_quantiles(values, ["k"], "x", PROBS).collect()}
    assert set(got) == set(groups())
    for k, v in groups().items():
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(np.quantile(v, p), rel=1e-12), (k, name)


@pytest.mark.parametrize("trim", [0.0, 0.1, 0.2, 0.49])
@pytest.mark.parametrize("cell_rows", [200_000, 0])
def test_trimmed_sums(values, monkeypatch, trim, cell_rows):
    monkeypatch.setattr(Q, "CELL_ROWS", cell_rows)
    got = {r["k"]: r for r in Q.trimmed_sums(values, ["k"], "x", trim).collect()}
    assert set(got) == set(groups())
    for k, v in groups().items():
        cut = math.floor(trim * len(v))
        kept = np.sort(v)[cut : len(v) - cut]
        r = got[k]
        assert (r["n"], r["cut"], r["low"], r["high"]) == (len(v), cut, kept[0], kept[-1])
        assert r["s1"] == pytest.approx(math.fsum(kept), rel=1e-9, abs=1e-9 * np.abs(kept).sum())
        assert r["s2"] == pytest.approx(math.fsum(kept**2), rel=1e-9)


def test_mid_ranks(values):
    got = Q.mid_ranks(values, ["k"], "x", "rank").collect()
    assert len(got) == values.count()
    for k, v in groups().items():
        held = sorted((r["x"], r["rank"]) for r in got if r["k"] == k and r["x"] is not None and math.isfinite(r["x"]))
        order = np.sort(v)
        want = (np.searchsorted(order, order, "left") + np.searchsorted(order, order, "right") + 1) / 2
        assert [x for x, _ in held] == order.tolist() and [r for _, r in held] == want.tolist()
    assert all(r["rank"] is None for r in got if r["x"] is None or math.isnan(r["x"]))


def test_an_outlier_changes_no_tasks_share(spark):
    """A hot key of uniform values is dealt out evenly, with and without a value of 1e9 among them."""
    for extra in (0.5, 1e9):
        rows = spark.range(20_000).select(F.lit("hot").alias("k"), (F.hash("id") / 4e9 + 0.5).alias("x"), F.lit(1).alias("w"))
        rows = rows.unionByName(spark.createDataFrame([("hot", extra, 1)], "k string, x double, w int"))
        shares = rows.repartitionByRange(8, "k", "x").groupBy(F.spark_partition_id()).count().collect()
        assert len(shares) == 8 and max(r["count"] for r in shares) < 20_000 / 8 * 1.5
        last = upto_here(rows, "k", ["x"], "w", "to").agg(F.max("to"), F.count_distinct("to")).first()
        assert last[0] == 20_001 and last[1] == 20_001
