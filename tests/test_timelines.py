"""Hand-made cases for intervals, as-of joins, pairing, series and ordered operators."""

import random

from pyspark.sql import functions as F

from tidemark.operators import intervals as I
from tidemark.operators import series as S
from tidemark.operators.ordered import DAY_US, next_value, previous_value, row_position, running_sum, time_chunk
from tidemark.operators.quantiles import exact_quantiles


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_union_merges_touching_intervals(frame):
    df = frame([("k", 0, 10), ("k", 10, 12), ("k", 11, 20), ("k", 30, 31), ("k", 5, 5)], "k string, s bigint, e bigint")
    assert rows(I.union_length(df, ["k"], "s", "e")) == [("k", 21)]
    assert rows(I.union_length(df, ["k"], "s", "e", width_us=7)) == [("k", 21)]


def test_overlapping_intervals_share_their_time(frame):
    df = frame([("k", 1, 0, 10), ("k", 2, 0, 10), ("k", 3, 20, 24), ("k", 4, 9, 9)], "k string, i int, s bigint, e bigint")
    for width in (DAY_US, 3):
        out = I.concurrency_shares(df, ["k"], ["i"], "s", "e", width_us=width)
        assert [(i, round(x, 9)) for i, x in rows(out, "i", "share_us")] == [(1, 5.0), (2, 5.0), (3, 4.0), (4, 0.0)]


def test_occupancy_of_the_other_pods(frame):
    schema = "n string, p int, s bigint, e bigint, cpu double, cap double"
    pods = frame([("n", 1, 0, 10, 2.0, 8.0), ("n", 2, 5, 15, 4.0, 8.0), ("m", 3, 0, 10, 8.0, 8.0)], schema)
    out = I.occupied_fraction(pods, pods, ["n"], ["p"], "s", "e", "cpu", "cap", width_us=4)
    assert [(p, round(x, 9)) for p, x in rows(out, "p", "occupied_frac")] == [(1, 0.25), (2, 0.125), (3, 0.0)]


def test_node_of_a_pod(frame):
    nodes = frame(
        [("one", "i1", 0, 10, "m5", ""), ("two", "i2", 0, 10, "m5", ""), ("two", "i3", 20, 30, "c5", ""), ("both", "i4", 0, 20, "m5", ""), ("both", "i5", 10, 30, "m5", ""), ("odd", "i6", 0, 9, "m5", "c5")],
        "host string, instance string, ns bigint, ne bigint, ntype string, label string",
    )
    pods = frame(
        [("one", 1, 90, 99, "m5"), ("two", 2, 21, 25, "c5"), ("two", 3, 11, 15, ""), ("both", 4, 1, 5, ""), ("none", 5, 1, 2, ""), ("two", 6, 1, 5, "c5"), ("odd", 7, 1, 2, "")],
        "host string, pod int, ps bigint, pe bigint, ptype string",
    )
    out = I.contained_in_one(pods, nodes, ["host"], ["pod"], ("ps", "pe"), ("ns", "ne"), "instance", "ptype", "ntype", "label")
    assert rows(out, "pod", "reason", "instance") == [
        (1, "MATCHED", "i1"), (2, "MATCHED", "i3"), (3, "AMBIGUOUS", None), (4, "AMBIGUOUS", None), (5, "NO_ASSET", None), (6, "TYPE_MISMATCH", None),
        (7, "INCONSISTENT_ASSET", None),
    ]


def test_run_of_a_pod_by_its_start(frame):
    minute = 60_000_000
    runs = frame([("w", "a", 10 * minute, 20 * minute), ("w", "b", 50 * minute, None)], "w string, run string, s bigint, e bigint")
    pods = frame([("w", 1, 9 * minute), ("w", 2, 30 * minute), ("w", 3, 5 * minute), ("w", 4, 55 * minute), ("w", 5, None)], "w string, pod int, at bigint")
    out = S.assign_by_window(pods, runs, ["w"], ["pod"], "at", "run", "s", "e")
    assert rows(out, "pod", "run") == [(1, "a"), (2, "a"), (3, None), (4, "b"), (5, None)]


def test_source_at_the_same_instant_is_not_attached(frame):
    probes = frame([("k", 1, 100), ("k", 2, 50), ("k", 3, None)], "k string, id int, t bigint")
    sources = frame([("k", "p", 50), ("k", "q", 99)], "k string, name string, t bigint")
    out = S.asof_earlier(probes, sources, ["k"], "t", "t", ["name"], chunk_us=10)
    assert rows(out, "id", "asof_name") == [(1, "q"), (2, None), (3, None)]


def test_adjacent_pairing(frame):
    kinds = ["AP", "PA", "AP", "PA", None, "AP", "combined", "PA", "PA", "AP"]
    df = frame([("k", i, d) for i, d in enumerate(kinds)], "k string, t bigint, dir string").withColumn("chunk", F.floor(F.col("t") / 3))
    out = S.pair_adjacent(df, ["k"], ["t"], "dir", "chunk")
    got = [r["role"] for r in out.orderBy("t").collect()]
    assert got == ["pair_first", "pair_second"] * 2 + [None, "unpaired", "single", "unpaired", "pair_first", "pair_second"]


def test_series_statuses(frame):
    second = 1_000_000
    series = frame(
        [("s", "a", "T1w", "T1w", True, "u1", 10 * second), ("s", "b", "T1w", "T1w", False, "zz", 14 * second), ("s", "c", "rest", "bold", False, "u2", 0),
         ("s", "d", "rest", "bold", False, "u2", 0), ("s", "e", "rest", "bold", False, None, 0), ("s", "f", "nback", "bold", False, "u3", 0), ("s", "g", "rest", "bold", False, "u4", 9 * second), ("s", "h", "rest", "bold", False, "u9", 0)],
        "session string, series_id string, table string, kind string, norm boolean, uid string, acquired_us bigint",
    )
    runs = frame(
        [("s", "T1w", 1, "u1", 10 * second), ("s", "rest", 1, "u2", 0), ("s", "rest", 2, "u4", 0)],
        "session string, table string, run_index int, uid string, acquired_us bigint",
    )
    out = S.match_series(series, runs, runs)
    assert rows(out, "series_id", "status") == [
        ("a", "matched"), ("b", "twin_matched"), ("c", "ambiguous"), ("d", "ambiguous"), ("e", "no_uid"), ("f", "no_qc_row"), ("g", "timestamp_mismatch"), ("h", "unmatched"),
    ]


def test_chunked_neighbours_match_a_plain_scan(frame):
    rng = random.Random(3)
    data = [("k" if rng.random() < 0.7 else "l", rng.randrange(50) * DAY_US // 7 + i, rng.randrange(100)) for i in range(400)]
    df = frame(data, "k string, t bigint, v int").withColumn("c", time_chunk("t", DAY_US))
    out = previous_value(df, ["k"], ["t"], F.col("v"), "p", "c")
    out = next_value(out, ["k"], ["t"], F.col("v"), "n", "c")
    out = running_sum(out, ["k"], ["t"], F.col("v"), "r", "c")
    out = row_position(out, ["k"], ["t"], "i", "c")
    want = []
    for key in "kl":
        line = sorted((t, v) for k, t, v in data if k == key)
        total = 0
        for i, (t, v) in enumerate(line):
            total += v
            want.append((key, t, line[i - 1][1] if i else None, line[i + 1][1] if i + 1 < len(line) else None, total, i + 1))
    assert rows(out, "k", "t", "p", "n", "r", "i") == sorted(want, key=str)


def test_quantiles_of_a_skewed_group(frame):
    import numpy as np

    rng = np.random.default_rng(1)
    hot = np.concatenate([rng.lognormal(0, 4, 3000), np.full(2000, 7.0)])
    data = [("hot", float(x)) for x in hot] + [("one", 5.0), (None, 1.0), (None, 3.0), ("hot", None)]
    out = {r["k"]: r for r in exact_quantiles(frame(data, "k string, x double"), ["k"], "x", {"p05": 0.05, "p50": 0.5, "p99": 0.99}).collect()}
    for name, q in (("p05", 5), ("p50", 50), ("p99", 99)):
        assert abs(out["hot"][name] - np.percentile(hot, q)) <= 1e-9 * max(1.0, np.percentile(hot, q))
    assert out["one"]["p50"] == 5.0 and out[None]["p50"] == 2.0
