"""Signal measures, agreement, tails, sampling and outcome rules against numpy or values worked out by hand."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.functions import tails
from tidemark.operators import agreement as A
from tidemark.operators import efficiency as E
from tidemark.operators import outcomes as O
from tidemark.operators import quantiles
from tidemark.operators import sampling as Q
from tidemark.operators import signal as S
from tidemark.operators import statistics as ST
from tidemark.sources import stats_text as X
from tidemark.sources import wide_runs as W


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


@pytest.fixture(scope="module")
def volume():
    rng = np.random.default_rng(5)
    data = rng.normal(100, 10, (40, 25))
    data[3] = 50.0
    data[7, 4] = 400.0
    return data


@pytest.fixture(scope="module")
def voxels(spark, volume):
    return spark.createDataFrame([("r", i, [float(v) for v in s]) for i, s in enumerate(volume)], "run string, voxel int, series array<double>")


def test_tsnr_and_gcor(voxels, volume):
    sd = volume.std(axis=1)
    want = np.where(sd > 0, volume.mean(axis=1) / np.where(sd > 0, sd, 1), 0)
    got = S.tsnr(voxels).orderBy("voxel").toPandas()["tsnr"].to_numpy()
    assert got[3] == 0 and np.allclose(got, want)
    assert S.tsnr_median(voxels, ["run"]).first()["tsnr_median"] == pytest.approx(np.median(want))
    unit = volume - volume.mean(axis=1, keepdims=True)
    norm = np.linalg.norm(unit, axis=1, keepdims=True)
    unit = np.divide(unit, norm, out=unit, where=norm > 0)
    assert S.global_correlation(voxels, ["run"]).first()["gcor"] == pytest.approx(float((unit.mean(axis=0) ** 2).sum()))


def test_outliers_and_quality(voxels, volume):
    res = np.abs(volume - np.median(volume, axis=1, keepdims=True))
    mad = np.median(res, axis=1, keepdims=True)
    want = ((mad > 0) & (res > S.outlier_alpha(25) * mad)).mean(axis=0)
    got = S.outlier_fraction(voxels, ["run"]).orderBy("frame").toPandas()["outlier_frac"].to_numpy()
    assert want[4] > 0 and np.allclose(got, want)

    def rank(x):
        return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])

    ref = rank(np.median(volume, axis=1))
    want = [1 - np.corrcoef(rank(volume[:, t]), ref)[0, 1] for t in range(25)]
    got = S.quality_index(voxels, ["run"]).orderBy("frame").toPandas()["quality_index"].to_numpy()
    assert np.allclose(got, want)


def test_ties_share_their_rank(frame):
    df = frame([("k", 1.0), ("k", 2.0), ("k", 2.0), ("k", 9.0)], "k string, x double")
    assert [r["r"] for r in quantiles.mid_ranks(df, ["k"], "x", "r").orderBy("x").collect()] == [1.0, 2.5, 2.5, 4.0]


def test_noise_components_are_left_singular_vectors(voxels, volume):
    basis = S.cosine_basis(25, 1.0, 20.0)
    m = volume.T - basis @ np.linalg.lstsq(basis, volume.T, rcond=None)[0]
    sd = m.std(axis=0)
    m = m / np.where(sd < 1e-12, 1.0, sd)
    u, s, _ = np.linalg.svd(m, full_matrices=False)
    share = np.cumsum(s**2) / (s**2).sum()
    got = S.noise_components(voxels, "run", 1.0, 0.5, period=20.0).orderBy("component").toPandas()
    assert len(got) == int(np.searchsorted(share, 0.5) + 1)
    assert np.allclose(got["cumulative_variance"], share[: len(got)], atol=1e-6)
    assert abs(float(np.dot(got["vector"][0], u[:, 0]))) == pytest.approx(1.0, abs=1e-4)


def test_subspace_of_itself_and_of_an_orthogonal_one(frame):
    a = frame([("r", [1.0, 0.0, 0.0, 0.0]), ("r", [0.0, 1.0, 0.0, 0.0])], "run string, vector array<double>")
    b = frame([("r", [1.0, 1.0, 0.0, 0.0]), ("r", [1.0, -1.0, 0.0, 0.0])], "run string, vector array<double>")
    c = frame([("r", [0.0, 0.0, 1.0, 0.0])], "run string, vector array<double>")
    assert S.subspace_agreement(a, b, ["run"]).first()["distance"] == pytest.approx(0.0, abs=1e-12)
    assert S.subspace_agreement(a, c, ["run"]).first()["distance"] == pytest.approx(1.0)


def test_tails_against_published_values():
    assert tails.t_ppf(0.95, 10) == pytest.approx(1.8124611, abs=1e-6)
    assert tails.t_ppf(0.975, 1) == pytest.approx(12.7062047, abs=1e-5)
    assert tails.f_ppf(0.95, 5, 10) == pytest.approx(3.3258345, abs=1e-5)
    assert tails.chi2_ppf(0.95, 10) == pytest.approx(18.3070381, abs=1e-5)
    assert tails.binomial_cdf(2, 10, 0.5) == pytest.approx(56 / 1024, abs=1e-12)
    assert float(tails.noncentral_t_cdf(1.5, 8, 0.0)[0]) == pytest.approx(float(tails.t_cdf(1.5, 8)), abs=1e-9)
    # Clopper–Pearson with no successes: 1 − α^(1/n)
    assert tails.beta_ppf(0.95, 1, 20) == pytest.approx(1 - 0.05 ** (1 / 20), abs=1e-10)


def test_identical_arms_are_equivalent(frame):
    df = frame([("e", float(x), float(x)) for x in range(5)], "endpoint string, a double, b double")
    r = A.tost(df, ["endpoint"], F.col("a") - F.col("b"), 1.0).first()
    assert r["verdict"] == A.EQUIVALENT and r["p_value"] == 0.0
    assert A.icc_agreement(df, ["endpoint"], "a", "b").first()["icc"] == pytest.approx(1.0)
    assert A.icc_interval(A.icc_agreement(df, ["endpoint"], "a", "b")).first()["icc_low"] == pytest.approx(1.0)


def test_tost_interval_by_hand(frame):
    d = np.array([0.1, -0.2, 0.3, 0.05, float("nan")])
    r = A.tost(frame([("e", float(x)) for x in d], "endpoint string, d double"), ["endpoint"], "d", 0.5).first()
    x = d[:4]
    half = 2.3533634 * x.std(ddof=1) / 2
    assert r["n"] == 4 and r["ci_low"] == pytest.approx(x.mean() - half, abs=1e-6) and r["verdict"] == A.EQUIVALENT


def test_icc_two_way_from_anova(frame):
    rng = np.random.default_rng(2)
    a = rng.normal(0, 2, 30)
    b = a + rng.normal(0.5, 1, 30)
    m = np.column_stack([a, b])
    n, g = 30, m.mean()
    rowsq = 2 * ((m.mean(axis=1) - g) ** 2).sum() / (n - 1)
    colsq = n * ((m.mean(axis=0) - g) ** 2).sum()
    err = (((m - g) ** 2).sum() - rowsq * (n - 1) - colsq) / (n - 1)
    want = (rowsq - err) / (rowsq + err + 2 * (colsq - err) / n)
    df = frame([("e", float(x), float(y)) for x, y in zip(a, b)], "endpoint string, a double, b double")
    assert A.icc_agreement(df, ["endpoint"], "a", "b").first()["icc"] == pytest.approx(want)


def test_trimmed_mean_with_ties(frame):
    d = np.array([1, 1, 1, 2, 3, 4, 5, 5, 9, 50], float)
    r = A.trimmed_moments(frame([("e", float(x)) for x in d], "endpoint string, d double"), ["endpoint"], "d").first()
    s = np.sort(d)
    w = np.clip(s, s[2], s[7])
    assert r["k"] == 2 and r["estimate"] == pytest.approx(s[2:8].mean())
    assert r["se"] == pytest.approx(w.std(ddof=1) / (0.6 * math.sqrt(10)))


def test_required_sessions_reach_the_power(spark):
    n = tails.smallest_n(lambda k: float(np.ravel(tails.tost_power(float(k), 0.5, 1.0))[0]), 0.8)
    assert tails.tost_power(float(n), 0.5, 1.0)[0] >= 0.8 > tails.tost_power(float(n - 1), 0.5, 1.0)[0]
    df = spark.createDataFrame([("a", 0.5, 1.0, False), ("b", 0.5, 1.0, True)], "endpoint string, gap double, sd double, one_sided boolean")
    got = {r["endpoint"]: (r["required_sessions"], r["binding"]) for r in A.required_sessions(df).collect()}
    assert got["a"] == (n, True) and got["b"][0] < n


def test_quota_and_merge(frame):
    sizes = frame([("a", 5), ("b", 3), ("c", 2)], "s string, size bigint")
    assert rows(Q.largest_remainder(sizes, ["s"], 4), "s", "quota") == [("a", 2), ("b", 1), ("c", 1)]
    bins = frame([("g", "low", 1), ("g", "mid", 60), ("g", "high", 39)], "g string, bin string, size bigint")
    assert rows(Q.merge_small_bins(bins, "g", "bin", ["low", "mid", "high"], "mid", 20), "bin", "merged_bin") == [("high", "high"), ("low", "mid"), ("mid", "mid")]


def test_more_than_there_is_cannot_be_drawn(frame):
    with pytest.raises(Exception, match="asked for 11"):
        Q.largest_remainder(frame([("a", 5), ("b", 5)], "s string, size bigint"), ["s"], 11).collect()


def test_draw_is_the_smallest_hashes(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 10 > 2).cast("int").alias("s"))
    drawn = Q.stratified_sample(df, ["s"], 100, ["id"], 9)
    got = {r["s"]: r["n"] for r in drawn.groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 30, 1: 70}
    u = df.withColumn("u", Q.seeded_uniform(9, "id")).toPandas()
    want = set(u[u.s == 1].nsmallest(70, "u").id)
    assert {r["id"] for r in drawn.filter("s = 1").collect()} == want


def test_gate_fails_on_nan_and_ignores_absent(frame):
    df = frame([(1.0,), (float("nan"),), (None,), (0.2,)], "lncc double")
    bounds = {"lncc": ("below", 0.65, False), "absent": ("above", 0.0, False)}
    assert [r[0] for r in df.select(P.gate_verdict(bounds, df.columns)).collect()] == ["pass", "fail", "fail", "fail"]


def test_skipped_step_is_a_dependency(frame):
    df = frame([("Skipped", "missing input", ""), ("Failed", "missing input", "65"), ("Failed", "", "65"), ("Error", " ", ""), ("Failed", "?", "x")], "s string, m string, c string")
    assert [r[0] for r in df.select(P.failure_category("s", "m", "c")).collect()] == ["dependency", "data", "qc_rejected", "infrastructure", "unknown"]


def test_datetime_spellings(frame):
    df = frame([("20181001", "101042.2475"), ("2018-10-01", "10:10:42"), ("2018-13-01", "10:10:42"), ("x", None)], "d string, t string")
    got = [r[0] for r in df.select(P.tolerant_datetime("d", "t").cast("string")).collect()]
    assert got == ["2018-10-01 10:10:42.2475", "2018-10-01 10:10:42", None, None]


def test_statistics_and_curvature_text(frame):
    stats = (
        "# fs_version 7.4.1\n# Measure BrainSeg, BrainSegVol, Brain, with comma, 1100.5, mm^3\n# Measure short, line\n# TableCol  1 ColHeader Index\n# TableCol  1 Units NA\n"
        "# TableCol  3 ColHeader Volume_mm3\n# TableCol  3 Units     mm^3\n# ColHeaders Index SegId StructName Volume_mm3\n 1 4 Left-Vent 12.5\n 2 5 Right-Vent -nan\nbad row\n"
    )
    curv = (
        "K <mean> +- <std> (using 'lh.smoothwm'):   0.04827 +- 5.8775 mm^-2\n         K Min:   -3.5 at vertex 12\n         K Mean Positive Surface Integral:    0.02669 across 65236 (46.80%) vertices\n"
        "         K Area:   86946.75 mm^2\n         K Type:   discrete\n"
    )
    df = frame([("aseg.stats", stats), ("lh.curv.stats", curv), ("vols.txt", "CA1 12.5\nskip this line\nCA3 nan\n")], "name string, text string")
    got = rows(X.parse_all(df, ["name"], "name"), "name", "structure", "measure", "value", "unit", "fs_version")
    assert ("aseg.stats", "BrainSeg", "BrainSegVol", 1100.5, "mm^3", "7.4.1") in got
    assert ("aseg.stats", "Left-Vent", "Volume_mm3", 12.5, "mm^3", "7.4.1") in got
    assert ("aseg.stats", "Right-Vent", "Volume_mm3", None, "mm^3", "7.4.1") in got
    assert not any(r[2] == "Index" for r in got)
    assert ("lh.curv.stats", "lh.smoothwm", "K|mean", 0.04827, "mm^-2", "") in got
    assert ("lh.curv.stats", "lh.smoothwm", "K|Min|vertex", 12.0, "", "") in got
    assert ("lh.curv.stats", "lh.smoothwm", "K|Mean Positive Surface Integral|across_pct", 46.8, "%", "") in got
    assert ("lh.curv.stats", "lh.smoothwm", "K|Area", 86946.75, "mm^2", "") in got
    assert ("lh.curv.stats", "lh.smoothwm", "K|Type", None, "", "") in got
    assert [r for r in got if r[0] == "vols.txt"] == [("vols.txt", "CA1", "Volume_mm3", 12.5, "mm^3", ""), ("vols.txt", "CA3", "Volume_mm3", None, "mm^3", "")]


def test_shards_are_stable_and_replaced_alone(spark, frame, tmp_path):
    import zlib

    path = str(tmp_path / "long")
    units = [f"sub-{i}" for i in range(20)]
    X.write_shards(frame([(u, 1.0) for u in units], "subject string, value double"), "subject", 4, path)
    got = {r["subject"]: int(r["shard"]) for r in spark.read.parquet(path).collect()}
    assert got == {u: zlib.crc32(u.encode()) % 4 for u in units}
    X.write_shards(frame([(units[0], 2.0)], "subject string, value double"), "subject", 4, path)
    again = {r["subject"] for r in spark.read.parquet(path).collect()}
    assert again == {u for u in units if got[u] != got[units[0]]} | {units[0]}


def test_header_without_structure_column_raises(frame):
    df = frame([("a.stats", "# ColHeaders Index Volume\n1 2\n")], "name string, text string")
    with pytest.raises(Exception, match="StructName"):
        X.parse_statistics(df, ["name"]).collect()


def test_numbered_run_columns(frame):
    cols = ["participant_id", "session_id", "mr_y_qc__raw__rsfmri__r01__series_uid", "mr_y_qc__raw__rsfmri__r01_indicator", "mr_y_qc__raw__rsfmri__r02__series_uid", "mr_y_qc__raw__rsfmri__r02__study_dt", "mr_y_qc__raw__rsfmri__r02__series_t"]
    df = frame([("p", "s", "n/a", "1", "u2", "2018-10-01", "10:10:42")], ", ".join(f"{c} string" for c in cols))
    out = W.runs_to_long(df, ("participant_id", "session_id"), "rsfmri")
    assert rows(out, "run_index", "uid", F.col("acquired").cast("string")) == [(2, "u2", "2018-10-01 10:10:42")]


def test_duplicate_keys_stop_the_pivot(frame):
    df = frame([("u", "a", "m", 1.0), ("u", "a", "m", 2.0)], "u string, structure string, measure string, value double")
    with pytest.raises(ST.DuplicateKey):
        ST.check_unique(df, ["u"])


def test_wide_tables_keep_file_order(spark, frame, tmp_path):
    df = frame(
        [("u1", "x.stats", "B", "m", 0, 1.0, "mm", "7"), ("u1", "x.stats", "A", "m", 1, 2.0, "mm", "7"), ("u2", "x.stats", "B", "m", 0, None, "mm", ""), ("u1", "x.stats", "C", "m", 2, None, "mm", "7")],
        "u string, source string, structure string, measure string, pos int, value double, unit string, fs_version string",
    )
    dictionary = ST.build_wide(df, ["u"], "source", str(tmp_path))
    assert [r["column"] for r in dictionary.orderBy("column_order").collect()] == ["B__m", "A__m"]
    wide = spark.read.parquet(str(tmp_path / "x.stats"))
    assert wide.columns == ["u", "fs_version", "B__m", "A__m"]
    assert rows(wide) == [("u1", "7", 1.0, 2.0), ("u2", None, None, None)]


def test_log_pairing_by_expected_start(frame):
    text = "\n".join(
        [
            "240101-00:00:00,0 nipype.workflow INFO:", '\t [Node] Setting-up "wf.a.init" in "/w/fmriprep_25_2_wf/sub_1_wf/anat_wf/init".',
            '\t [Node] Executing "init" <x>', "240101-00:00:05,0 nipype.workflow INFO:",
            '\t [Node] Setting-up "wf.b.init" in "/w/fmriprep_25_2_wf/sub_1_wf/bold_task_rest_wf/init".', '\t [Node] Executing "init" <x>',
            "240101-00:00:09,0 nipype.workflow INFO:", '\t [Node] Finished "init", elapsed time 4.0s.', "240101-00:00:20,0 nipype.workflow INFO:",
            '\t [Node] Finished "init", elapsed time 20.0s.', '\t [Node] Finished "init", elapsed time 1.0s.',
        ]
    )
    nodes = E.executed_nodes(E.log_events(frame([("l", text)], "log string, text string"), ["log"], "text"), ["log"], {"anat_wf": "anat", "bold_wf": "bold"})
    assert rows(nodes, "path", "elapsed_s") == [("anat_wf.init", 20.0), ("bold_wf.init", 4.0), (None, 1.0)]


def _log(frame, *lines):
    text = "\n".join(f"240101-00:00:{x:02d},0 nipype.workflow INFO:" if isinstance(x, int) else f"\t [Node] {x}" for x in lines)
    return E.log_events(frame([("l", text)], "log string, text string"), ["log"], "text")


def test_log_pairing_of_ties_cached_and_lost_lines(frame):
    def setup(wf):
        return f'Setting-up "wf.{wf}.n" in "/w/fmriprep_25_2_wf/sub_1_wf/{wf}/n".'

    events = _log(
        frame, 1, 'Executing "n" <x>', 'Finished "n", elapsed time 1.0s.', setup("a_wf"), setup("b_wf"), 'Cached "n" - up-to-date', 3,
        'Executing "n" <x>', 9, 'Finished "n", elapsed time 6.0s.', setup("c_wf"), setup("d_wf"), 10, 'Executing "n" <x>', 11,
        'Executing "n" <x>', 20, 'Finished "n", elapsed time 9.2s.', 'Finished "n", elapsed time 9.2s.',
    )
    got = rows(E.executed_nodes(events, ["log"], {"c_wf": "one", "d_wf": "two"}), "path", "elapsed_s", "ambiguous")
    assert sorted(got, key=str) == sorted([(None, 1.0, False), ("b_wf.n", 6.0, False), ("c_wf.n", 9.2, False), ("d_wf.n", 9.2, True)], key=str)
    same = rows(E.executed_nodes(events, ["log"], {"c_wf": "one", "d_wf": "one"}), "path", "ambiguous")
    assert not any(r[1] for r in same)
    tagged = rows(E.executed_nodes(events, ["log"], {"c_wf": "one", "d_wf": "one"}, {"d_wf": "t"}), "path", "ambiguous")
    assert ("d_wf.n", True) in tagged


def _pair_plainly(lines):
    """Set-ups in a queue, executions in a list: the rules as they are stated, at quadratic cost."""
    waiting, flight, out = [], [], []
    for _, event, path, kind, start in lines:
        if event == "setup":
            waiting.append((path, kind))
        elif event in ("execute", "cached") and waiting:
            taken = waiting.pop(0)
            if event == "execute":
                flight.append((*taken, start))
        elif event == "finish":
            if not flight:
                out.append((None, False))
                continue

            def gap(c, at=start):
                return abs(c[2] - at) if c[2] is not None and at is not None else math.inf

            best = min(range(len(flight)), key=lambda i: (gap(flight[i]), i))
            near = gap(flight[best])
            rival = any(c[1] != flight[best][1] and gap(c) <= near + 2_000_000 for c in flight if near < math.inf)
            out.append((flight.pop(best)[0], rival))
    return out


def _stream(lines, size):
    """The matcher over one unit in Arrow batches of `size` rows."""
    names = ["node", "line_number", "event", "path", "class", "start_us", "end_us", "elapsed_s"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64()]

    def batches():
        for at in range(0, len(lines), size):
            held = [("n", *row, row[-1], None) for row in lines[at : at + size]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    made = E._match_stream(["node"])(batches())
    return [(r["path"], r["ambiguous"]) for b in made for r in b.to_pylist()]


def test_log_pairing_equals_the_plain_rules():
    rnd = random.Random(8)
    for _ in range(200):
        lines = []
        for n in range(rnd.randrange(1, 60)):
            event = rnd.choice(["setup", "setup", "execute", "execute", "cached", "finish", "finish"])
            stamp = rnd.choice([None, rnd.randrange(12) * 1_000_000, rnd.randrange(12) * 1_000_000])
            path = f"p{n}" if event == "setup" else None
            lines.append((n, event, path, rnd.choice("ab") if path else None, stamp))
        assert _stream(lines, rnd.choice([1, 7, 100])) == _pair_plainly(lines)


def test_a_long_log_with_an_execution_that_never_ends():
    lines, n = [], 50_000
    for i in range(n):
        lines += [(3 * i, "setup", f"p{i}", "ab"[i % 2], None), (3 * i + 1, "execute", None, None, i * 10_000_000)]
        if i:  # the first one stays in flight
            lines.append((3 * i + 2, "finish", None, None, i * 10_000_000))
    assert _stream(lines, 1000) == [(f"p{i}", False) for i in range(1, n)]


def test_critical_path_waits_for_both(frame):
    df = frame([("s", "a", 2.0), ("s", "b", 5.0), ("s", "d", 1.0)], "k string, step string, seconds double")
    out = E.critical_path(df, ["k"], {"a": [], "b": [], "c": ["a"], "d": ["b", "c"]})
    assert out.first()["critical_s"] == 6.0
    with pytest.raises(ValueError, match="cycle"):
        E.critical_path(df, ["k"], {"a": ["b"], "b": ["a"]})


def test_redrive_order(frame):
    workflows = frame(
        [("w1", "s1", "Failed", "1", ""), ("w2", "s1", "Succeeded", "2", ""), ("w3", "s2", "Failed", "1", "Deadline exceeded"), ("w4", "s3", "Error", "1", ""), ("w5", "s4", "Failed", "1", ""), ("w6", "s5", "Failed", "1", "")],
        "workflow_name string, subject string, phase string, started_at string, workflow_message string",
    )
    attempts = frame(
        [("w3", "a", "1", ""), ("w3", "a", "1", ""), ("w5", "a", "143", "imminent node shutdown"), ("w5", "a", "143", "pod deleted"), ("w6", "q", "65", "")],
        "workflow_name string, step string, exit_code string, message string",
    )
    got = rows(O.redrive_plan(workflows, attempts), "subject", "action", "reason")
    assert got == [("s2", "skip", "deterministic repeat"), ("s3", "retry", "no failed pod"), ("s4", "retry", "transient"), ("s5", "skip", "gate rejected the input")]


def test_manifest_status(frame):
    outcomes = frame(
        [("w", "a", "succeeded", ["x", "y"]), ("w", "b", "skipped", []), ("v", "a", "succeeded", ["z"])], "workflow_name string, step string, status string, outputs_verified array<string>"
    )
    workflows = frame([("w", "Succeeded"), ("v", "Succeeded"), ("u", "Failed")], "workflow_name string, workflow_status string")
    out = O.build_manifests(outcomes, workflows, step_fields=["step", "status"])
    got = {r["workflow_name"]: (r["overall_status"], r["skipped_steps"], r["outputs_available"]) for r in out.collect()}
    assert got == {"w": ("partial", ["b"], ["x", "y"]), "v": ("succeeded", [], ["z"]), "u": ("failed", None, None)}
