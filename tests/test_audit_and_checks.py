"""Audit report, batch checks, wide tables, confounds and file listing against values worked out by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit_report as AR
from tidemark.operators import outcomes as O
from tidemark.operators import series as SE
from tidemark.operators import signal as S
from tidemark.operators import statistics as ST
from tidemark.sources import stats_text as X
from tidemark.sources import wide_runs as W

ROW = (
    "workflow_name string, pod string, step string, subject string, session string, runtime_minutes double, total_cost_usd double, ondemand_usd double, problem string, "
    "scrape_age_days int, cpu_cost_usd double, memory_cost_usd double, gpu_cost_usd double, pv_cost_usd double, network_cost_usd double, "
    "node_effective_usd_per_hour double, node_ondemand_usd_per_hour double, node_instance_id string, gpu_hours double"
)


def cost_row(pod, step, subject, session, usd, listed, problem=None, age=3, rate=1.0, minutes=10.0):
    return ("w", pod, step, subject, session, minutes, usd, listed, problem, age, usd, 0.0, 0.0, 0.0, 0.0, rate, 2.0, "i", 0.0)


def report(df):
    return {(r["section"], r["item"], r["measure"]): r["value"] for r in df.collect()}


COSTS = [
    cost_row("p1", "globus-transfer", "s1", "", 5.0, 5.0),
    cost_row("p2", "a", "s1", "1", 1.0, 2.0),
    cost_row("p2", "a", "s1", "1", 1.0, 2.0, minutes=30.0),
    cost_row("p3", "a", "s1", "", 4.0, 8.0),
    cost_row("p4", None, "s1", "2", 3.0, None, "pod-larger-than-node", rate=None),
    cost_row("p5", "a", "s2", "1", 7.0, 9.0),
]


def test_audit_shares_and_coverage(frame):
    sessions = frame([("s1", "1", 2), ("s1", "2", 1), ("s1", "3", 0)], "subject string, session string, n_runs int")
    got = report(AR.audit_report(frame(COSTS, ROW), sessions, frame([(3600,), (7200,), (None,)], "total_duration_s int")))
    assert got["coverage", "", "pods"] == 5 and got["coverage", "", "priced_at_list"] == 4
    assert got["coverage", "pod-larger-than-node", "unpriced"] == 1 and got["coverage", "", "carried_instance_no_effective_rate"] == 1
    # s1 shares 4 among three sessions; s2 is not named, so its pods name its session
    assert got["per_session", "", "n_sessions"] == 4
    shares = sorted([2 + 4 / 3, 3 + 4 / 3, 4 / 3, 7.0])
    assert got["per_session", "operated_1k", "median"] == pytest.approx(np.median(shares))
    assert got["per_session", "operated_1k", "p95"] == pytest.approx(np.percentile(shares, 95))
    assert got["per_session", "operated_1k_per_run", "n"] == 2  # no runs: no cost per run
    assert got["per_session", "on_demand_1k", "n"] == 3  # session 2 has an unpriced pod
    assert got["per_step", "a", "on_demand_usd"] == 21.0 and got["per_step", AR.UNLABELLED, "on_demand_usd"] is None
    assert got["per_step", "a", "runtime_min_p50"] == 10.0 and got["ingress", "", "operated_usd"] == 5.0
    assert got["spot_savings", "", "multiple"] == pytest.approx(2.0) and got["spot_savings", "", "coverage_frac"] == pytest.approx(18 / 21)
    assert got["workflow_wall_clock_h", "", "p50"] == pytest.approx(1.5) and got["workflow_wall_clock_h", "", "n"] == 2


def test_one_unsettled_row_refuses_all_dollars(frame):
    got = report(AR.audit_report(frame([*COSTS, cost_row("p6", "a", "s2", "1", 1.0, 1.0, age=2)], ROW)))
    assert got["scope", "", "settled"] == 0 and got["per_step", "a", "n_pods"] == 4
    assert not [k for k, v in got.items() if v is not None and ("usd" in k[2] or k[0] == "spot_savings" or k[2] in ("median", "p5", "p95"))]


def test_audit_of_no_rows(frame):
    got = report(AR.audit_report(frame([], ROW)))
    assert got["scope", "", "n_pod_rows"] == 0 and got["scope", "", "settled"] == 0 and got["per_session", "", "n_sessions"] == 0


def test_anatomy_of_subjects_without_functional_steps(frame):
    subjects = frame([(s,) for s in "abcdef"], "subject string")
    outcomes = frame(
        [("a", "1", "func"), ("b", "1", "anat"), ("b", "2", "anat"), ("c", "1", "anat"), ("d", "na", "anat"), ("e", "1", "anat")],
        "subject string, session string, step string",
    )
    markers = frame([("b", "1"), ("c", "1"), ("c", "long-template"), ("e", "1"), ("f", "9")], "subject string, session string")
    out = O.anatomy_only_delivery(subjects, outcomes, markers, F.col("step") == "func")
    assert {r["subject"]: (r["n_sessions"], r["n_gaps"], r["verdict"]) for r in out.collect()} == {
        "b": (2, 1, "gaps"), "c": (1, 0, "delivered"), "d": (0, 0, "lost"), "e": (1, 0, "no_template"), "f": (0, 0, "lost"),
    }
    check = O.anatomy_only_check(out).first()
    assert (check["expected"], check["found"], check["warning"], check["passed"]) == (5, 2, True, False)


def test_newest_record_decides_the_version(frame):
    df = frame([("a", 1, "1.0"), ("a", 2, "1.1"), ("b", 1, "1.1"), ("b", 2, None)], "subject string, t int, v string")
    out = O.newest_version_check("v", df, ["subject"], "t", "v", "1.1").first()
    assert (out["expected"], out["found"], out["other_versions"], out["passed"]) == (2, 1, "", False)
    assert O.newest_version_check("v", df.limit(0), ["subject"], "t", "v", "1.1").first()["passed"]


def test_expected_names(frame):
    out = O.expected_names_check("s", frame([("x",), (None,)], "step string"), "step", ["x", "y"]).first()
    assert (out["found"], out["missing"], out["passed"]) == (1, "y", False)


def test_flow_counts_each_unit_once_per_box(frame):
    df = frame([("u", 1, True, True), ("u", 2, True, False), ("u", 2, False, True), ("v", 1, None, True)], "s string, ses int, a boolean, b boolean")
    out = O.staged_flow(df, [("a", F.col("a")), ("b", F.col("b"))], {"subjects": ["s"], "sessions": ["s", "ses"]})
    assert {(r["box"], r["kind"]): (r["subjects"], r["sessions"], r["n_rows"]) for r in out.collect()} == {
        ("enrolled", "stage"): (2, 3, 4), ("a", "excluded"): (2, 2, 2), ("a", "stage"): (1, 2, 2), ("b", "excluded"): (1, 1, 1), ("b", "stage"): (1, 1, 1),
    }


def test_wide_table_refuses_two_rows_for_one_cell(frame):
    schema = "u string, structure string, measure string, pos int, value double, unit string, fs_version string"
    long = frame([("u1", "A", "m", 0, 1.0, "mm", "7"), ("u2", "B", "x", 0, None, "mm", "")], schema)
    plan = ST.column_plan(long)
    assert sorted(map(tuple, ST.pivot_wide(long, ["u"], plan).collect())) == [("u1", "7", 1.0), ("u2", None, None)]
    twice = long.unionByName(frame([("u1", "A", "m", 1, 2.0, "mm", "7")], schema))
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        ST.pivot_wide(twice, ["u"], plan).collect()


def test_series_of_copied_rows_and_null_times(frame):
    schema = "session string, series_id string, table string, kind string, norm boolean, uid string, acquired_us bigint"
    series = frame([("s", "a", "T1w", "T1w", True, "u1", None), ("s", "a", "T1w", "T1w", True, "u1", None), ("s", "b", "T1w", "T1w", False, "zz", None), (None, "c", "T1w", "T1w", True, "u1", 1)], schema)
    runs = frame([("s", "T1w", 1, "u1", 5), ("s", "T1w", 2, None, 5)], "session string, table string, run_index int, uid string, acquired_us bigint")
    out = SE.match_series(series, runs, runs)
    assert sorted((r["series_id"], r["status"]) for r in out.collect()) == [("a", "ambiguous"), ("a", "ambiguous"), ("b", "unmatched"), ("c", "no_qc_row")]
    assert out.columns == [*series.columns, "run_index", "status", "seconds_off"]


def test_tissue_status(frame):
    voxels = frame([(r, v, [1.0 * v, 2.0]) for r in ("x", "y", "z") for v in range(3)], "run string, voxel int, series array<double>")
    masks = frame([("x", 0, "wm"), ("x", 2, "wm"), ("x", 1, "csf"), ("y", 1, "wm"), ("y", 99, "csf")], "run string, voxel int, tissue string")
    out = S.tissue_columns(voxels, masks, ["run"], "voxel", "tissue", ["wm", "csf"])
    got = {(r["run"], r["tissue"], r["frame"]): (r["mean_signal"], r["n_voxels"], r["status"]) for r in out.collect()}
    assert len(got) == 12 and got["x", "wm", 0] == (1.0, 2, "ok") and got["y", "csf", 1] == (None, 0, "empty-mask")
    assert got["y", "wm", 0] == (1.0, 1, "empty-mask") and got["z", "wm", 0] == (None, 0, "unavailable")


def test_motion_terms_and_indicators(frame):
    rng = np.random.default_rng(2)
    data, moved = rng.normal(size=(4, 20)), rng.normal(size=(20, 2))
    voxels = frame([("r", i, [float(x) for x in row]) for i, row in enumerate(data)], "run string, voxel int, series array<double>")
    motion = frame([("r", i, float(a), float(b)) for i, (a, b) in enumerate(moved)], "run string, frame int, rot_x double, trans_x double")
    got = S.full_confounds(voxels, motion, ["run"], 2, 3, 2.0, 20, ["rot_x"], ["trans_x"]).orderBy("t_indx").collect()
    step = np.vstack([[np.nan, np.nan], np.diff(moved, axis=0)])
    assert [r["non_steady_state_outlier_00"] for r in got[:3]] == [1, 0, 0] and {r["non_steady_state_outlier_02"] for r in got} == {None}
    assert got[0]["rot_x_derivative1"] is None and got[0]["framewise_displacement"] is None
    for i in range(1, 20):
        assert got[i]["trans_x_derivative1_power2"] == pytest.approx(step[i, 1] ** 2) and got[i]["rot_x_power2"] == pytest.approx(moved[i, 0] ** 2)
        assert got[i]["framewise_displacement"] == pytest.approx(abs(step[i, 0]) * math.pi / 180 * 50 + abs(step[i, 1]))


def test_files_are_listed_and_read(spark, tmp_path):
    for unit in ("u1", "u2"):
        (tmp_path / unit / "stats").mkdir(parents=True)
        (tmp_path / unit / "stats" / "a.txt").write_text("Left 1.5\nRight nan\nnot a line here\n")
    files = X.list_files(spark, str(tmp_path))
    assert sorted(r["path"].split("/")[-3] for r in files.collect()) == ["u1", "u2"] and files.agg(F.min("size")).first()[0] > 20
    texts = X.read_texts(spark, str(tmp_path)).withColumn("name", F.lit("a.txt"))
    assert sorted((r["structure"], r["value"]) for r in X.parse_all(texts, ["path"], "name").collect()) == [("Left", 1.5), ("Left", 1.5), ("Right", None), ("Right", None)]


def test_export_keeps_the_batch(spark, frame, tmp_path):
    tables = {"t": frame([("2024-01-01", "a", 1), ("2024-01-05", "a", 2), ("2024-01-02", "b", 3)], "dt string, subject string, n int"), "u": frame([("b", 1)], "subject string, n int")}
    paths = W.export_csv(W.scoped_tables(tables, frame([("a",), ("a",)], "subject string"), {"t": "dt"}, last="2024-01-02"), str(tmp_path))
    assert [tuple(r) for r in spark.read.csv(paths["t"], header=True).collect()] == [("2024-01-01", "a", "1")]
    assert spark.read.csv(paths["u"], header=True, schema="subject string, n string").count() == 0
