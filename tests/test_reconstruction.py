"""Calibration defaults, pooled rates, cut days and the subject of reconstructed rows on hand-made pods."""

import pytest

from tidemark.operators import reconstruction as RC
from tidemark.operators.ordered import DAY_US

H = 3_600_000_000
PODS = "workflow_name string, pod string, start_us bigint, end_us bigint, subject string, kind string, rd_cpu double, rd_mem double, rd_gpu double"
BILLED = (
    "workflow_name string, day_us bigint, kind string, cpu_core_hours double, ram_gb_hours double, gpu_hours double, cpu_cost_usd double, "
    "memory_cost_usd double, gpu_cost_usd double"
)


def test_pods_are_cut_at_the_borders_of_their_days(frame):
    rows = [
        ("w", "night", DAY_US - 6 * H, DAY_US + 18 * H, None, None, 1.0, 0.0, 0.0),
        ("w", "open", DAY_US + H, None, None, None, 1.0, 0.0, 0.0),
        ("w", "instant", DAY_US + H, DAY_US + H, None, None, 1.0, 0.0, 0.0),
        ("w", "never", None, DAY_US, None, None, 1.0, 0.0, 0.0),
        ("w", "to midnight", 0, DAY_US, None, None, 1.0, 0.0, 0.0),
    ]
    days = RC.pod_days(frame(rows, PODS), "start_us", "end_us")
    got = {(r["pod"], r["day_us"] // DAY_US): (r["fraction"], r["minutes"]) for r in days.collect()}
    assert got == {
        ("night", 0): (0.25, 360.0), ("night", 1): (0.75, 1080.0), ("open", 1): (1.0, 23 * 60.0), ("instant", 1): (1.0, 0.0), ("to midnight", 0): (1.0, 1440.0),
    }
    now = RC.pod_days(frame(rows, PODS), "start_us", "end_us", now_us=3 * DAY_US).filter("pod = 'open'")
    assert [r["fraction"] for r in now.orderBy("day_us").collect()] == pytest.approx([23 / 47, 24 / 47])


def test_small_workflows_leave_the_default_ratio(frame):
    pods = [("a", "p", 0, H, None, "t", 3600.0 * 4, 10.0, 0.0), ("b", "q", 0, H, None, "t", 3600.0 * 8, 10.0, 0.0), ("c", "r", 0, H, None, "t", 3600.0, 10.0, 0.0)]
    billed = [("a", 0, "t", 2.0, 5.0, 0.0, 1.0, 1.0, 0.0), ("b", 0, "t", 8.0, 5.0, 0.0, 1.0, 1.0, 0.0), ("c", 0, "t", 90.0, 5.0, 0.0, 1.0, 1.0, 0.0)]
    days = RC.pod_days(frame(pods, PODS), "start_us", "end_us")
    row = RC.unit_ratios(days, frame(billed, BILLED), ["day_us", "workflow_name"]).first()
    assert (row["cpu"], row["mem"], row["gpu"]) == (0.75, 0.0958, 1.0)  # c asked for too little to count


def test_rates_are_ratios_of_sums_and_unknown_types_take_the_pooled_ones(frame):
    billed = frame([("a", 0, "t", 1.0, 0.0, 0.0, 1.0, 0.0, 0.0), ("b", 0, "t", 3.0, 0.0, 0.0, 1.0, 0.0, 0.0), ("c", 0, None, 4.0, 0.0, 0.0, 4.0, 0.0, 0.0)], BILLED)
    sums = RC.type_sums(billed, "kind")
    assert {r["kind"]: (r["cpu"], r["mem"]) for r in RC.type_rates(sums, "kind").collect()} == {"t": (0.5, 0.0), "": (1.0, 0.0)}
    pods = [("w", k, 0, H, s, t, 3600.0, 0.0, 0.0) for k, s, t in (("p", "seen", "t"), ("q", "", "new"), ("r", None, None))]
    days = RC.pod_days(frame(pods, PODS), "start_us", "end_us")
    runs = frame([("w", "run", "", -H, 0)], "workflow_name string, run string, subject string, start_us bigint, end_us bigint")
    ratios = frame([(1.0, 1.0, 1.0)], "cpu double, mem double, gpu double")
    out = {r["subject"]: r for r in RC.reconstruct_costs(days, runs, ratios, sums, "kind").collect()}
    assert out["seen"]["total_cost_usd"] == 0.5
    assert out[""]["pods"] == 2 and out[""]["total_cost_usd"] == pytest.approx(6 / 8 + 1.0) and out[""]["pods_without_instance_type"] == 1


def test_a_reused_name_is_told_apart_by_the_pods_start(frame):
    pods = [("w", p, s, s + H, "pod", "t", 3600.0, 0.0, 0.0) for p, s in (("early", H), ("both", 5 * H), ("late", 9 * H), ("after", 40 * H))]
    runs = [("w", "one", "A", 0, 5 * H), ("w", "two", "B", 5 * H, 10 * H)]
    days = RC.pod_days(frame(pods, PODS), "start_us", "end_us")
    sums = RC.type_sums(frame([("a", 0, "t", 1.0, 0.0, 0.0, 1.0, 0.0, 0.0)], BILLED), "kind")
    runs = frame(runs, "workflow_name string, run string, subject string, start_us bigint, end_us bigint")
    out = RC.reconstruct_costs(days, runs, frame([(1.0, 1.0, 1.0)], "cpu double, mem double, gpu double"), sums, "kind")
    assert {(r["day_us"] // DAY_US, r["subject"]): r["pods"] for r in out.collect()} == {(0, "A"): 1, (0, "pod"): 1, (0, "B"): 1, (1, "B"): 1}


def test_many_open_windows_of_one_name_do_not_overflow(frame):
    pods = [("w", p, s, s + H, "pod", "t", 3600.0, 0.0, 0.0) for p, s in (("lone", H), ("many", 5000 * H))]
    runs = [("w", f"r{i}", f"s{i}", i * H, None) for i in range(1, 4000)]
    pods = frame(pods, PODS).select("workflow_name", "pod", "start_us")
    runs = frame(runs, "workflow_name string, run string, subject string, start_us bigint, end_us bigint")
    got = RC.assign_by_window(pods, runs, ["workflow_name"], ["pod"], "start_us", "run", "start_us", "end_us")
    assert {r["pod"]: (r["n_hits"], r["run"]) for r in got.collect()} == {"lone": (1, "r1"), "many": (3999, None)}


def test_rows_of_pods_are_shuffled_by_their_chunk_and_their_day_only(frame):
    days = RC.pod_days(frame([("w", "p", H, 2 * H, "pod", "t", 3600.0, 0.0, 0.0)], PODS), "start_us", "end_us")
    sums = RC.type_sums(frame([("a", 0, "t", 1.0, 0.0, 0.0, 1.0, 0.0, 0.0)], BILLED), "kind")
    runs = frame([("w", "one", "A", 0, 5 * H)], "workflow_name string, run string, subject string, start_us bigint, end_us bigint")
    out = RC.reconstruct_costs(days, runs, frame([(1.0, 1.0, 1.0)], "cpu double, mem double, gpu double"), sums, "kind")
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("pod#" in line for line in dealt)
    assert sum("REPARTITION_BY_COL" in line for line in dealt) == 1 and len(dealt) <= 8


def test_rows_of_a_pod_go_by_its_latest_start(frame):
    pods = [("w", "p", H, 2 * H, "pod", "t", 3600.0, 0.0, 0.0), ("w", "p", 7 * H, 8 * H, "pod", "t", 7200.0, 0.0, 0.0), ("w", "q", H, 2 * H, "pod", "t", 3600.0, 0.0, 0.0), (None, "p", H, 2 * H, "nobody", "t", 3600.0, 0.0, 0.0)]
    days = RC.pod_days(frame(pods, PODS), "start_us", "end_us")
    runs = [("w", "one", "A", 0, 3 * H), ("w", "two", "B", 6 * H, 9 * H), ("w", "two", "C", 20 * H, 21 * H), (None, "one", "D", 0, 3 * H), ("w", None, "E", 0, 3 * H)]
    runs = frame(runs, "workflow_name string, run string, subject string, start_us bigint, end_us bigint")
    sums = RC.type_sums(frame([("a", 0, "t", 1.0, 0.0, 0.0, 1.0, 0.0, 0.0)], BILLED), "kind")
    scraped = frame([(0, "w", 5.0)], "day_us bigint, workflow_name string, usd double")
    out = RC.reconstruct_costs(days, runs, frame([(1.0, 1.0, 1.0)], "cpu double, mem double, gpu double"), sums, "kind", scraped)
    got = {(r["workflow_name"], r["subject"]): (r["pods"], r["total_cost_usd"], r["scraped_total_cost_usd"]) for r in out.collect()}
    assert got == {("w", "C"): (2, 3.0, 5.0), ("w", "A"): (1, 1.0, 5.0), (None, "nobody"): (1, 1.0, None)}


def test_windows_that_end_before_they_begin_hold_no_pod_and_hide_none(frame):
    runs = frame([("w", "odd", 50 * H, 10 * H), ("w", "good", 20 * H, 40 * H), ("v", "lone", None, None)], "w string, run string, s bigint, e bigint")
    pods = frame([("w", "p", 30 * H), ("w", "q", 45 * H), ("w", "r", 60 * H), ("w", "never", None), ("v", "s", None), ("v", "t", H), ("u", "z", H)], "w string, pod string, at bigint")
    got = RC.assign_by_window(pods, runs, ["w"], ["pod"], "at", "run", "s", "e", chunk_us=H)
    assert {r["pod"]: (r["n_candidates"], r["n_hits"], r["run"]) for r in got.collect()} == {
        "p": (2, 1, "good"), "q": (2, 0, "good"), "r": (2, 0, "odd"), "never": (2, 0, None), "s": (1, 0, "lone"), "t": (1, 0, None), "z": (0, 0, None),
    }
