"""Work per row that stays the same however many rows there are: members, keys, lines, spans and subjects."""

import json
import random
from datetime import datetime

import pyarrow as pa
import pytest

from tidemark.operators import allocations as AL
from tidemark.operators import audit_report as AR
from tidemark.operators import costs as C
from tidemark.operators import efficiency as E
from tidemark.operators import inventory as IV
from tidemark.operators import signal as S
from tidemark.plans import cost_queries as Q
from tidemark.plans.standins import allocation_sets
from tidemark.sources import stats_text as X


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_member_does_not_carry_the_names_of_all_members(frame):
    body = json.dumps({"data": [{f"pod-{i}": {"totalCost": i / 8} for i in range(500)}]})
    rows = AL.members(frame([(1, body)], "date int, body string"), "body").collect()
    assert {r["member"]: json.loads(r["value"].toJson())["totalCost"] for r in rows} == {f"pod-{i}": i / 8 for i in range(500)}
    assert max(len(r["value"].metadata) for r in rows) < 100


def test_a_set_that_names_a_member_twice_has_none(frame):
    body = '{"data": [{"p": {"totalCost": 1}, "p": {"totalCost": 2}}]}'
    assert AL.members(frame([(1, body), (2, "{'data': [{'p': {}}]}")], "date int, body string"), "body").count() == 0


def test_a_key_meets_each_pattern_once(frame):
    run = "sub-1_ses-1_task-rest_run-01"
    paths = [f"derivatives/func_surf/sub-1/ses-1/fsLR32k/{run}_space-fsLR32k_bold.dtseries.nii", "derivatives/func/sub-1/other.json", None]
    found = IV.located(frame([(p,) for p in paths], "path string"), "path", IV.RUN_PARTS, ["subject", "session", "run"])
    assert [tuple(r) for r in found.collect()] == [("sub-1", "ses-1", "task-rest_run-01", "surf_fs")]
    assert optimized(found).upper().count("RLIKE") == len(IV.RUN_PARTS)


def test_patterns_with_an_optional_beginning_are_not_told_by_it(frame):
    rows = frame([("a/x",), ("/x",), ("aa/y",), ("b/z",)], "path string")
    parts = {"maybe": "^a?/(x)$", "either": "^b/(z)$|^aa/(y)$"}
    got = {(r["n"], r["part"]) for r in IV.located(rows, "path", parts, ["n"]).collect()}
    assert got == {("x", "maybe"), ("", "either"), ("z", "either")}


def test_a_table_line_is_split_once(frame):
    text = "# ColHeaders Index StructName A B C\n1 hippo 1.5 2.5 nan\n# Measure Brain, BrainVol, Volume, 3, mm^3"
    rows = X.parse_statistics(frame([(1, text)], "id int, text string"), ["id"])
    assert {(r["structure"], r["measure"], r["value"]) for r in rows.collect()} == {("hippo", "A", 1.5), ("hippo", "B", 2.5), ("hippo", "C", None), ("Brain", "BrainVol", 3.0)}
    assert optimized(rows).count("split(trim(line") == 1


def test_spans_meet_voxels_without_a_shuffle(spark, frame):
    rows = frame([("g", float(i % 5 + 1), float(i % 3)) for i in range(60)], "g string, a double, b double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = S.mutual_information(rows, ["g"], "a", "b")
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert out.first()["mi"] == pytest.approx(0.0, abs=1e-12)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_subjects_are_counted_on_their_own_rows(frame, monkeypatch):
    numbers = ["total_cost_usd", "cpu_cost_usd", "memory_cost_usd", "gpu_cost_usd", "pv_cost_usd", "runtime_minutes", "cpu_efficiency", "ram_efficiency"]
    rows = [(s, p, u, *[1.0] * len(numbers)) for s, p, u in (("a", "F", 1), ("a", "F", 1), ("a", "F", 2), ("a", None, None), (None, None, 3))]
    plans = []
    kept = C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: plans.append(optimized(df)) or kept(df))
    out = C.step_costs(frame(rows, "step string, phase string, subject int, " + ", ".join(f"{n} double" for n in numbers)))
    assert {(r["step"], r["phase"]): (r["n_pods"], r["n_subjects"], r["pct_of_total"], r["median_cost_usd"]) for r in out.collect()} == {
        ("a", "F"): (3, 2, 60.0, 1.0), ("a", None): (1, 0, 20.0, 1.0), (None, None): (1, 1, 20.0, 1.0),
    }
    assert len(plans) == 1 and "distinct" not in plans[0].lower()


def test_the_text_of_a_line_is_not_carried(frame):
    text = '260101-10:00:00,5 nipype.workflow INFO:\n\t [Node] Setting-up "wf.n" in "/w/fmriprep_25_2_wf/sub_1_wf/a_wf/n".\nnoise'
    events = E.log_events(frame([("x", text)], "log string, text string"), ["log"], "text")
    assert [(r["line_number"], r["event"], r["node"], r["path"]) for r in events.collect()] == [(1, "setup", "n", "a_wf.n")]
    plan = optimized(events)
    assert "_z" in plan and "_z" not in plan[: plan.index("Window")]
    assert all("_z" not in line for line in plan.splitlines() if "Window" in line or "Join" in line or "Aggregate" in line)


def _crowd(n, seed):
    """Lines of one log: set-ups that wait across others, executions hundreds of lines long, one that never ends, finishes of nothing."""
    rnd, lines = random.Random(seed), []
    for i in range(n):
        start = 1_000_000 * i
        lines += [(start, 0, "setup", f"{'ab'[i % 2]}_wf.n{i}", None), (start + rnd.choice([0, 0, 0, 2_500_000]), 1, "execute", None, None)]
        if i:
            took = rnd.randrange(1, 40)
            lines.append((start + took * 1_000_000, 2, "finish", None, took + rnd.choice([0.0, 0.0, 0.0, 0.4])))
        if i % 9 == 4:
            lines.append((start + 5_500_000, 3, rnd.choice(["finish", "cached", "execute"]), None, 2.0))
    stamped = [(at if rnd.random() > 0.02 else None, event, path, took) for at, _, event, path, took in sorted(lines, key=lambda x: x[:2])]
    return [("l", number, at, event, "n", path, took) for number, (at, event, path, took) in enumerate(stamped)]


@pytest.mark.parametrize(("seed", "put_off"), [(1, 1000), (2, 1000), (3, 0)])
def test_a_long_log_is_matched_in_pieces(frame, monkeypatch, seed, put_off):
    schema = "log string, line_number long, stamp_us long, event string, node string, path string, elapsed_s double"
    lines = _crowd(150, seed)
    events = frame([*lines, *((None, *x[1:]) for x in lines[:40]), ("short", *lines[0][1:]), ("short", *lines[3][1:])], schema)

    def matched():
        return sorted(map(str, E.executed_nodes(events, ["log"], {"a_wf": "one", "b_wf": "two"}).collect()))

    whole = matched()
    monkeypatch.setattr(E, "PIECE_LINES", 60)
    monkeypatch.setattr(E, "PUT_OFF", put_off)
    tasks = []
    pieces = E._in_pieces
    monkeypatch.setattr(E, "_in_pieces", lambda *a: tasks.append(a) or pieces(*a))
    assert matched() == whole and len(tasks) == 1
    assert any("ambiguous=True" in r for r in whole) and any("path=None" in r for r in whole)


def test_what_an_audit_ranks_is_computed_once(frame, monkeypatch):
    texts, numbers = ["workflow_name", "pod", "step", "subject", "session", "problem", "node_instance_id"], ["runtime_minutes", "total_cost_usd", "ondemand_usd", "cpu_cost_usd", "memory_cost_usd", "gpu_cost_usd", "pv_cost_usd", "network_cost_usd", "node_effective_usd_per_hour", "node_ondemand_usd_per_hour", "gpu_hours"]
    rows = [(w, p, "a", "s", "1", None, "i", 3, *[1.0] * len(numbers)) for w, p in (("v", "p"), ("w", "p"), (None, "q"))]
    plans = []
    kept = AR.with_quantiles
    monkeypatch.setattr(AR, "with_quantiles", lambda grouped, df, *rest: plans.append(optimized(df)) or kept(grouped, df, *rest))
    out = AR.audit_report(frame(rows, f"{', '.join(f'{t} string' for t in texts)}, scrape_age_days int, {', '.join(f'{n} double' for n in numbers)}"))
    got = {(r["section"], r["measure"]): r["value"] for r in out.filter("item IN ('', 'a')").collect()}
    assert got["scope", "n_workflows"] == 2 and got["coverage", "pods"] == 3 and got["per_step", "runtime_min_p95"] == 1.0
    assert len(plans) == 1 and "Union" not in plans[0] and "Join" not in plans[0]


def test_a_set_goes_from_the_parser_to_its_rows_without_being_a_row(frame):
    body = json.dumps({"data": [{f"pod-{i}": {"totalCost": i / 8} for i in range(50)}, {"second": {}}]})
    members = AL.members(frame([(1, body), (2, '{"data": [null]}'), (3, None), (4, '{"data": [{}]}')], "date int, body string"), "body")
    plan = optimized(members)
    assert "explode(array(from_json" not in plan and "explode(array(get(from_json" not in plan and plan.count("Generate") == 2
    assert sorted((r["date"], r["member"]) for r in members.collect()) == sorted((1, f"pod-{i}") for i in range(50))


def test_responses_are_made_one_date_at_a_time(frame):
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    days = [datetime(1995, 1, 2), datetime(1995, 1, 3), None]
    rows = [(i, 7, 8, 1 + i % 7, 2.0, 100.0 + i, 0.1, 0.0, "R", "F", days[i % 3]) for i in range(300)]

    class Given:
        lineitem = frame(rows, line).repartition(5)

    made = Q._pod_responses(Given)
    assert "collect_list" not in optimized(made)
    got = {r["date"]: json.loads(r["body"])["data"] for r in made.collect()}
    assert set(got) == {"1995-01-02", "1995-01-03", None} and all(len(x) == 1 and len(x[0]) == 101 and x[0]["__idle__"] is None for x in got.values())
    prices = {m.removeprefix("__unallocated__").split("-")[0]: v["totalCost"] for x in got.values() for m, v in x[0].items() if v}
    assert prices == {str(i): 100.0 + i for i in range(300)}
    assert sum(m.startswith("__unallocated__") for x in got.values() for m in x[0]) == sum(1 + i % 7 == 5 for i in range(300))


def test_sets_are_joined_across_batches_and_hold_a_member_once():
    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["date", "member", "text"])

    one, two = batch(("a", "p", '{"p":1}'), ("a", "q", '{"q":{"x":2}}')), batch(("a", "r", '{"r":3}'), ("b", "p", '{"p":"é"}'), (None, "p", '{"p":5}'))
    got = [(b.column(0)[0].as_py(), json.loads(b.column(1)[0].as_py())["data"]) for b in allocation_sets(iter([one, two]))]
    assert got == [("a", [{"p": 1, "q": {"x": 2}, "r": 3, "__idle__": None}]), ("b", [{"p": "é", "__idle__": None}]), (None, [{"p": 5, "__idle__": None}])]
    with pytest.raises(ValueError, match="twice on a"):
        list(allocation_sets(iter([one, one])))
