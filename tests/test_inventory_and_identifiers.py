"""Completion rules, refused lookups, and identifying names in nested documents, schemas and headers."""

import json

import pytest
from pyspark.sql import types as T

from tidemark.operators import allocations as AL
from tidemark.operators import inventory as IV
from tidemark.sources import identifiers as ID

RUN = "subject string, session string, run string"


def run_keys(sub="sub-1", ses="ses-1", run="task-rest_run-01"):
    p = f"{sub}_{ses}_{run}"
    return {
        "b2t": f"derivatives/registration/{sub}/{ses}/bold_to_t1w_{run}/{p}_desc-bold2t1w_itk.txt",
        "func_legacy": f"derivatives/func/{sub}/{ses}/{p}_space-MNI152NLin2009cAsym_bold.tar.gz",
        "components": f"derivatives/func_surf/{sub}/{ses}/components/{p}_desc-grayordcomponents_bold.tar.gz",
        "surf_fs": f"derivatives/func_surf/{sub}/{ses}/fsLR32k/{p}_space-fsLR32k_bold.dtseries.nii",
        "surf_newmsm": f"derivatives/func_surf/{sub}/{ses}/fsLR32k/{p}_space-fsLR32k_desc-newmsm_bold.dtseries.nii",
    }


@pytest.mark.parametrize(
    ("parts", "marker", "route", "expected"),
    [
        ([], None, "fs", "-----"), (["b2t"], None, "fs", "b----"), (["func_legacy"], None, "fs", "-f---"), ([], "func-session", "fs", "-f---"), ([], "anat", "fs", "-----"),
        (["components"], None, "fs", "--c-s"), (["surf_fs"], None, "fs", "---ts"), (["surf_newmsm"], None, "fs", "---ts"), (["surf_fs"], None, "newmsm", "-----"),
        (["surf_newmsm"], None, "newmsm", "---ts"), (["components", "surf_fs"], None, "newmsm", "--c-s"),
    ],
)
def test_run_rules(frame, parts, marker, route, expected):
    keys = run_keys()
    listing = frame([(keys[p],) for p in parts] + [("derivatives/func/sub-1/ses-2/other",), (keys["b2t"].replace("sub-1_", "sub-9_"),)], "path string")
    markers = frame([("sub-1", "ses-1", marker, ["task-rest_run-01"])] if marker else [], "subject string, session string, kind string, runs array<string>")
    runs = frame([("sub-1", "ses-1", "task-rest_run-01"), ("sub-1", "ses-1", "task-rest_run-02")], RUN)
    got = {r["run"]: r for r in IV.run_inventory(runs, listing, markers, route).collect()}
    flags = ("b2t_exists", "func_exists", "components_exist", "surf_target_exists", "surf_exists")
    assert [got["task-rest_run-01"][f] for f in flags] == [x != "-" for x in expected]
    assert not any(got["task-rest_run-02"][f] for f in flags)


def test_unknown_route_and_missing_lookup_are_refused(frame):
    runs, none = frame([("a", "b", "c")], RUN), frame([], "subject string, session string, kind string, runs array<string>")
    with pytest.raises(ValueError, match="route"):
        IV.run_inventory(runs, frame([], "path string"), none, "other")
    sessions = frame([("sub-1", "ses-1", True), ("sub-1", "ses-2", False), ("sub-2", "ses-1", True)], "subject string, session string, has_t1w boolean")
    names = "subject string, session string"
    lookup = frame([("sub-1", "ses-1", "3"), ("sub-1", "ses-2", "")], f"{names}, nss_frames string")
    with pytest.raises(IV.InventoryError, match="sub-2/ses-1"):
        IV.session_inventory(sessions, frame([], "path string"), lookup, frame([], names))
    full = lookup.unionByName(frame([("sub-2", "ses-1", "4")], lookup.schema))
    out = IV.session_inventory(sessions, frame([], "path string"), full, frame([("sub-1", "ses-1")], names), frame([("sub-2", "ses-1"), ("sub-9", "x")], names))
    got = {(r["subject"], r["session"]): (r["t1w_available"], r["published"], r["rejected"], r["nss_frames"]) for r in out.collect()}
    assert got == {("sub-1", "ses-1"): (True, True, False, "3"), ("sub-1", "ses-2"): (False, False, False, ""), ("sub-2", "ses-1"): (False, False, False, "4")}
    assert [tuple(r) for r in IV.unknown_sessions(frame([("sub-9", "x")], names), sessions).collect()] == [("sub-9", "x")]


def plain(obj, path="$"):
    table = {"".join(c for c in f.lower() if c.isalnum()): f for f in ID.IDENTIFYING_FIELDS}
    if isinstance(obj, dict):
        for k, v in obj.items():
            field = table.get("".join(c for c in k.lower() if c.isascii() and c.isalnum()))
            if field:
                yield f"{path}.{k}", field
            yield from plain(v, f"{path}.{k}")
    elif isinstance(obj, list):
        for i, v in enumerate(obj):
            yield from plain(v, f"{path}[{i}]")


def test_identifying_keys_at_any_depth(frame):
    deep = {"Patient Name": 1}
    for i in range(9):
        deep = {f"k{i}": [deep, i]} if i % 2 else {f"k{i}": deep, "PatientID": None}
    bodies = [deep, {"PatientName": {"patientid": [{"ACCESSION_NUMBER": []}]}}, [[[{"PatientsAge": 1}]]], {}, [], 3, "PatientName", None, {"x": "PatientName"}]
    texts = [json.dumps(b) for b in bodies] + ["{not json", "", None]
    docs = frame(list(enumerate(texts)), "id int, body string")
    got = sorted((r["id"], r["path"], r["field"]) for r in ID.identifying_keys(docs, ["id"], "body").collect())
    assert got == sorted((i, *hit) for i, b in enumerate(bodies) for hit in plain(b))
    assert any(path.count(".") + path.count("[") > 8 for _, path, _ in got)
    assert ID.identifying_keys(frame([], "id int, body string"), ["id"], "body").collect() == []


def test_identifying_columns_of_a_nested_schema():
    schema = T._parse_datatype_string("id int, Patient_Name string, a struct<b: array<struct<`patients age`: int, c: map<string, struct<PatientID: int>>>>>")
    assert ID.identifying_columns(schema) == [("Patient_Name", "PatientName"), ("a.b[].patients age", "PatientsAge"), ("a.b[].c{}.PatientID", "PatientID")]


def test_allocation_sets_that_are_no_sets(frame):
    pod = {"properties": {"labels": {"workflows_argoproj_io_workflow": "w"}}, "totalCost": None, "ramByteHours": 2.0**31}
    texts = [json.dumps(x) for x in ({"data": [{"p": pod, "": pod, "__idle__": pod, "q": {}}, {"second": pod}]}, {"data": []}, {"data": [None]}, {}, [])] + ["{bad", None]
    rows = AL.pod_allocations(frame(list(enumerate(texts)), "date int, body string"), "body").collect()
    assert [(r["date"], r["pod"], r["total_cost_usd"], r["ram_gb_hours"], r["start_us"]) for r in rows] == [(0, "p", 0.0, 2.0, None)]
